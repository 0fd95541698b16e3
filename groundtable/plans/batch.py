"""The batch: landed hits, pages and model output to the dataset. Each stage is one plan over whole tables and gives what is to be written."""

from __future__ import annotations

import logging

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from groundtable import schemas
from groundtable.functions.money import unit_price
from groundtable.functions.text import detect_language, nfkc
from groundtable.operators import keyed
from groundtable.operators.export import export
from groundtable.operators.grounding import canonicalize, ground
from groundtable.operators.overlay import backfill, change_set, changes, overlay
from groundtable.operators.queues import live_slices, pending_extract, pending_parse, top_per_slice
from groundtable.session import dealt, stored
from groundtable.sources.extractions import parse_raw, with_cost
from groundtable.sources.hits import parse_hits, read_hits, stated_columns
from groundtable.sources.pages import description

LOG = logging.getLogger(__name__)
#: Of the vocabularies that extractions are snapped to.
TAXONOMY_VERSION = "1"
#: A batch of at least this many rows of which more than this share failed is not written.
LEAST_ROWS, MOST_FAILED = 20, 0.5


class BadBatch(RuntimeError):
    """So much of a batch failed that the source is at fault, not the rows; nothing of it has been written."""


def gated(rows: DataFrame, failed: Column, name: str, least: int = LEAST_ROWS, most: float = MOST_FAILED) -> DataFrame:
    """`rows` written once to the shared folder, unless more than `most` of them, `least` at least, have failed: then BadBatch.

    The two counts are taken while the rows are written, not in a pass of their own.
    """
    seen = Observation(name)
    counted = rows.observe(seen, F.count(F.lit(1)).alias("rows"), F.count_if(F.coalesce(failed, F.lit(False))).alias("failed"))
    out = stored(counted, name)
    n, bad = seen.get["rows"], seen.get["failed"]
    LOG.info("%s: %d of %d rows failed", name, bad, n)
    if n >= least and bad > most * n:
        raise BadBatch(f"{name}: {bad} of {n} rows failed")
    return out


def failure(rows: DataFrame, stage: str, error_class: str, message: Column, ts: Column) -> DataFrame:
    """Dead letters of rows; `ts` is the time of what failed, so that it is the same letter when it fails again."""
    return rows.select("listing_id", F.lit(stage).alias("stage"), F.lit(error_class).alias("error_class"), message.alias("message"), ts.cast("timestamp").alias("ts"))


def discover(hits: DataFrame, dimensions: list[DataFrame], keys: list[str], per_slice: int = 200) -> DataFrame:
    """The first hits of every slice that has any."""
    live = live_slices(dimensions, hits, keys).select(*keys)
    order = [F.col("discovered_at"), F.col("listing_id")]
    return top_per_slice(hits.join(live, keys, "left_semi"), keys, order, per_slice or 200)


def parse(listings: DataFrame, pages: DataFrame, records: DataFrame, limit: int | None = None) -> tuple[DataFrame, DataFrame]:
    """The stated columns of new and changed pages, one row a listing, and dead letters of pages that lack a hit, a price or a purpose."""
    todo = pending_parse(pages.select("listing_id", "content_hash", "html", "fetched_at"), records, limit)
    joined = todo.join(listings.select("listing_id", "url", "hit_json"), "listing_id", "left").withColumn("description_raw", description(F.col("html")))
    said = parse_hits(joined.select("listing_id", "url", "hit_json", "content_hash", "fetched_at", "description_raw"))
    rows = stated_columns(said, "content_hash", "fetched_at", "description_raw", F.col("hit_json").isNull().alias("orphan")).withColumns({
        "language": detect_language(F.col("description_raw")), "price_per_sqm": F.round(unit_price(F.col("price"), F.col("area_sqm")), 2), "parsed_at": F.current_timestamp(),
    })
    rows = stored(rows, "parsed")  # what becomes records and what becomes letters is decided once
    bad = F.col("price").isNull() | F.col("purpose").isNull()
    orphans = failure(rows.filter("orphan"), "parse", "missing_hit", F.lit("no hit for this page"), F.col("fetched_at"))
    insane = failure(rows.filter(bad & ~F.col("orphan")), "parse", "sanity", F.lit("price or purpose is missing"), F.col("fetched_at"))
    return rows.filter(~bad & ~F.col("orphan")).drop("orphan", "fetched_at"), orphans.union(insane)


def extract(
    records: DataFrame, extractions: DataFrame, landed: DataFrame, version: str, model: str, limit: int | None = None,
    taxonomy: str = TAXONOMY_VERSION, rates: dict[str, tuple[float, float]] | None = None, most_failed: float = MOST_FAILED,
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """From landed model output, canonicalised, grounded and overlaid: columns of records, extractions (one row of each a listing), dead letters.

    Of several outputs for a listing the last that can be read counts, by time, then by its text; where none can be read, the last. Each that
    can't be read is a dead letter. An extraction is grounded (1) if nothing of it was rejected, not (0) if something was,
    neither (null) if it could not be read. With `rates` (dollars a million tokens in and out, by model) its cost is worked out, else it is
    what has landed. A batch of which too much can't be read is a BadBatch.
    """
    todo = pending_extract(records, extractions, version, model, limit)
    mine = landed.filter((F.col("prompt_version") == version) & (F.col("model") == model)).drop("grounded", "error")
    mine = with_cost(mine, rates) if rates else mine
    stated = todo.select("listing_id", "description_raw", "price", "purpose", *schemas.names(schemas.HINTS))
    turn = F.row_number().over(Window.partitionBy("listing_id").orderBy("bad", F.desc_nulls_last("ts"), F.desc_nulls_last("raw_json")))
    rows = parse_raw(mine).withColumn("turn", turn).join(dealt(stated), "listing_id")
    fields = schemas.names(schemas.EXTRACTED)
    kept = [F.col(c) for c in ("listing_id", "prompt_version", "model", "raw_json", "tokens_in", "tokens_out", "cost_usd", "ts", "bad", "turn", "price", "purpose", *schemas.names(schemas.HINTS))]
    raw = rows.select(*kept, *(F.col(f"fields.{c}").alias(c) for c in fields), nfkc(F.col("description_raw")).alias("_said"))
    raw = raw.withColumns({c: nfkc(F.col(c)) for c in (*schemas.ENUMS, *schemas.TEXTS)} | {"amenities": F.coalesce("amenities", F.array().cast("array<string>"))})
    done = gated(overlay(ground(canonicalize(raw), F.col("_said"))).drop("_said"), F.col("bad"), "extracted", most=most_failed)
    now = F.current_timestamp()
    last = done.filter("turn = 1")
    updates = last.filter(~F.col("bad")).select(
        "listing_id", *fields, "total_installment_cost", F.lit(version).alias("prompt_version"), F.lit(model).alias("model"), F.lit(taxonomy).alias("taxonomy_version"), now.alias("extracted_at"), now.alias("normalized_at")
    )
    readable = lambda c: F.when(~F.col("bad"), F.col(c)).alias(c)
    log = last.select(
        "listing_id", "prompt_version", "model", *map(readable, ("raw_json", "tokens_in", "tokens_out", "cost_usd")), F.when(~F.col("bad"), (F.size("rejected") == 0).cast("int")).alias("grounded"),
        F.when(F.col("bad"), F.lit("no JSON object")).alias("error"), F.coalesce("ts", now).alias("ts"),
    )
    for r in last.filter(~F.col("bad")).select(F.explode("rejected").alias("field")).groupBy("field").count().orderBy("field").collect():
        LOG.info("not in the text: %s, %d times", r["field"], r["count"])
    return updates, log, failure(done.filter("bad"), "extract", "llm_error", F.coalesce("raw_json", F.lit("no output")), F.col("ts"))


def refill(records: DataFrame, listings: DataFrame, limit: int | None = None) -> tuple[DataFrame, DataFrame]:
    """What a backfill changes, only rows that differ and columns that it may change, and its counts by column."""
    rows = records.orderBy("listing_id").limit(limit) if limit else records
    after = stored(backfill(rows, listings)[0], "refilled")
    return change_set(after), changes(after)


#: The tables of a store, and their keys.
TABLES = {"listings": schemas.LISTINGS, "pages": schemas.PAGES, "records": schemas.RECORDS, "extractions": schemas.EXTRACTIONS, "failures": schemas.FAILURES}
KEYS = {"extractions": ("listing_id", "prompt_version", "model")}


def opened(spark: SparkSession, store: str, name: str) -> keyed.Keyed:
    """A table of the store. All have buckets by listing, dead letters too."""
    return keyed.Keyed(spark, f"{store}/{name}", TABLES[name], KEYS.get(name, ("listing_id",)), int(spark.conf.get("groundtable.buckets", str(keyed.BUCKETS))))


def load(spark: SparkSession, store: str, name: str) -> DataFrame:
    """The last version of a table, in buckets by listing; files put there by hand, if there is none; an empty table, if there is nothing."""
    return keyed.located(opened(spark, store, name))


def save(df: DataFrame, store: str, name: str) -> None:
    """A version of a table that holds exactly `df`."""
    keyed.replace_all(opened(df.sparkSession, store, name), df)


def run_parse(spark: SparkSession, store: str, limit: int | None = None) -> None:
    """parse() over a store. Records are written before letters: a run that stops between the two finds the letters again."""
    updates, letters = parse(*(load(spark, store, t) for t in ("listings", "pages", "records")), limit)
    keyed.merge(opened(spark, store, "records"), updates)
    keyed.log(opened(spark, store, "failures"), letters)


def run_extract(spark: SparkSession, store: str, version: str, model: str, limit: int | None = None, rates: dict[str, tuple[float, float]] | None = None) -> None:
    """extract() over a store and the model output landed in it. Extractions, which say what is done, are written last."""
    landed = spark.read.schema(schemas.EXTRACTIONS).parquet(f"{store}/landed")
    updates, log, letters = extract(*(load(spark, store, t) for t in ("records", "extractions")), landed, version, model, limit, rates=rates)
    keyed.merge(opened(spark, store, "records"), updates)
    keyed.log(opened(spark, store, "failures"), letters)
    keyed.merge(opened(spark, store, "extractions"), log)


def run_discover(spark: SparkSession, store: str, landed: str, per_slice: int | None = None) -> None:
    """discover() over landed hits: JSON lines of hits, below purpose=, governorate= and category= folders or with these as fields. Known listings stay."""
    keys = ["purpose", "governorate", "category"]
    hits = read_hits(spark, landed)
    found = discover(hits, [hits.select(k).distinct() for k in keys], keys, per_slice or 200)
    keyed.insert(opened(spark, store, "listings"), found, [F.col("discovered_at"), F.col("listing_id")])


def run_backfill(spark: SparkSession, store: str, limit: int | None = None) -> DataFrame:
    """refill() over a store; the counts of changes by column."""
    updates, counts = refill(load(spark, store, "records"), load(spark, store, "listings"), limit)
    keyed.merge(opened(spark, store, "records"), updates)
    return counts


def run(spark: SparkSession, store: str, version: str, model: str, limit: int | None = None, out: str | None = None) -> None:
    """parse, extract and backfill over a store whose listings, pages and landed output have arrived; exports the dataset, if told where."""
    run_parse(spark, store, limit)
    run_extract(spark, store, version, model, limit)
    run_backfill(spark, store, limit)
    if out:
        export(load(spark, store, "records"), None, out)
