"""What is still to do, and in which order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from groundtable.functions.text import canonical_governorate
from groundtable.session import dealt

#: Failures of these classes never count against a listing.
ALWAYS_RETRIED = ("blocked", "timeout")
TRIES = 3


def limited(df: DataFrame, limit: int | None) -> DataFrame:
    """No or zero limit means all rows."""
    return df.limit(limit) if limit else df


def given_up(failures: DataFrame, stage: str = "fetch", tries: int = TRIES) -> DataFrame:
    """key: listings with so many failures of a stage that are not always retried; failures without a class or a listing do not count."""
    hard = failures.filter((F.col("stage") == stage) & ~F.col("error_class").isin(*ALWAYS_RETRIED) & F.col("listing_id").isNotNull())
    return hard.groupBy("listing_id").count().filter(F.col("count") >= tries).select("listing_id")


def first_seen(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """The first row of each key."""
    return df.withColumn("_n", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).filter("_n = 1").drop("_n")


def round_robin(df: DataFrame, buckets: list[Column], order: list[Column], limit: int | None = None) -> DataFrame:
    """One row of each bucket in turn, buckets in sorted order, with turn (from 1) and the buckets as b0, b1, ..."""
    named = df.withColumns({f"b{i}": b for i, b in enumerate(buckets)})
    names = [f"b{i}" for i in range(len(buckets))]
    turned = named.withColumn("turn", F.row_number().over(Window.partitionBy(*names).orderBy(*order)))
    if limit:  # no bucket gives more rows than the limit, which the plan can push below the sort
        turned = turned.filter(F.col("turn") <= limit)
    return limited(turned.orderBy("turn", *names), limit)


def pending_fetch(listings: DataFrame, pages: DataFrame, failures: DataFrame, limit: int | None = None, stratify: bool = True) -> DataFrame:
    """Listings without a page that have not failed too often, spread over governorates and purposes."""
    rows = listings.join(pages.select("listing_id"), "listing_id", "left_anti").join(given_up(failures), "listing_id", "left_anti")
    order = [F.col("discovered_at"), F.col("listing_id")]
    rows = first_seen(rows, ["listing_id"], order)
    if not stratify:
        return limited(rows.orderBy(*order), limit)
    return round_robin(rows, [canonical_governorate(F.col("governorate")), F.col("purpose")], order, limit).drop("turn", "b0", "b1")


def pending_parse(pages: DataFrame, records: DataFrame, limit: int | None = None) -> DataFrame:
    """Pages never parsed, or changed since."""
    seen = records.select("listing_id", F.col("content_hash").alias("_parsed"), F.lit(True).alias("_seen"))
    changed = F.col("_seen").isNull() | ~F.col("content_hash").eqNullSafe(F.col("_parsed"))
    rows = pages.join(seen, "listing_id", "left").filter(changed).drop("_parsed", "_seen")
    return rows.orderBy("listing_id").limit(limit) if limit else rows


def pending_extract(records: DataFrame, extractions: DataFrame, version: str, model: str | None = None, limit: int | None = None) -> DataFrame:
    """Described records that no successful extraction of this prompt version (and model, if given) covers."""
    done = extractions.filter((F.col("prompt_version") == version) & F.col("error").isNull())
    done = done.filter(F.col("model") == model) if model else done
    rows = records.filter(F.col("description_raw").isNotNull()).join(dealt(done.select("listing_id")), "listing_id", "left_anti")
    return rows.orderBy("listing_id").limit(limit) if limit else rows


def top_per_slice(df: DataFrame, slices: list[str], order: list[Column], n: int) -> DataFrame:
    """The first n rows of each slice."""
    return df.withColumn("_n", F.row_number().over(Window.partitionBy(*slices).orderBy(*order))).filter(F.col("_n") <= n).drop("_n")


def live_slices(dimensions: list[DataFrame], hits: DataFrame, keys: list[str]) -> DataFrame:
    """Combinations of the dimensions' values that have hits, with their number n; dimensions are a few rows each."""
    every = dimensions[0]
    for d in dimensions[1:]:
        every = every.crossJoin(d)
    return every.join(hits.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")), keys, "left").withColumn("n", F.coalesce("n", F.lit(0))).filter("n > 0")
