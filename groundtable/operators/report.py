"""Aggregates of the report."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from groundtable.functions.money import unit_price
from groundtable.operators.order import quantiles
from groundtable.operators.queues import pending_extract, pending_fetch, pending_parse


def status(listings: DataFrame, pages: DataFrame, records: DataFrame, extractions: DataFrame, failures: DataFrame, version: str = "", model: str | None = None) -> DataFrame:
    """what, n: rows of the tables, described records, listings extracted without error, failures, and what each stage has still to do."""
    rows = lambda df: df.agg(F.count(F.lit(1)).alias("n"))
    found = {
        "listings": rows(listings), "pages": rows(pages), "records": rows(records), "described": records.agg(F.count("description_raw").alias("n")),
        "extracted": extractions.agg(F.count_distinct(F.when(F.col("error").isNull(), F.col("listing_id"))).alias("n")), "failures": rows(failures),
        "pending_fetch": rows(pending_fetch(listings, pages, failures, stratify=False)), "pending_parse": rows(pending_parse(pages, records)),
        "pending_extract": rows(pending_extract(records, extractions, version, model)),
    }
    return reduce(DataFrame.union, (df.select(F.lit(k).alias("what"), "n") for k, df in found.items()))


def spending(extractions: DataFrame) -> DataFrame:
    """cost_usd, tokens_in, tokens_out: sums, 0 for none."""
    return extractions.agg(*(F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("cost_usd", "tokens_in", "tokens_out")))


def frequent_failures(failures: DataFrame, n: int = 30) -> DataFrame:
    """The n most frequent combinations of stage, class and the message's first 80 characters."""
    return failures.groupBy("stage", "error_class", F.substring("message", 1, 80).alias("message")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "stage", "error_class", "message").limit(n)


def disclosure(records: DataFrame) -> DataFrame:
    """How many listings offer instalments, state any number of a plan, and state all of it."""
    offered = F.col("payment_type").isin("installments", "both")
    some = F.coalesce("down_payment_amount", "down_payment_pct", "installment_amount", "installment_years").isNotNull()
    return records.agg(F.count_if(offered).alias("offered"), F.count_if(offered & some).alias("any_number"), F.count_if(offered & F.col("total_installment_cost").isNotNull()).alias("computable"))


def plan_ratios(records: DataFrame) -> DataFrame:
    """Exact median, mean and range of a plan's total over the cash price, and how many are at, well below and above it."""
    r = F.col("total_installment_cost") / F.nullif("price", F.lit(0.0))
    ratios = records.select(r.alias("r")).filter("r is not null")
    one = ratios.agg(
        F.count("r").alias("n"), F.avg("r").alias("mean"), F.min("r").alias("least"), F.max("r").alias("most"),
        F.count_if(F.abs(F.col("r") - 1) < 5e-4).alias("at_one"), F.count_if(F.col("r") < 0.9).alias("below"), F.count_if(F.col("r") > 1.02).alias("above"),
    )
    middle = quantiles(ratios, [], "r").select(F.col("q0").alias("median"))
    return one.join(middle, F.lit(True), "left").select("n", "median", "mean", "least", "most", "at_one", "below", "above")  # one row by one row at most


def unit_prices(records: DataFrame) -> DataFrame:
    """Exact median, range and number of unit prices by city of three-bedroom apartments for sale; cities without a price are left out."""
    rows = records.filter("purpose = 'sale' and property_type = 'apartment' and bedrooms = 3")
    priced = rows.select("city", unit_price(F.col("price"), F.col("area_sqm")).alias("p"))
    return quantiles(priced, ["city"], "p").select("city", F.col("q0").alias("median"), "least", "most", "n")


def coverage(df: DataFrame, columns: list[str]) -> DataFrame:
    """column, share of rows where it is there; one pass over the table."""
    one = df.agg(F.count(F.lit(1)).alias("rows"), *(F.count(c).alias(f"n{i}") for i, c in enumerate(columns)))
    return one.select(F.explode(F.array(*(F.struct(F.lit(c).alias("column"), (F.col(f"n{i}") / F.nullif("rows", F.lit(0))).alias("share")) for i, c in enumerate(columns)))).alias("x")).select("x.*")


def duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys with more than one row, and how many."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
