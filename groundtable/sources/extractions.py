"""Landed model output."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from groundtable import schemas


def parse_raw(rows: DataFrame) -> DataFrame:
    """`rows` with fields (the JSON object as a struct) and bad (no object could be read).

    The text from the first opening to the last closing brace counts, so prose around the object does no harm.
    """
    body = F.nullif(F.regexp_extract("raw_json", r"(?s)\{.*\}", 0), F.lit(""))
    return rows.withColumns({"fields": F.from_json(body, schemas.EXTRACTED), "bad": F.coalesce(F.try_parse_json(body).isNull(), F.lit(True))})


def cost(tokens_in: Column, tokens_out: Column, rate_in: Column, rate_out: Column) -> Column:
    """Dollars for tokens at rates for a million, to 6 places; null if any is unknown."""
    return F.round((tokens_in * rate_in + tokens_out * rate_out) / 1e6, 6)


def with_cost(rows: DataFrame, rates: dict[str, tuple[float, float]]) -> DataFrame:
    """cost_usd from a table of a few models' rates."""
    table = rows.sparkSession.createDataFrame([(m, *r) for m, r in rates.items()], "model string, rate_in double, rate_out double")
    joined = rows.drop("cost_usd").join(table, "model", "left")
    return joined.withColumn("cost_usd", cost(F.col("tokens_in"), F.col("tokens_out"), F.col("rate_in"), F.col("rate_out"))).drop("rate_in", "rate_out")
