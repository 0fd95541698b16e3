"""Keyed tables: upsert, insert or ignore, dead letters, migration."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from groundtable.session import dealt

MESSAGE_CHARS = 2000


def open_table(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A table of the store with exactly the schema's columns; those that files lack are null."""
    return spark.read.schema(schema).option("mergeSchema", "true").parquet(path)


def migrate(df: DataFrame, spark: SparkSession, schema: str, drop_on_mismatch: bool = False) -> DataFrame:
    """`df` with the schema's missing columns added as nulls, or an empty table where cheap tables differ."""
    empty = spark.createDataFrame([], schema)
    if set(empty.columns) - set(df.columns) and drop_on_mismatch:
        return empty
    return empty.unionByName(df, allowMissingColumns=True).select(*empty.columns, *(c for c in df.columns if c not in empty.columns))


def upsert(target: DataFrame, updates: DataFrame, keys: list[str], on_insert: dict[str, Column] | None = None) -> DataFrame:
    """Rows of `target` with the columns that `updates` supplies taken from it, and its new rows.

    A supplied null overwrites; columns that are not supplied keep what the target has. `on_insert` are defaults of
    new rows, not refreshed later. Keys are compared null-safely; `updates` has one row for each key.
    """
    supplied = [c for c in updates.columns if c not in keys]
    new = updates.select(*(F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)), *(F.col(c).alias(f"_s_{c}") for c in supplied), F.lit(True).alias("_given"))
    old = target.withColumn("_held", F.lit(True))
    same = F.lit(True)
    for i, k in enumerate(keys):
        same = same & old[k].eqNullSafe(new[f"_k{i}"])
    both = old.join(new, same, "full")
    out = []
    for c in target.columns:
        if c in keys:
            out.append(F.when(F.col("_held"), F.col(c)).otherwise(F.col(f"_k{keys.index(c)}")).alias(c))
        elif c in supplied:
            out.append(F.when(F.col("_given"), F.col(f"_s_{c}")).otherwise(F.col(c)).alias(c))
        elif on_insert and c in on_insert:
            out.append(F.when(F.col("_held"), F.col(c)).otherwise(on_insert[c]).alias(c))
        else:
            out.append(F.col(c))
    return both.select(*out)


def new_rows(target: DataFrame, batch: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """The batch's rows of keys that `target` has not, the first of each key in `order`."""
    first = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return batch.withColumn("_n", first).filter("_n = 1").drop("_n").join(dealt(target.select(*keys)), keys, "left_anti")


def insert_ignore(target: DataFrame, batch: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """`target` and the batch's new_rows()."""
    return target.unionByName(new_rows(target, batch, keys, order), allowMissingColumns=True)


def cut_message(message: Column) -> Column:
    return F.substring(message, 1, MESSAGE_CHARS)


def log_failures(failures: DataFrame, rows: DataFrame) -> DataFrame:
    """Dead letters appended, their messages cut. keyed.log() does the same to a table of the store, once for each letter and with ids."""
    return failures.unionByName(rows.withColumn("message", cut_message(F.col("message"))), allowMissingColumns=True)
