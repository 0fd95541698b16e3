"""What leaves the store."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from groundtable import schemas

GROUPS = {"Group A (stated on page)": schemas.GROUP_A, "Group B (extracted from description)": schemas.GROUP_B, "Derived (computed)": schemas.DERIVED}


def dataset_view(records: DataFrame) -> DataFrame:
    """The 39 columns of the dataset in order, as far as records have them; flags are true, false or null, lists joined by a comma, an empty list as an empty text."""
    cols = [c for ddl in GROUPS.values() for c in schemas.names(ddl)]
    there = [c for c in cols if c in records.columns]
    return records.select(*(F.array_join(c, ", ").alias(c) if c == "amenities" else F.col(c).cast("boolean").alias(c) if c.startswith("is_") else F.col(c) for c in there))


def field_dictionary(spark: SparkSession) -> DataFrame:
    """field, source: which group each column is of."""
    return spark.createDataFrame([(c, g) for g, ddl in GROUPS.items() for c in schemas.names(ddl)], "field string, source string")


def export(records: DataFrame, scores: DataFrame | None, out: str) -> None:
    """Dataset, field dictionary and scores (if there are any) below `out`, as Parquet and as CSV with nulls empty."""
    sheets = {"dataset": dataset_view(records), "fields": field_dictionary(records.sparkSession)} | ({} if scores is None else {"evaluation": scores})
    for name, df in sheets.items():
        df.write.mode("overwrite").parquet(f"{out}/{name}.parquet")
        df.write.mode("overwrite").csv(f"{out}/{name}.csv", header=True, nullValue="", emptyValue="")


def seeded_sample(df: DataFrame, key: str, n: int, seed: int = 42) -> DataFrame:
    """n rows by the order of md5(key|seed), sorted by key; all if fewer."""
    picked = df.orderBy(F.md5(F.concat(F.col(key).cast("string"), F.lit(f"|{seed}"))), key).limit(n)
    return picked.orderBy(key)


def gold_template(records: DataFrame, n: int = 25, seed: int = 42) -> DataFrame:
    """A sheet to label: the sampled described listings, every field empty."""
    picked = seeded_sample(records.filter("description_raw is not null").select("listing_id"), "listing_id", n, seed)
    return picked.select("listing_id", *(F.lit(None).cast("string").alias(c) for c in schemas.names(schemas.GROUP_B)))


def write_template(records: DataFrame, out: str, n: int = 25, seed: int = 42) -> None:
    """gold_template() as one CSV below `out`; labels that are there already are moved to `out`.bak first."""
    spark = records.sparkSession
    path, backup = (spark.sparkContext._jvm.org.apache.hadoop.fs.Path(p) for p in (out, f"{out}.bak"))
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if fs.exists(path):
        fs.delete(backup, True)
        fs.rename(path, backup)
    gold_template(records, n, seed).coalesce(1).write.csv(out, header=True, nullValue="")
