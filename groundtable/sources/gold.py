"""Hand labels."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from groundtable import schemas


def read_gold(spark: SparkSession, path: str) -> DataFrame:
    """CSV files of labels, all strings, one row for each trimmed listing_id: the last of duplicates, by file name and place in the file.

    Spark reads files in parts, and parts in any order: a row's place is its file, its part's start there, and its number in the part.
    """
    fields = ["listing_id", *schemas.names(schemas.GROUP_B)]
    rows = spark.read.csv(path, header=True, schema=", ".join(f"{c} string" for c in fields), enforceSchema=False)
    place = F.struct("_metadata.file_path", "_metadata.file_block_start", F.monotonically_increasing_id())
    rows = rows.select(F.trim("listing_id").alias("listing_id"), *fields[1:], place.alias("_at"))
    last = F.row_number().over(Window.partitionBy("listing_id").orderBy(F.desc("_at")))
    return rows.withColumn("_last", last).filter("_last = 1").drop("_at", "_last")
