"""Session and table helpers shared by every plan."""

from __future__ import annotations

import gc
import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def build_session(app: str = "groundtable", master: str | None = None, **conf: str) -> SparkSession:
    """A UTC, adaptive session; `conf` overrides the defaults."""
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.ui.enabled": "false",
    } | conf
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    return builder.config(map=settings).getOrCreate()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the Parquet tables below `sf_dir`."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder the cluster shares for checkpoints (spark.checkpoint.dir).

    Where the setting is absent, as in local tests, a temporary folder is used;
    that happens on a local master only, since executors elsewhere could not see it.
    """
    named = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named
    if spark.sparkContext._jsc.sc().getCheckpointDir().isDefined():
        return spark.sparkContext._jsc.sc().getCheckpointDir().get()
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    spark.sparkContext.setCheckpointDir("file://" + tempfile.mkdtemp(prefix="checkpoint-", dir=os.environ.get("TMPDIR")))
    return spark.sparkContext._jsc.sc().getCheckpointDir().get()


def cut(df: DataFrame) -> DataFrame:
    """`df` written once to the shared folder, its lineage cut."""
    spark = df.sparkSession
    named = shared_dir(spark)
    if not spark.sparkContext._jsc.sc().getCheckpointDir().isDefined():
        spark.sparkContext.setCheckpointDir(named)
    return df.checkpoint(eager=True)


def stored(df: DataFrame, name: str) -> DataFrame:
    """`df` written as Parquet to the shared folder and read again: for wide or repetitive rows, which a checkpoint would hold uncompressed."""
    path = f"{shared_dir(df.sparkSession)}/{name}-{uuid.uuid4()}"
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def dealt(df: DataFrame) -> DataFrame:
    """`df` for a join that deals both sides out by key and is never turned into a broadcast.

    Spark takes a stored table for as small as its files. Millions of repetitive rows, a few of many columns at that, then pass for a few
    MB and would be gathered on the driver.
    """
    return df.hint("merge")


def release(spark: SparkSession) -> None:
    """Lets Spark's cleaner drop shuffle files that no living DataFrame needs; it acts when the driver collects its garbage."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()
