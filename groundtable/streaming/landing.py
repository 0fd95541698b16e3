"""Landed pages as a stream: files of a folder become rows of the store as they arrive.

The stream's checkpoint is the queue of what is still to do: a file is read once, and a batch that is run again
after a failure writes the same rows: pages are upserted by listing, and a failure is the page's id and time.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from groundtable.operators import keyed
from groundtable.operators.queues import first_seen
from groundtable.plans.batch import MOST_FAILED, failure, gated, opened
from groundtable.sources.pages import page_rows

LANDED = "listing_id string, url string, html string, fetched_at timestamp"


def keep_pages(batch: DataFrame, store: str, most_blocked: float = MOST_FAILED) -> None:
    """Good pages into the table of pages, the latest of each listing; blocked ones into the dead letters, once: their time is the page's own.

    Where more than `most_blocked` of a batch is blocked, the source shuts us out: BadBatch, nothing is written, and the files stay to be read.
    """
    spark = batch.sparkSession
    last = first_seen(batch, ["listing_id"], [F.desc_nulls_last("fetched_at"), F.col("url")])
    rows = gated(page_rows(last, "fetched_at"), F.col("blocked"), "landed", most=most_blocked)
    keyed.merge(opened(spark, store, "pages"), rows.filter(~F.col("blocked")).drop("blocked"))
    keyed.log(opened(spark, store, "failures"), failure(rows.filter("blocked"), "fetch", "blocked", F.lit("no listing on the page"), F.col("fetched_at")))


def follow_pages(spark: SparkSession, landed: str, store: str, checkpoint: str, files: int = 1000, most_blocked: float = MOST_FAILED) -> StreamingQuery:
    """Starts a query that takes what is in the folder now and ends; a batch that is mostly blocked ends it with its files still to be read."""
    stream = spark.readStream.schema(LANDED).option("maxFilesPerTrigger", files).parquet(landed)
    return stream.writeStream.foreachBatch(lambda batch, _: keep_pages(batch, store, most_blocked)).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
