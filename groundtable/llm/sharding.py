"""Contiguous shards of equal bytes, by prefix sums over the whole table. DataFrame functions only.

Rows are put in one order (text digest, id), cut by Spark into partitions of about equal rows; a partition's total is one row, so the
sum of all partitions before it is a sum over as many rows as there are partitions. That plus a running sum inside
the partition is a row's place in bytes, and equal targets cut the whole into shards. Only ids, digests
and sizes are moved for this. A text that a third of all rows share is split by id, and rows equal in both by their place in the input,
so no partition gets more than its part.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from groundtable.llm.common import fresh, quoted
from groundtable.session import stored

#: Bytes that a document takes besides its text.
OVERHEAD = 8


def measure(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """<id_col>, size (UTF-8 bytes of the text and OVERHEAD), text_crc32 (unsigned) and digest; a null text counts as an empty one."""
    text = F.coalesce(F.col(text_col), F.lit("")).cast("binary")
    return docs.select(id_col, (F.octet_length(text) + OVERHEAD).cast("long").alias("size"), F.crc32(text).alias("text_crc32"), F.md5(text).alias("digest"))


def place(rows: DataFrame, shards: int, size: Column, order: list[Column]) -> DataFrame:
    """`rows` with shard (from 0) and slot (place in the shard, gapless from 0).

    Rows are taken in `order`, rows equal in it in the order of the input; a row belongs to the shard in whose equal share of all bytes its
    middle byte lies. So a shard is off its share by less than the largest row, shards are contiguous in the order, and every row is in
    one; where single rows are larger than a share, some shards are empty. Sizes are above 0 (a null size counts 1). The result depends
    on the rows alone, not on how they are partitioned. Columns named shard and slot are replaced, others stay. An empty table gives no rows.
    """
    spark = rows.sparkSession
    own = [c for c in rows.columns if c.lower() not in ("shard", "slot")]
    keys = [f"k{i}" for i in range(len(order))]
    flat = rows.select(
        F.struct(*quoted(own)).alias("row"), F.greatest(F.coalesce(size.cast("long"), F.lit(1)), F.lit(1)).cast("long").alias("bytes"), *(o.alias(k) for o, k in zip(order, keys, strict=True)), F.monotonically_increasing_id().alias("tie")
    )
    # partitions are told apart by number, so they are written once: bounds are sampled anew each time
    ranged = stored(flat, "sized").repartitionByRange(int(spark.conf.get("spark.sql.shuffle.partitions")), *keys, "tie")
    dealt = stored(ranged.withColumn("part", F.spark_partition_id()), "ranged")
    before, all_ = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1), Window.orderBy("part").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    zero = F.lit(0).cast("long")
    totals = dealt.groupBy("part").agg(F.sum("bytes").alias("b"), F.count(F.lit(1)).alias("n"))
    totals = totals.select("part", F.coalesce(F.sum("b").over(before), zero).alias("bytes_before"), F.coalesce(F.sum("n").over(before), zero).alias("rows_before"), F.sum("b").over(all_).alias("total"))
    inside = Window.partitionBy("part").orderBy(*keys, "tie").rowsBetween(Window.unboundedPreceding, 0)
    summed = dealt.withColumns({"upto": F.sum("bytes").over(inside), "nth": F.count(F.lit(1)).over(inside)}).join(totals, "part")
    middle = "2 * (bytes_before + upto) - bytes"  # twice the place of the row's middle
    shard = F.expr(f"(({middle}) * {shards}L) div (2 * total)").cast("int")
    cut = stored(summed.select("row", shard.alias("shard"), (F.col("rows_before") + F.col("nth") - 1).alias("at")), "cut")
    firsts = cut.groupBy("shard").agg(F.min("at").alias("first"))  # a row a shard
    return cut.join(F.broadcast(firsts), "shard").select("row.*", "shard", (F.col("at") - F.col("first")).alias("slot"))


def assign(docs: DataFrame, shards: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """<id_col>, size, text_crc32, shard, slot of every document; copies of a text follow one another. See place()."""
    return place(measure(docs, id_col, text_col), shards, F.col("size"), [F.col("digest"), F.col(id_col)]).drop("digest")


def write(docs: DataFrame, path: str, shards: int, id_col: str = "doc_id", text_col: str = "text") -> None:
    """Writes `docs` below `path` as shard=0, shard=1, ... in the order of the slots; each shard is as many files as it has parts.

    Texts are moved once, to their shard; what decides is worked out on measures of them.
    """
    (at,) = fresh(docs, "row_at")
    rows = stored(docs.withColumn(at, F.monotonically_increasing_id()), "rows")
    sized = measure(rows.select(F.struct(id_col, at).alias("key"), text_col), "key", text_col)
    placed = place(sized, shards, F.col("size"), [F.col("digest"), F.col(f"key.{id_col}")]).select(F.col(f"key.{at}").alias(at), "shard", "slot")
    own = [c for c in docs.columns if c.lower() not in ("shard", "slot")]
    full = rows.select(F.struct(*quoted(own)).alias("row"), at).join(placed, at).select("row.*", "shard", "slot")
    full.repartitionByRange("shard", "slot").sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)
