"""Shards against sums by hand, their order, hot texts and the files."""

import hashlib
import zlib

from pyspark.sql import functions as F

from groundtable.llm import sharding


def by_hand(rows, shards):
    """(id, size, crc, shard, slot) of rows in order of digest and id."""
    data = [((r[1] or "").encode(), r[0]) for r in rows]
    data.sort(key=lambda x: (hashlib.md5(x[0]).hexdigest(), x[1] is not None, x[1] or 0))
    total, before, slots, out = sum(len(t) + 8 for t, _ in data), 0, {}, []
    for text, key in data:
        size = len(text) + 8
        shard = (2 * before + size) * shards // (2 * total)
        slots[shard] = slots.get(shard, -1) + 1
        out.append((key, size, zlib.crc32(text), shard, slots[shard]))
        before += size
    return sorted(out, key=str)


def test_assign(spark, stored, odd_rows):
    rows = [*odd_rows, *((k, "a text that many share") for k in range(200, 500)), *((501, "the same row") for _ in range(150))]
    docs = stored(rows)
    placed = sharding.assign(docs, 7)
    assert placed.columns == ["doc_id", "size", "text_crc32", "shard", "slot"]
    assert sorted(map(tuple, placed.collect()), key=str) == by_hand(rows, 7)
    spark.conf.set("spark.sql.shuffle.partitions", "5")
    try:
        assert sorted(map(tuple, sharding.assign(docs.repartition(4), 7).collect()), key=str) == by_hand(rows, 7)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "3")
    assert sharding.assign(docs.limit(0), 7).count() == 0


def test_shares(spark):
    rows = spark.range(20_000).select(F.col("id").alias("shard"), (F.lit(10) + F.col("id") % 90).alias("cost"), F.lit("k").alias("key"), F.lit(1).alias("Slot"))
    placed = sharding.place(rows.withColumnRenamed("shard", "part"), 24, F.col("cost"), [F.xxhash64("part")])
    assert placed.columns == ["part", "cost", "key", "shard", "slot"]
    per = placed.groupBy("shard").agg(F.sum("cost").alias("b"), F.count("*").alias("n"), F.max("slot").alias("last"), F.count_distinct("slot").alias("slots")).collect()
    whole = sum(r.b for r in per)
    assert len(per) == 24 and all(r.n == r.slots == r["last"] + 1 and abs(r.b - whole / 24) < 100 for r in per)


def test_no_partition_gets_a_hot_text(spark):
    """Where half of all rows are one row, its copies are split."""
    docs = spark.range(6_000).select(F.when(F.col("id") % 2 == 0, 7).otherwise(F.col("id")).alias("doc_id"), F.when(F.col("id") % 2 == 0, "hot").otherwise(F.col("id").cast("string")).alias("text"))
    seen = []
    keep, sharding.stored = sharding.stored, lambda df, name: seen.append((name, out := keep(df, name))) or out
    try:
        n = sharding.assign(docs, 4).groupBy("shard").count().collect()
    finally:
        sharding.stored = keep
    parts = dict(seen)["ranged"].groupBy("part").count().collect()
    assert len(n) == 4 and max(r["count"] for r in parts) < 0.6 * 6_000


def test_write(spark, stored, odd_rows, tmp_path):
    docs = stored(odd_rows)
    sharding.write(docs, f"{tmp_path}/out", 3)
    back = spark.read.parquet(f"{tmp_path}/out")
    assert sorted(back.columns) == sorted([*docs.columns, "shard", "slot"])
    key = lambda rows: sorted((str(tuple(r)) for r in rows))
    assert key(back.select(*docs.columns).collect()) == key(docs.collect())
    assert sorted(((r.doc_id, r.shard, r.slot) for r in back.collect()), key=str) == sorted(((r.doc_id, r.shard, r.slot) for r in sharding.assign(docs, 3).collect()), key=str)
