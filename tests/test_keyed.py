"""Keyed tables: what a write touches, versions, dead letters, and what stops a batch."""

import json
import os
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from groundtable import schemas
from groundtable.operators import keyed, queues
from groundtable.plans import batch
from groundtable.streaming import landing

SCHEMA = "k string, v long, w string"


def files(path):
    return {os.path.join(d, f): os.path.getmtime(os.path.join(d, f)) for d, _, names in os.walk(path) for f in names if f.endswith(".parquet")}


def test_one_row_rewrites_one_bucket(spark, tmp_path):
    t = keyed.Keyed(spark, f"{tmp_path}/t", SCHEMA, ("k",), buckets=8)
    keyed.replace_all(t, spark.range(400).select(F.col("id").cast("string").alias("k"), F.col("id").alias("v"), F.lit("old").alias("w")))
    before, held = files(tmp_path), keyed.manifest(t).held
    assert len(held) == 8
    touched = keyed.merge(t, spark.createDataFrame([("7", 70)], "k string, v long"))
    assert len(touched) == 1
    written = {f for f in files(tmp_path) if f not in before}
    assert len({os.path.dirname(f) for f in written}) == 1 and f"bucket={touched[0]}" in written.pop()
    now = keyed.manifest(t).held
    assert {b for b in now if now[b] != held[b]} == set(touched)
    rows = {r.k: (r.v, r.w) for r in keyed.read(t).collect()}
    assert len(rows) == 400 and rows["7"] == (70, "old") and rows["8"] == (8, "old")
    assert {r.v for r in keyed.read(t, version=1).filter("k = '7'").collect()} == {7}
    assert keyed.merge(t, spark.createDataFrame([], "k string, v long")) == [] and keyed.manifest(t).version == 2


def test_merge(spark, tmp_path):
    t = keyed.Keyed(spark, f"{tmp_path}/t", SCHEMA, ("k",), buckets=4)
    news = spark.createDataFrame([("a", 1), ("a", 3), ("a", 2), (None, 5)], "k string, v long")
    keyed.merge(t, news, {"w": F.lit("new")}, [F.desc("v")])
    keyed.merge(t, spark.createDataFrame([("a", None), (None, 6), ("b", 1)], "k string, v long"), {"w": F.lit("newer")})
    assert {tuple(r) for r in keyed.read(t).collect()} == {("a", None, "new"), (None, 6, "new"), ("b", 1, "newer")}
    assert keyed.insert(t, spark.createDataFrame([("b", 9), ("c", 2), ("c", 1)], "k string, v long"), [F.col("v")]) == 1
    assert {tuple(r) for r in keyed.read(t).filter("k > 'a'").collect()} == {("b", 1, "newer"), ("c", 1, None)}
    # of two writers that start from one version the second fails, and leaves the table whole
    stale = keyed.manifest(t)
    keyed.merge(t, spark.createDataFrame([("d", 1)], "k string, v long"))
    with pytest.raises(RuntimeError):
        keyed._commit(t, keyed.replace(stale, version=stale.version + 1))
    assert keyed.read(t).count() == 5


def test_tables_put_there_by_hand_are_taken_in(spark, tmp_path):
    t = keyed.Keyed(spark, f"{tmp_path}/t", SCHEMA, ("k",), buckets=4)
    spark.createDataFrame([(str(i), i, "hand") for i in range(30)], SCHEMA).write.parquet(t.path)
    assert keyed.read(t).count() == 30
    keyed.merge(t, spark.createDataFrame([("3", 33)], "k string, v long"))
    rows = {r.k: r.v for r in keyed.read(t).collect()}
    assert len(rows) == 30 and rows["3"] == 33 and rows["4"] == 4


def test_letters(spark, tmp_path):
    """Letters come once, have dense ids, and a second run adds nothing."""
    t = batch.opened(spark, str(tmp_path), "failures")
    day = datetime(2024, 1, 1)
    rows = [("a", "fetch", "e", "m" * 3000, day), ("a", "fetch", "e", "m" * 3000, day), ("b", "parse", None, None, None), (None, "parse", "e", "x", day)]
    df = spark.createDataFrame(rows, "listing_id string, stage string, error_class string, message string, ts timestamp")
    assert keyed.log(t, df) == 3 and keyed.log(t, df) == 0
    assert keyed.log(t, df.withColumn("ts", F.lit(datetime(2024, 1, 2)))) == 3
    got = batch.load(spark, str(tmp_path), "failures").collect()
    assert sorted(r.id for r in got) == [1, 2, 3, 4, 5, 6] and {len(r.message or "") for r in got} == {0, 1, 2000}


def landed(rows):
    return [(i, "v1", "m", raw, 1, 1, None, None, None, datetime(2024, 1, day) if day else None) for i, raw, day in rows]


def test_repeated_output(spark, tmp_path):
    """Good, bad and good again for one listing: one record, one extraction, the last good; each bad one is a letter, once."""
    store, good = str(tmp_path), lambda name: json.dumps({"developer_name": name})
    spark.createDataFrame([(i, f"by Acme, Beta or Gamma for {i}") for i in "abc"], "listing_id string, description_raw string").write.parquet(f"{store}/records")
    rows = [("a", good("Acme"), 1), ("a", "no", 2), ("a", good("Beta"), 3), ("a", "none", None), ("b", good("Gamma"), 1), ("b", "no", 9), ("c", "no", 1), ("c", "nothing", 2), ("z", good("Acme"), 1)]
    spark.createDataFrame(landed(rows), schemas.EXTRACTIONS).write.parquet(f"{store}/landed")
    for _ in range(2):
        batch.run_extract(spark, store, "v1", "m")
        records = {r.listing_id: r.developer_name for r in batch.load(spark, store, "records").collect()}
        log = {r.listing_id: (r.error, r.grounded, r.ts and r.ts.day) for r in batch.load(spark, store, "extractions").collect()}
        letters = sorted((r.listing_id, r.message) for r in batch.load(spark, store, "failures").collect())
        assert records == {"a": "Beta", "b": "Gamma", "c": None}
        assert log == {"a": (None, 1, 3), "b": (None, 1, 1), "c": ("no JSON object", None, 2)}
        assert batch.load(spark, store, "extractions").count() == 3 and letters == [("a", "no"), ("a", "none"), ("b", "no"), ("c", "no"), ("c", "nothing")]


def test_bad_batches_are_not_written(spark, tmp_path):
    store, source = str(tmp_path / "store"), str(tmp_path / "landed")
    page = lambda i, good: (str(i), "u", ("browserInitialState" if good else "captcha") + "x" * 1000, datetime(2024, 1, 1))
    keep = lambda rows, **o: landing.keep_pages(spark.createDataFrame(rows, landing.LANDED), store, **o)
    keep([page(i, i % 2) for i in range(30)])
    assert (batch.load(spark, store, "pages").count(), batch.load(spark, store, "failures").count()) == (15, 15)
    with pytest.raises(batch.BadBatch):
        keep([page(i, i % 3 == 0) for i in range(100, 130)])
    assert (batch.load(spark, store, "pages").count(), batch.load(spark, store, "failures").count()) == (15, 15)
    keep([page(i, False) for i in range(100, 110)])  # too few to tell
    assert batch.load(spark, store, "failures").count() == 25
    # in a stream the files of a blocked batch stay to be read
    spark.createDataFrame([page(i, False) for i in range(200, 230)], landing.LANDED).write.parquet(source)
    with pytest.raises(Exception, match="30 of 30 rows failed"):
        landing.follow_pages(spark, source, store, f"{tmp_path}/checkpoint").awaitTermination()
    assert batch.load(spark, store, "failures").count() == 25
    landing.follow_pages(spark, source, store, f"{tmp_path}/checkpoint", most_blocked=1.0).awaitTermination()
    assert batch.load(spark, store, "failures").count() == 55


def test_backfill_writes_only_what_changes(spark, tmp_path):
    store = str(tmp_path)
    hit = lambda monthly: json.dumps({"extraFields": {"ownership": "Primary", "monthly_installment": monthly, "installments_payment_duration_years": 2.0}})
    spark.createDataFrame([(str(i), "u", "for-sale", "g", "c", hit(5.0 if i < 3 else None), None) for i in range(60)], schemas.LISTINGS).write.parquet(f"{store}/listings")
    rows = [(str(i), "sale", datetime(2024, 1, 1), "primary", 2.0, 2.0, None if i < 50 else "ultra lux") for i in range(60)] + [("none", "sale", None, None, None, None, "ultra lux")]
    df = spark.createDataFrame(rows, "listing_id string, purpose string, extracted_at timestamp, sale_type string, installment_years double, hint_installment_years double, finishing_level string")
    keyed.merge(batch.opened(spark, store, "records"), df)
    updates, counts = batch.refill(batch.load(spark, store, "records"), batch.load(spark, store, "listings"))
    assert sorted(int(r.listing_id) for r in updates.collect()) == [0, 1, 2, *range(50, 60)]
    assert {k: v for k, v in counts.first().asDict().items() if v} == {"installment_amount": 3, "installment_frequency": 3, "finishing_level": 10}
    batch.run_backfill(spark, store)
    after = {r.listing_id: r for r in batch.load(spark, store, "records").collect()}
    assert (after["1"].installment_amount, after["1"].hint_monthly_installment, after["55"].finishing_level, after["none"].finishing_level) == (5.0, 5.0, None, "ultra lux")
    assert after["1"].normalized_at and not after["30"].normalized_at and after["1"].hint_ownership is None
    version = keyed.manifest(batch.opened(spark, store, "records")).version
    assert set(batch.run_backfill(spark, store).first().asDict().values()) == {0}
    assert keyed.manifest(batch.opened(spark, store, "records")).version == version


def test_queues_need_no_exchange(spark, tmp_path):
    """Tables of a store are bucketed by listing, so what is pending is found where it lies, also after merges and inserts."""
    store, threshold = str(tmp_path), spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    listings = spark.range(200).select(F.col("id").cast("string").alias("listing_id"), F.lit("sale").alias("purpose"))
    rows = lambda name, df: keyed.merge(batch.opened(spark, store, name), df)
    keyed.insert(batch.opened(spark, store, "listings"), listings.filter("listing_id < '5'"), [F.col("listing_id")])
    keyed.insert(batch.opened(spark, store, "listings"), listings, [F.col("listing_id")])
    rows("pages", listings.filter("listing_id % 2 = 0").select("listing_id", F.lit("h").alias("content_hash")))
    rows("records", listings.filter("listing_id % 4 = 0").select("listing_id", F.lit("h").alias("content_hash"), F.lit("said").alias("description_raw")))
    rows("records", listings.filter("listing_id % 8 = 0").select("listing_id", F.lit("old").alias("content_hash")))
    rows("extractions", listings.filter("listing_id % 12 = 0").select("listing_id", F.lit("v").alias("prompt_version"), F.lit("m").alias("model")))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        t = {n: batch.load(spark, store, n) for n in ("listings", "pages", "records", "extractions")}
        found = {
            "fetch": t["listings"].join(t["pages"].select("listing_id"), "listing_id", "left_anti"), "parse": queues.pending_parse(t["pages"], t["records"]),
            "extract": queues.pending_extract(t["records"], t["extractions"], "v", "m"),
        }
        for name, expected in (("fetch", [i for i in range(200) if i % 2]), ("parse", [i for i in range(0, 200, 2) if i % 4 or not i % 8]), ("extract", [i for i in range(0, 200, 4) if i % 12])):
            plan = found[name]._jdf.queryExecution().executedPlan().toString()
            assert "Exchange" not in plan and "Bucketed: true" in plan, name
            assert sorted(int(r.listing_id) for r in found[name].collect()) == expected
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
