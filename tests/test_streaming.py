"""Pages that land in a folder reach the store once."""

from datetime import datetime

from groundtable.plans import batch
from groundtable.streaming import landing

GOOD = "browserInitialState" + "x" * 1000


def test_follow_pages(spark, tmp_path):
    landed, store, checkpoint = (str(tmp_path / x) for x in ("landed", "store", "checkpoint"))

    def land(*rows):
        spark.createDataFrame([(i, "u", h, datetime(2024, 1, d)) for i, h, d in rows], landing.LANDED).write.mode("append").parquet(landed)
        landing.follow_pages(spark, landed, store, checkpoint).awaitTermination()

    land(("a", GOOD, 1), ("b", "short", 1), ("a", GOOD + "!", 2))
    pages = {r.listing_id: r for r in batch.load(spark, store, "pages").collect()}
    assert set(pages) == {"a"} and pages["a"].bytes == len(GOOD) + 1
    assert [(r.listing_id, r.error_class) for r in batch.load(spark, store, "failures").collect()] == [("b", "blocked")]
    land(("b", GOOD, 3))
    assert {r.listing_id for r in batch.load(spark, store, "pages").collect()} == {"a", "b"}
    assert batch.load(spark, store, "failures").count() == 1
    # the same batch again, as after a failure, changes nothing
    batch_ = spark.createDataFrame([("b", "u", "short", datetime(2024, 1, 1))], landing.LANDED)
    landing.keep_pages(batch_, store)
    landing.keep_pages(batch_, store)
    assert batch.load(spark, store, "failures").count() == 1
