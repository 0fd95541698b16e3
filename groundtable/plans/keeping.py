"""Pending queues, ranked picks and keyed tables on the driver's tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from groundtable.operators import export, queues, report, store
from groundtable.session import table


def pending_anti(spark: SparkSession, d: str) -> DataFrame:
    """Documents without labels."""
    return table(spark, d, "documents").select("doc_id", "lang").join(table(spark, d, "labels").select("doc_id"), "doc_id", "left_anti")


def pending_changed_null_safe(spark: SparkSession, d: str) -> DataFrame:
    """Documents never seen, or whose text is not what was seen; some were seen without a hash."""
    docs = table(spark, d, "documents").select(F.col("doc_id").alias("listing_id"), F.md5("text").alias("content_hash"))
    held = F.when(F.col("listing_id") % 3 == 0, F.col("content_hash")).when(F.col("listing_id") % 3 == 1, F.md5(F.lit("old")))
    seen = docs.filter("listing_id % 7 <> 0").select("listing_id", held.alias("content_hash"))
    return queues.pending_parse(docs, seen)


def event_failures(spark: SparkSession, d: str, *more: str) -> DataFrame:
    """Events as a failure log, with `more` of their columns; now and then a class or a listing is unknown."""
    e = table(spark, d, "events")
    return e.select(
        F.when(F.col("event_id") % 50 != 0, F.col("user_id")).alias("listing_id"), F.lit("fetch").alias("stage"),
        F.when(F.col("event_id") % 11 != 0, F.col("event_type")).alias("error_class"), F.col("props").alias("message"), *more,
    )


def pending_dead_letter(spark: SparkSession, d: str) -> DataFrame:
    """Users whose failures are not too many; an unknown user among the failures changes nothing."""
    users = table(spark, d, "events").select(F.col("user_id").alias("listing_id")).distinct()
    return users.join(queues.given_up(event_failures(spark, d).filter("error_class = 'error'"), tries=14), "listing_id", "left_anti")


def pending_by_version(spark: SparkSession, d: str) -> DataFrame:
    """Customers that no order of a priority covers, for any status and for one."""
    done = table(spark, d, "orders").select(F.col("o_custkey").alias("listing_id"), F.col("o_orderpriority").alias("prompt_version"), F.col("o_orderstatus").alias("model"), F.lit(None).cast("string").alias("error"))
    who = table(spark, d, "customer").select(F.col("c_custkey").alias("listing_id"), F.col("c_name").alias("description_raw"))
    modes = [queues.pending_extract(who, done, "1-URGENT", m).select(F.lit(m or "any").alias("model"), "listing_id") for m in (None, "F")]
    return modes[0].union(modes[1])


def round_robin(spark: SparkSession, d: str) -> DataFrame:
    """40 customers, one of each region and segment in turn."""
    c = table(spark, d, "customer").join(F.broadcast(table(spark, d, "nation")), F.col("c_nationkey") == F.col("n_nationkey")).join(F.broadcast(table(spark, d, "region")), F.col("n_regionkey") == F.col("r_regionkey"))
    return queues.round_robin(c, [F.col("r_name"), F.col("c_mktsegment")], [F.col("c_custkey")], 40).select("c_custkey", "b0", "b1", "turn")


def first_seen_dedup(spark: SparkSession, d: str) -> DataFrame:
    """The first document of each text."""
    docs = table(spark, d, "documents").select("doc_id", F.md5("text").alias("digest"))
    return queues.first_seen(docs, ["digest"], [F.col("doc_id")])


def topk_per_slice(spark: SparkSession, d: str) -> DataFrame:
    """Five orders of each status and priority."""
    return queues.top_per_slice(table(spark, d, "orders").select("o_orderstatus", "o_orderpriority", "o_orderkey"), ["o_orderstatus", "o_orderpriority"], [F.col("o_orderkey")], 5)


def slice_verify(spark: SparkSession, d: str) -> DataFrame:
    """Nations by segment that have customers, of all combinations and an impossible one."""
    nations = table(spark, d, "nation").select(F.col("n_nationkey").alias("c_nationkey"))
    segments = table(spark, d, "customer").select("c_mktsegment").distinct().union(spark.createDataFrame([("NONE",)], "c_mktsegment string"))
    return queues.live_slices([nations, segments], table(spark, d, "customer").select("c_nationkey", "c_mktsegment"), ["c_nationkey", "c_mktsegment"])


def upsert_partial(spark: SparkSession, d: str) -> DataFrame:
    """Orders with some columns updated, one with a null, and new ones."""
    base = table(spark, d, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice", "o_orderpriority")
    changed = base.filter("o_orderkey % 10 = 0").select("o_orderkey", F.when(F.col("o_orderkey") % 20 != 0, F.lit("U")).alias("o_orderstatus"))
    new = base.filter("o_orderkey % 100 = 1").select((F.col("o_orderkey") + 100_000_000).alias("o_orderkey"), F.lit("N").alias("o_orderstatus"))
    return store.upsert(base, changed.union(new), ["o_orderkey"], {"o_orderpriority": F.lit("new")})


def insert_ignore(spark: SparkSession, d: str) -> DataFrame:
    """Half of the orders, and a batch of all of them, part of which comes twice."""
    orders = table(spark, d, "orders").select("o_orderkey", "o_totalprice")
    batch = orders.select("o_orderkey", (F.col("o_totalprice") + 1).alias("o_totalprice"))
    twice = batch.union(batch.filter("o_orderkey % 5 = 0").withColumn("o_totalprice", F.col("o_totalprice") + 1))
    return store.insert_ignore(orders.filter("o_orderkey % 2 = 0"), twice, ["o_orderkey"], [F.col("o_totalprice")])


def failure_log_topk(spark: SparkSession, d: str) -> DataFrame:
    """The 30 most frequent failures."""
    return report.frequent_failures(store.log_failures(event_failures(spark, d).limit(0), event_failures(spark, d)))


def gold_sample(spark: SparkSession, d: str) -> DataFrame:
    """25 documents by seeded order."""
    return export.seeded_sample(table(spark, d, "documents").select("doc_id", "source"), "doc_id", 25)


def dataset_view(spark: SparkSession, d: str) -> DataFrame:
    """Documents with their labels as the dataset shows them: flags as booleans, lists joined."""
    both = table(spark, d, "documents").join(table(spark, d, "labels"), "doc_id", "left")
    items = F.when(F.col("doc_id") % 5 == 0, F.array().cast("array<string>")).when(F.col("doc_id") % 5 != 1, F.split("text", " "))
    return export.dataset_view(both.select(F.col("doc_id").cast("string").alias("listing_id"), F.col("lang").alias("language"), F.col("toxic").alias("is_verified"), items.alias("amenities")))


def store_status(spark: SparkSession, d: str) -> DataFrame:
    """What a store of documents holds and has still to do: some without a page, some changed since, some described, some extracted."""
    k = F.col("doc_id")
    docs = table(spark, d, "documents").select(k, k.cast("string").alias("listing_id"), F.col("source").alias("governorate"), F.col("lang").alias("purpose"), F.lit(0).alias("discovered_at"), F.md5("text").alias("content_hash"), "text")
    records = docs.filter("doc_id % 3 = 1").select("listing_id", F.when(k % 5 != 0, F.col("content_hash")).alias("content_hash"), F.when(k % 2 == 0, F.col("text")).alias("description_raw"))
    done = docs.filter("doc_id % 4 = 0").select("listing_id", F.when(k % 8 == 0, F.lit("v1")).otherwise("v0").alias("prompt_version"), F.lit("m").alias("model"), F.when(k % 16 == 0, F.lit("failed")).alias("error"))
    failed = event_failures(spark, d).withColumn("listing_id", F.col("listing_id").cast("string"))
    return report.status(docs, docs.filter("doc_id % 3 <> 0"), records, done, failed, "v1")


QUERIES = {
    f.__name__: f
    for f in (
        pending_anti, pending_changed_null_safe, pending_dead_letter, pending_by_version, round_robin, first_seen_dedup, topk_per_slice, slice_verify,
        upsert_partial, insert_ignore, failure_log_topk, gold_sample, dataset_view, store_status,
    )
}
ORACLE_SQL = {
    "pending_anti": "SELECT doc_id, lang FROM documents ANTI JOIN labels USING (doc_id)",
    "pending_changed_null_safe": """
WITH d AS (SELECT doc_id AS listing_id, md5(text) AS content_hash FROM documents),
s AS (SELECT listing_id, CASE listing_id % 3 WHEN 0 THEN content_hash WHEN 1 THEN md5('old') END AS h FROM d WHERE listing_id % 7 <> 0)
SELECT d.listing_id, content_hash FROM d LEFT JOIN s ON d.listing_id = s.listing_id WHERE s.listing_id IS NULL OR content_hash IS DISTINCT FROM h""",
    "pending_dead_letter": """
SELECT DISTINCT user_id AS listing_id FROM events WHERE user_id NOT IN (
  SELECT user_id FROM events WHERE event_type = 'error' AND event_id % 11 <> 0 AND event_id % 50 <> 0 GROUP BY user_id HAVING count(*) >= 14)""",
    "pending_by_version": """
SELECT 'any' AS model, c_custkey AS listing_id FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderpriority = '1-URGENT')
UNION ALL SELECT 'F', c_custkey FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderpriority = '1-URGENT' AND o_orderstatus = 'F')""",
    "round_robin": """
SELECT c_custkey, r_name AS b0, c_mktsegment AS b1, CAST(row_number() OVER (PARTITION BY r_name, c_mktsegment ORDER BY c_custkey) AS INTEGER) AS turn
FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey ORDER BY turn, b0, b1 LIMIT 40""",
    "first_seen_dedup": "SELECT min(doc_id) AS doc_id, md5(text) AS digest FROM documents GROUP BY md5(text)",
    "topk_per_slice": """
SELECT o_orderstatus, o_orderpriority, o_orderkey FROM orders
QUALIFY row_number() OVER (PARTITION BY o_orderstatus, o_orderpriority ORDER BY o_orderkey) <= 5""",
    "slice_verify": """
SELECT n_nationkey AS c_nationkey, s.c_mktsegment, count(*) AS n
FROM nation CROSS JOIN (SELECT DISTINCT c_mktsegment FROM customer UNION SELECT 'NONE') s JOIN customer c ON c.c_nationkey = n_nationkey AND c.c_mktsegment = s.c_mktsegment GROUP BY ALL""",
    "upsert_partial": """
SELECT o_orderkey, CASE WHEN o_orderkey % 20 = 0 THEN NULL WHEN o_orderkey % 10 = 0 THEN 'U' ELSE o_orderstatus END AS o_orderstatus, o_totalprice, o_orderpriority FROM orders
UNION ALL SELECT o_orderkey + 100000000, 'N', NULL, 'new' FROM orders WHERE o_orderkey % 100 = 1""",
    "insert_ignore": """
SELECT o_orderkey, CASE WHEN o_orderkey % 2 = 0 THEN o_totalprice ELSE o_totalprice + 1 END AS o_totalprice FROM orders""",
    "failure_log_topk": """
SELECT 'fetch' AS stage, CASE WHEN event_id % 11 <> 0 THEN event_type END AS error_class, substr(props, 1, 80) AS message, count(*) AS n
FROM events GROUP BY ALL ORDER BY n DESC, stage, error_class NULLS FIRST, message LIMIT 30""",
    "gold_sample": "SELECT doc_id, source FROM (SELECT doc_id, source FROM documents ORDER BY md5(doc_id || '|42'), doc_id LIMIT 25)",
    "dataset_view": r"""
SELECT CAST(doc_id AS VARCHAR) AS listing_id, lang AS language, CAST(toxic AS BOOLEAN) AS is_verified, CASE WHEN doc_id % 5 = 0 THEN '' WHEN doc_id % 5 <> 1 THEN array_to_string(string_split(text, ' '), ', ') END AS amenities
FROM documents LEFT JOIN labels USING (doc_id)""",
    "store_status": """
WITH given_up AS (SELECT user_id FROM events WHERE event_id % 11 <> 0 AND event_id % 50 <> 0 AND event_type NOT IN ('blocked', 'timeout') GROUP BY 1 HAVING count(*) >= 3)
SELECT unnest(['listings', 'pages', 'records', 'described', 'extracted', 'failures', 'pending_fetch', 'pending_parse', 'pending_extract']) AS what, unnest([count(*), count(*) FILTER (doc_id % 3 <> 0),
  count(*) FILTER (doc_id % 3 = 1), count(text) FILTER (doc_id % 3 = 1 AND doc_id % 2 = 0), count(*) FILTER (doc_id % 4 = 0 AND doc_id % 16 <> 0), (SELECT count(*) FROM events),
  count(*) FILTER (doc_id % 3 = 0 AND doc_id NOT IN (SELECT user_id FROM given_up)), count(*) FILTER (doc_id % 3 = 2 OR doc_id % 3 = 1 AND doc_id % 5 = 0),
  count(text) FILTER (doc_id % 3 = 1 AND doc_id % 2 = 0 AND (doc_id % 8 <> 0 OR doc_id % 16 = 0))]) AS n FROM documents""",
}
