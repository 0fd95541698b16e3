"""The store's tables and the batch's stages on the driver's tables: merges, dead letters, repeated output, backfills, parsing, fetching."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from groundtable import schemas
from groundtable.operators import keyed, overlay, queues, store
from groundtable.plans import batch
from groundtable.plans.keeping import event_failures
from groundtable.plans.reading import hinted, hinted_sql
from groundtable.session import dealt, shared_dir, table
from groundtable.sources import hits

DOM = '<div aria-label="وصف العقار" a><div b> <span c>flat &amp; garden '


def fresh_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4()}"


def keyed_merge(spark: SparkSession, d: str) -> DataFrame:
    """A keyed table of orders after a merge of some columns, defaults for what it adds, and an insert that leaves known keys alone."""
    base = table(spark, d, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice", "o_orderpriority")
    t = keyed.Keyed(spark, fresh_path(spark, "orders"), "o_orderkey long, o_orderstatus string, o_totalprice double, o_orderpriority string", ("o_orderkey",))
    keyed.replace_all(t, base)
    changed = base.filter("o_orderkey % 10 = 0").select("o_orderkey", F.when(F.col("o_orderkey") % 20 != 0, F.lit("U")).alias("o_orderstatus"))
    new = base.filter("o_orderkey % 100 = 1").select((F.col("o_orderkey") + 100_000_000).alias("o_orderkey"), F.lit("N").alias("o_orderstatus"))
    keyed.merge(t, changed.union(new), {"o_orderpriority": F.lit("new")})
    more = base.filter("o_orderkey % 50 = 2").withColumn("o_orderkey", F.when(F.col("o_orderkey") % 100 == 2, F.col("o_orderkey") + 200_000_000).otherwise(F.col("o_orderkey")))
    more = more.withColumn("o_orderstatus", F.lit("I"))
    keyed.insert(t, more.union(more.withColumn("o_totalprice", F.col("o_totalprice") - 1)), [F.col("o_totalprice")])
    return keyed.read(t)


def dead_letters(spark: SparkSession, d: str) -> DataFrame:
    """Events as dead letters, half of them logged first and all of them then: each once, with dense ids in the order they came."""
    rows = event_failures(spark, d, "ts", "event_id").withColumn("listing_id", F.col("listing_id").cast("string"))
    folder = fresh_path(spark, "store")
    t = batch.opened(spark, folder, "failures")
    keyed.log(t, rows.filter("event_id % 2 = 0"))
    keyed.log(t, rows)
    return batch.load(spark, folder, "failures").select("id", "listing_id", "stage", "error_class", "message", F.unix_micros(F.col("ts").cast("timestamp")).alias("micros"))


def extract_repeated(spark: SparkSession, d: str) -> DataFrame:
    """Several landed outputs for an order, some unreadable: the last that can be read counts, and each that can't is a letter."""
    k = F.col("o_orderkey")
    orders = table(spark, d, "orders").select(k, k.cast("string").alias("listing_id"))
    records = store.migrate(orders.select("listing_id", F.lit("by Acme and Beta").alias("description_raw")), spark, schemas.RECORDS)
    outputs = {0: ["Acme", None, "Beta"], 1: ["Acme", None, None], 2: [None, None, None], 3: ["Acme"]}
    said = lambda x: F.lit("no answer" if x is None else f'{{"developer_name": "{x}"}}')
    given = [F.when(k % 4 == m, F.array(*map(said, xs))) for m, xs in outputs.items()]
    landed = orders.select("listing_id", F.lit("v1").alias("prompt_version"), F.lit("m").alias("model"), F.posexplode(F.coalesce(*given)).alias("at", "raw_json"))
    landed = landed.withColumn("ts", F.timestamp_seconds((F.col("at") + 1) * 86400)).drop("at")
    empty = spark.createDataFrame([], schemas.EXTRACTIONS)
    updates, log, letters = batch.extract(records, empty, store.migrate(landed, spark, schemas.EXTRACTIONS), "v1", "m", most_failed=1.0)
    kept = store.upsert(records, updates, ["listing_id"]).select("listing_id", "developer_name")
    logged = log.select("listing_id", "error", F.dayofmonth("ts").alias("day"))
    counted = letters.groupBy("listing_id").agg(F.count(F.lit(1)).alias("letters"))
    return kept.join(dealt(logged), "listing_id").join(dealt(counted), "listing_id", "left")


def backfill_changes(spark: SparkSession, d: str) -> DataFrame:
    """How many values of each column a backfill changes on records that were extracted, with hints partly in the records, partly in the hits."""
    k = F.col("listing_id")
    rows = hinted(spark, d).withColumns({
        "finishing_level": F.when(k % 4 == 0, "ultra lux").when(k % 4 == 1, "Super Lux").when(k % 4 == 2, "furnished"), "delivery_status": F.when(k % 3 == 0, "Ready now").when(k % 3 == 1, "off-plan"),
        "payment_type": F.when(k % 10 == 0, "barter").when(k % 10 < 4, "Cash").when(k % 10 < 7, "both").otherwise("installments"), "cash_discount_pct": F.when(k % 13 == 0, 5.0),
        "total_installment_cost": F.when(k % 8 == 0, 1.0), "extracted_at": F.when(k % 11 != 0, F.timestamp_seconds(F.lit(0))),
    })
    extra = F.struct(F.col("hint_ownership").alias("ownership"), F.col("hint_monthly_installment").alias("monthly_installment"), F.col("hint_installment_years").alias("installments_payment_duration_years"))
    listings = rows.select(k.cast("string").alias("listing_id"), F.to_json(F.struct(extra.alias("extraFields"))).alias("hit_json"))
    records = rows.withColumns({"hint_ownership": F.when(k % 2 == 0, F.col("hint_ownership")), "hint_monthly_installment": F.lit(None).cast("double")}).withColumn("listing_id", k.cast("string"))
    _, counts = overlay.backfill(store.migrate(records, spark, schemas.RECORDS), listings)
    return counts.unpivot([], [*overlay.TOUCHED], "column", "n")


def stated_hits(spark: SparkSession, d: str) -> DataFrame:
    """Customers as search hits, parsed to the columns that a hit states: some fields missing, empty, zero or of a later duplicate."""
    k, price = F.col("c_custkey"), F.col("c_acctbal")
    place = lambda level, name, local: F.struct(F.lit(level).alias("level"), name.alias("name"), local.alias("name_l1"))
    kind = lambda level, name: F.struct(F.lit(level).alias("level"), name.alias("nameSingular_l1"), F.lit("x").alias("name_l1"))
    hit = F.struct(
        k.cast("string").alias("externalID"), F.when(k % 3 == 0, "for-sale").when(k % 3 == 1, "for-rent").otherwise("swap").alias("purpose"),
        F.array(kind(0, F.lit("land")), kind(1, F.when(k % 4 == 0, "Studio").when(k % 4 == 1, "Twin House").otherwise("Castle"))).alias("category"),
        F.array(place(0, F.lit("e"), F.lit("E")), place(1, F.lit("c"), F.lit("Cairo")), place(2, F.lit("n"), F.lit("First")), place(2, F.lit("m"), F.lit("Last")), place(4, F.col("c_name"), F.when(k % 2 == 0, "Taj Compound").otherwise(""))).alias("location"),
        F.when(k % 10 != 0, price).alias("price"), (k % 5 + 0.9).alias("rooms"), (k % 3).cast("double").alias("baths"), F.when(k % 6 != 0, (k % 100).cast("double")).alias("area"), F.lit("monthly").alias("rentFrequency"),
        F.struct(F.col("c_mktsegment").alias("name"), F.when(k % 2 == 0, F.lit("")).otherwise(F.lit("Agency")).alias("name_l1")).alias("agency"), F.when(k % 4 < 2, k % 4 == 0).alias("isVerified"),
        F.when(k % 9 != 0, (k % 10_000) * 86400.0).otherwise(0.0).alias("createdAt"), F.lit("done").alias("completionStatus"), F.lit("no").alias("furnishingStatus"), F.when(k % 2 == 1, price / 10).alias("downPayment"),
        F.when(k % 3 == 0, F.array(F.lit("pool"), F.lit("gym"))).alias("amenities_l1"), F.struct(F.lit("primary").alias("ownership"), F.when(k % 4 == 2, 7.0).alias("monthly_installment"), F.lit(3.0).alias("installments_payment_duration_years")).alias("extraFields"),
    )
    rows = table(spark, d, "customer").select(k.cast("string").alias("listing_id"), F.lit("u").alias("url"), F.when(k % 50 == 7, F.lit("{broken")).otherwise(F.to_json(hit)).alias("hit_json"))
    return hits.stated_columns(hits.parse_hits(rows)).drop("url", "currency").withColumn("hint_amenities", F.array_join("hint_amenities", ","))


def parse_batch(spark: SparkSession, d: str) -> DataFrame:
    """Pages through the batch: new and changed ones with a hit become records, others are dead letters, unchanged ones are left alone."""
    k = F.col("page_id")
    rows = table(spark, d, "pages").select(k, k.cast("string").alias("listing_id"), F.concat(F.lit(DOM), k.cast("string"), F.lit("</span></div>"), F.col("html")).alias("html"))
    pages = store.migrate(rows.select("listing_id", "html", F.sha2("html", 256).alias("content_hash")), spark, schemas.PAGES)
    seen = rows.filter("page_id % 3 <> 2").select("listing_id", F.when(k % 3 == 0, F.sha2("html", 256)).alias("content_hash"))
    hit = F.struct(F.when(k % 5 != 1, k * 10.0).alias("price"), F.lit("for-sale").alias("purpose"), (k % 4).cast("double").alias("area"))
    listings = rows.filter("page_id % 5 <> 0").select("listing_id", F.lit("u").alias("url"), F.to_json(hit).alias("hit_json"))
    updates, letters = batch.parse(listings, pages, store.migrate(seen, spark, schemas.RECORDS))
    kept = updates.select("listing_id", F.lit("record").alias("outcome"), "purpose", "price_per_sqm", "language", "description_raw")
    return kept.union(letters.select("listing_id", F.col("error_class"), F.lit(None).cast("string"), F.lit(None).cast("double"), F.lit(None).cast("string"), F.lit(None).cast("string")))


def pending_fetch(spark: SparkSession, d: str) -> DataFrame:
    """The first 300 documents to fetch, spread over places and languages; some come twice, some are there, some have failed too often."""
    k = F.col("doc_id")
    where = lambda n: F.when(n % 4 == 0, "القاهرة").when(n % 4 == 1, "Cairo").when(n % 4 == 2, " Giza ")
    docs = table(spark, d, "documents").select(k, k.cast("string").alias("listing_id"), F.col("lang").alias("purpose"), (k % 97).alias("discovered_at"))
    listings = docs.withColumn("governorate", where(k)).union(docs.filter("doc_id % 6 = 0").withColumns({"discovered_at": F.col("discovered_at") + 100, "governorate": where(k + 1)}))
    there = table(spark, d, "labels").select(k.cast("string").alias("listing_id"))
    failed = event_failures(spark, d).withColumn("listing_id", F.col("listing_id").cast("string"))
    return queues.pending_fetch(listings, there, failed, 300).select("listing_id", "governorate", "purpose", "discovered_at")


QUERIES = {f.__name__: f for f in (keyed_merge, dead_letters, extract_repeated, backfill_changes, stated_hits, parse_batch, pending_fetch)}
ORACLE_SQL = {
    "keyed_merge": """
SELECT o_orderkey, CASE WHEN o_orderkey % 20 = 0 THEN NULL WHEN o_orderkey % 10 = 0 THEN 'U' ELSE o_orderstatus END AS o_orderstatus, o_totalprice, o_orderpriority FROM orders
UNION ALL SELECT o_orderkey + 100000000, 'N', NULL, 'new' FROM orders WHERE o_orderkey % 100 = 1
UNION ALL SELECT o_orderkey + 200000000, 'I', o_totalprice - 1, o_orderpriority FROM orders WHERE o_orderkey % 100 = 2""",
    "dead_letters": """
WITH e AS (SELECT CASE WHEN event_id % 50 <> 0 THEN CAST(user_id AS VARCHAR) END AS listing_id, 'fetch' AS stage, CASE WHEN event_id % 11 <> 0 THEN event_type END AS error_class, props AS message, epoch_us(ts) AS micros,
  event_id % 2 AS later FROM events),
l AS (SELECT listing_id, stage, error_class, message, micros, min(later) AS later FROM e GROUP BY ALL)
SELECT row_number() OVER (ORDER BY later, listing_id NULLS FIRST, stage, error_class NULLS FIRST, message NULLS FIRST, micros NULLS FIRST) AS id, listing_id, stage, error_class, message, micros FROM l""",
    "extract_repeated": """
SELECT CAST(o_orderkey AS VARCHAR) AS listing_id, CASE m WHEN 0 THEN 'Beta' WHEN 2 THEN NULL ELSE 'Acme' END AS developer_name, CASE WHEN m = 2 THEN 'no JSON object' END AS error,
  CAST(CASE WHEN m IN (0, 2) THEN 4 ELSE 2 END AS INTEGER) AS day, CAST(CASE m WHEN 0 THEN 1 WHEN 1 THEN 2 WHEN 2 THEN 3 END AS BIGINT) AS letters FROM (SELECT o_orderkey, o_orderkey % 4 AS m FROM orders)""",
    "backfill_changes": hinted_sql()
    + """
, b AS (SELECT o.*, k, price, purpose, amount AS a0, dp AS d0, CASE WHEN k % 8 = 0 THEN 1.0 END AS t0 FROM o JOIN h ON k = listing_id WHERE k % 11 <> 0),
t AS (SELECT *, CASE WHEN purpose IS DISTINCT FROM 'rent' THEN round(down_payment_amount + installment_amount * CASE installment_frequency WHEN 'monthly' THEN 12.0 WHEN 'quarterly' THEN 4.0 WHEN 'annual' THEN 1.0 END * installment_years, 2) END AS total FROM b)
SELECT unnest(['compound_name', 'sale_type', 'installment_amount', 'installment_frequency', 'installment_years', 'down_payment_amount', 'down_payment_pct', 'cash_discount_pct', 'total_installment_cost', 'finishing_level',
  'delivery_status', 'payment_type']) AS "column", unnest([count(*) FILTER (compound_name IS DISTINCT FROM c0), count(*) FILTER (sale_type IS DISTINCT FROM s0), count(*) FILTER (installment_amount IS DISTINCT FROM a0),
  count(*) FILTER (installment_frequency IS DISTINCT FROM f0), count(*) FILTER (installment_years IS DISTINCT FROM y0), count(*) FILTER (down_payment_amount IS DISTINCT FROM d0), count(down_payment_amount / nullif(price, 0)),
  count(*) FILTER (k % 13 = 0 AND purpose = 'rent'), count(*) FILTER (total IS DISTINCT FROM t0), count(*) FILTER (k % 4 < 2), count(*) FILTER (k % 3 = 0), count(*) FILTER (k % 10 < 4)]) AS n FROM t""",
    "stated_hits": """
WITH c AS (SELECT c_custkey AS k, CASE WHEN c_custkey % 50 <> 7 THEN c_custkey END AS g, * FROM customer)
SELECT CAST(k AS VARCHAR) AS listing_id, CASE g % 3 WHEN 0 THEN 'sale' WHEN 1 THEN 'rent' WHEN 2 THEN 'swap' END AS purpose, CASE g % 4 WHEN 0 THEN 'studio' WHEN 1 THEN 'villa' ELSE 'other' END AS property_type,
  CASE WHEN g % 10 <> 0 THEN c_acctbal END AS price, CASE WHEN g % 3 = 1 THEN 'monthly' END AS price_period, CAST(CASE WHEN g % 4 = 0 THEN 0 ELSE g % 5 END AS INTEGER) AS bedrooms, CAST(g % 3 AS INTEGER) AS bathrooms,
  CAST(CASE WHEN g % 6 <> 0 THEN g % 100 END AS DOUBLE) AS area_sqm, CASE WHEN g IS NOT NULL THEN 'c > n > m > ' || c_name END AS location_raw, CASE g % 2 WHEN 0 THEN c_mktsegment WHEN 1 THEN 'Agency' END AS agency_name,
  coalesce(g % 4 = 0, FALSE) AS is_verified, CASE WHEN g % 9 <> 0 AND g % 10000 <> 0 THEN DATE '1970-01-01' + CAST(g % 10000 AS INTEGER) END AS date_listed, CASE WHEN g IS NOT NULL THEN 'Cairo' END AS governorate,
  CASE WHEN g IS NOT NULL THEN 'Last' END AS city, CAST(NULL AS VARCHAR) AS district, CASE WHEN g IS NOT NULL THEN 'done' END AS hint_completion_status, CASE WHEN g IS NOT NULL THEN 'primary' END AS hint_ownership,
  CASE WHEN g % 2 = 1 THEN c_acctbal / 10 END AS hint_down_payment, CASE WHEN g IS NOT NULL THEN 'no' END AS hint_furnishing_status, CASE WHEN g % 3 = 0 THEN 'pool,gym' ELSE '' END AS hint_amenities,
  CASE g % 2 WHEN 0 THEN 'Taj' WHEN 1 THEN c_name END AS hint_compound_name, CASE WHEN g % 4 = 2 THEN CAST(7 AS DOUBLE) END AS hint_monthly_installment, CASE WHEN g IS NOT NULL THEN CAST(3 AS DOUBLE) END AS hint_installment_years FROM c""",
    "parse_batch": """
SELECT CAST(page_id AS VARCHAR) AS listing_id, outcome, CASE WHEN kept THEN 'sale' END AS purpose, CASE WHEN kept THEN round(page_id * 10 / nullif(page_id % 4, 0), 2) END AS price_per_sqm, CASE WHEN kept THEN 'en' END AS language,
  CASE WHEN kept THEN 'flat & garden ' || page_id END AS description_raw
FROM (SELECT page_id, CASE page_id % 5 WHEN 0 THEN 'missing_hit' WHEN 1 THEN 'sanity' ELSE 'record' END AS outcome, page_id % 5 > 1 AS kept FROM pages WHERE page_id % 3 <> 0)""",
    "pending_fetch": """
WITH d AS (SELECT doc_id AS k, CAST(doc_id AS VARCHAR) AS listing_id, lang AS purpose, doc_id % 97 AS discovered_at FROM documents),
l AS (SELECT *, k AS w FROM d UNION ALL SELECT k, listing_id, purpose, discovered_at + 100, k + 1 FROM d WHERE k % 6 = 0),
f AS (SELECT CAST(user_id AS VARCHAR) AS id FROM events WHERE event_id % 11 <> 0 AND event_id % 50 <> 0 AND event_type NOT IN ('blocked', 'timeout') GROUP BY 1 HAVING count(*) >= 3),
n AS (SELECT *, CASE w % 4 WHEN 0 THEN 'القاهرة' WHEN 1 THEN 'Cairo' WHEN 2 THEN ' Giza ' END AS governorate, CASE w % 4 WHEN 2 THEN 'Giza' WHEN 3 THEN 'Unknown' ELSE 'Cairo' END AS canon FROM l
  WHERE k NOT IN (SELECT doc_id FROM labels) AND listing_id NOT IN (SELECT id FROM f) QUALIFY row_number() OVER (PARTITION BY listing_id ORDER BY discovered_at) = 1)
SELECT listing_id, governorate, purpose, discovered_at FROM (SELECT *, row_number() OVER (PARTITION BY canon, purpose ORDER BY discovered_at, listing_id) AS turn FROM n) ORDER BY turn, canon, purpose LIMIT 300""",
}
