"""Unit prices, instalment plans and their report."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from groundtable.functions.money import plan_total, unit_price
from groundtable.operators import report
from groundtable.operators.order import quantiles
from groundtable.session import stored, table


def median_unit_price_by_segment(spark: SparkSession, d: str) -> DataFrame:
    """The headline question: exact median, range and number of unit prices by segment."""
    line = table(spark, d, "lineitem").select("l_orderkey", "l_extendedprice", "l_quantity")
    order = table(spark, d, "orders").select("o_orderkey", "o_custkey")
    who = table(spark, d, "customer").select("c_custkey", "c_mktsegment")
    prices = (
        line.join(order, F.col("l_orderkey") == F.col("o_orderkey"))
        .join(who, F.col("o_custkey") == F.col("c_custkey"))
        .select(F.col("c_mktsegment").alias("segment"), unit_price(F.col("l_extendedprice"), F.nullif("l_quantity", F.lit(1.0))).alias("p"))
    )
    prices = stored(prices, "prices")  # looked at twice, joined once
    return quantiles(prices, ["segment"], "p").select("segment", F.col("q0").alias("median_price"), F.col("least").alias("min_price"), F.col("most").alias("max_price"), "n")


def unit_prices_by_city(spark: SparkSession, d: str) -> DataFrame:
    """Parts as three-bedroom apartments for sale and what is not, their brands as cities, some without an area."""
    k = F.col("p_partkey")
    rows = table(spark, d, "part").select(
        F.when(k % 10 != 0, "sale").otherwise("rent").alias("purpose"), F.when(k % 7 != 0, "apartment").alias("property_type"), F.when(k % 6 != 0, 3).otherwise(2).alias("bedrooms"),
        F.when(F.col("p_size") > 5, F.col("p_brand")).alias("city"), F.col("p_retailprice").alias("price"), F.nullif(F.col("p_size").cast("double"), F.lit(9.0)).alias("area_sqm"),
    )
    return report.unit_prices(rows)


def unit_price_null_safe(spark: SparkSession, d: str) -> DataFrame:
    """A unit price for every line, null where the quantity is unknown."""
    p = unit_price(F.col("l_extendedprice"), F.nullif("l_quantity", F.lit(1.0)))
    return table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", p.alias("unit_price"))


def plans(spark: SparkSession, d: str) -> DataFrame:
    """Orders as instalment plans: two priorities stand for no known frequency."""
    o = table(spark, d, "orders")
    frequency = F.when(F.col("o_orderpriority").startswith("1"), "monthly").when(F.col("o_orderpriority").startswith("2"), "quarterly").when(F.col("o_orderpriority").startswith("3"), "annual")
    years = F.nullif(F.pmod("o_orderkey", F.lit(5)), F.lit(0)).cast("double")
    a_year = F.when(frequency == "monthly", 12.0).when(frequency == "quarterly", 4.0).otherwise(1.0)
    amount = F.col("o_totalprice") * 0.85 / (a_year * F.coalesce(years, F.lit(1.0)))
    return o.select(
        F.col("o_orderkey").alias("listing_id"), F.col("o_totalprice").alias("price"), (F.col("o_totalprice") * 0.1).alias("down_payment_amount"), F.lit(None).cast("double").alias("down_payment_pct"),
        amount.alias("installment_amount"), frequency.alias("installment_frequency"), years.alias("installment_years"),
        F.when(F.col("o_orderstatus") == "F", "cash").when(F.col("o_orderstatus") == "O", "installments").otherwise("both").alias("payment_type"),
    ).withColumn("total_installment_cost", plan_total(F.col("down_payment_amount"), F.col("installment_amount"), F.col("installment_frequency"), F.col("installment_years")))


PLANS = """
plans AS (SELECT *, dp + amount * CASE frequency WHEN 'monthly' THEN 12.0 WHEN 'quarterly' THEN 4.0 WHEN 'annual' THEN 1.0 END * years AS total FROM (
  SELECT o_orderkey AS id, o_totalprice AS price, o_totalprice * CAST(0.1 AS DOUBLE) AS dp, frequency, years, payment_type,
    o_totalprice * CAST(0.85 AS DOUBLE) / (CASE frequency WHEN 'monthly' THEN 12.0 WHEN 'quarterly' THEN 4.0 ELSE 1.0 END * coalesce(years, 1.0)) AS amount
  FROM (SELECT *, CASE WHEN o_orderpriority LIKE '1%' THEN 'monthly' WHEN o_orderpriority LIKE '2%' THEN 'quarterly' WHEN o_orderpriority LIKE '3%' THEN 'annual' END AS frequency,
      CAST(nullif(o_orderkey % 5, 0) AS DOUBLE) AS years, CASE o_orderstatus WHEN 'F' THEN 'cash' WHEN 'O' THEN 'installments' ELSE 'both' END AS payment_type FROM orders)))"""


def plan_totals(spark: SparkSession, d: str) -> DataFrame:
    """Each plan's total, null unless all of it is known."""
    return plans(spark, d).select("listing_id", F.col("total_installment_cost").alias("total"))


def plan_disclosure_funnel(spark: SparkSession, d: str) -> DataFrame:
    """How many offer instalments, state any number, and state all."""
    return report.disclosure(plans(spark, d))


def plan_ratio_stats(spark: SparkSession, d: str) -> DataFrame:
    """Total over cash price."""
    out = report.plan_ratios(plans(spark, d))
    return out.select("n", *(F.round(c, 6).alias(c) for c in ("median", "mean", "least", "most")), "at_one", "below", "above")


def distribution_by_group(spark: SparkSession, d: str) -> DataFrame:
    """Orders by status and customers by segment."""
    a = table(spark, d, "orders").groupBy(F.lit("status").alias("kind"), F.col("o_orderstatus").alias("value")).agg(F.count(F.lit(1)).alias("n"))
    return a.union(table(spark, d, "customer").groupBy(F.lit("segment").alias("kind"), "c_mktsegment").agg(F.count(F.lit(1)).alias("n")))


def duplicate_key_check(spark: SparkSession, d: str) -> DataFrame:
    """Line keys that come more than once."""
    return report.duplicate_keys(table(spark, d, "lineitem"), ["l_orderkey", "l_linenumber"])


def attribute_coverage(spark: SparkSession, d: str) -> DataFrame:
    """Share of documents that have each attribute."""
    both = table(spark, d, "documents").select("doc_id", "lang", F.nullif("source", F.lit("src0")).alias("source"), "n_chars").join(table(spark, d, "labels"), "doc_id", "left")
    return report.coverage(both, ["doc_id", "lang", "source", "n_chars", "quality", "toxic"])


def status_counts(spark: SparkSession, d: str) -> DataFrame:
    """Documents, labelled ones, and distinct good ones."""
    docs, labels = table(spark, d, "documents"), table(spark, d, "labels")
    a = docs.agg(F.count(F.lit(1)).alias("documents"))
    b = labels.agg(F.count("quality").alias("labelled"), F.count_distinct(F.when(F.col("quality") == 1, F.col("doc_id"))).alias("good"))
    return a.crossJoin(b)


def cost_sum(spark: SparkSession, d: str) -> DataFrame:
    """Sums of costs and tokens by model; a model without a rate costs nothing known."""
    from groundtable.sources.extractions import with_cost

    rows = table(spark, d, "orders").select(F.col("o_orderpriority").alias("model"), F.col("o_orderkey").alias("tokens_in"), F.col("o_custkey").alias("tokens_out"))
    rates = {"1-URGENT": (0.5, 1.5), "2-HIGH": (0.25, 0.75), "5-LOW": (0.05, 0.4)}
    costed = with_cost(rows, rates)
    return costed.groupBy("model").agg(F.round(F.coalesce(F.sum("cost_usd"), F.lit(0.0)), 4).alias("cost_usd"), F.coalesce(F.sum("tokens_in"), F.lit(0)).alias("tokens_in"), F.coalesce(F.sum("tokens_out"), F.lit(0)).alias("tokens_out"))


QUERIES = {
    f.__name__: f
    for f in (median_unit_price_by_segment, unit_price_null_safe, plan_disclosure_funnel, plan_ratio_stats, distribution_by_group, duplicate_key_check, attribute_coverage, status_counts, cost_sum, unit_prices_by_city)
} | {"plan_total": plan_totals}
ORACLE_SQL = {
    "median_unit_price_by_segment": """
SELECT c_mktsegment AS segment, median(p) AS median_price, min(p) AS min_price, max(p) AS max_price, count(p) AS n
FROM (SELECT c_mktsegment, l_extendedprice / nullif(nullif(l_quantity, 1), 0) AS p
      FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey)
GROUP BY c_mktsegment""",
    "unit_prices_by_city": """
SELECT CASE WHEN p_size > 5 THEN p_brand END AS city, median(p) AS median, min(p) AS least, max(p) AS most, count(p) AS n FROM (SELECT *, p_retailprice / nullif(p_size, 9) AS p FROM part)
WHERE p_partkey % 10 <> 0 AND p_partkey % 7 <> 0 AND p_partkey % 6 <> 0 GROUP BY 1""",
    "unit_price_null_safe": "SELECT l_orderkey, l_linenumber, l_extendedprice / nullif(nullif(l_quantity, 1), 0) AS unit_price FROM lineitem",
    "plan_total": f"WITH {PLANS} SELECT id AS listing_id, total FROM plans",
    "plan_disclosure_funnel": f"""
WITH {PLANS} SELECT count(*) FILTER (payment_type IN ('installments', 'both')) AS offered,
  count(*) FILTER (payment_type IN ('installments', 'both') AND coalesce(dp, amount, years) IS NOT NULL) AS any_number,
  count(*) FILTER (payment_type IN ('installments', 'both') AND total IS NOT NULL) AS computable FROM plans""",
    "plan_ratio_stats": f"""
WITH {PLANS}, r AS (SELECT total / nullif(price, 0) AS r FROM plans WHERE total / nullif(price, 0) IS NOT NULL)
SELECT count(*) AS n, round(median(r), 6) AS median, round(avg(r), 6) AS mean, round(min(r), 6) AS least, round(max(r), 6) AS most,
  count(*) FILTER (abs(r - 1) < 5e-4) AS at_one, count(*) FILTER (r < 0.9) AS below, count(*) FILTER (r > 1.02) AS above FROM r""",
    "distribution_by_group": """
SELECT 'status' AS kind, o_orderstatus AS value, count(*) AS n FROM orders GROUP BY ALL
UNION ALL SELECT 'segment', c_mktsegment, count(*) FROM customer GROUP BY ALL""",
    "duplicate_key_check": "SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY ALL HAVING count(*) > 1",
    "attribute_coverage": """
WITH b AS (SELECT d.doc_id, lang, nullif(source, 'src0') AS source, n_chars, quality, toxic FROM documents d LEFT JOIN labels USING (doc_id)),
o AS (SELECT count(*) AS n, count(doc_id) a, count(lang) b, count(source) c, count(n_chars) d, count(quality) e, count(toxic) f FROM b)
SELECT unnest(['doc_id', 'lang', 'source', 'n_chars', 'quality', 'toxic']) AS "column", unnest([a / n, b / n, c / n, d / n, e / n, f / n]) AS share FROM o""",
    "status_counts": """
SELECT (SELECT count(*) FROM documents) AS documents, (SELECT count(quality) FROM labels) AS labelled,
  (SELECT count(DISTINCT doc_id) FROM labels WHERE quality = 1) AS good""",
    "cost_sum": """
SELECT o_orderpriority AS model, round(coalesce(sum(round((o_orderkey * i + o_custkey * o) / 1e6, 6)), 0), 4) AS cost_usd,
  CAST(sum(o_orderkey) AS BIGINT) AS tokens_in, CAST(sum(o_custkey) AS BIGINT) AS tokens_out
FROM orders LEFT JOIN (VALUES ('1-URGENT', CAST(0.5 AS DOUBLE), CAST(1.5 AS DOUBLE)), ('2-HIGH', 0.25, 0.75), ('5-LOW', 0.05, 0.4)) r(m, i, o) ON m = o_orderpriority
GROUP BY o_orderpriority""",
}
