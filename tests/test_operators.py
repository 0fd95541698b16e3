"""Keyed tables, queues, grounding, overlay and scoring on small tables."""

from pyspark.sql import functions as F

from groundtable import schemas
from groundtable.operators import export, grounding, overlay, queues, scoring, store
from groundtable.sources import extractions, gold


def test_upsert(spark):
    old = spark.createDataFrame([(1, "a", "x"), (2, "b", "y"), (None, "n", "z")], "k int, v string, w string")
    new = spark.createDataFrame([(2, None), (3, "c"), (None, "m")], "k int, v string")
    once = store.upsert(old, new, ["k"], {"w": F.lit("now")})
    expected = {(1, "a", "x"), (2, None, "y"), (3, "c", "now"), (None, "m", "z")}
    assert {tuple(r) for r in once.collect()} == expected
    assert {tuple(r) for r in store.upsert(once, new, ["k"], {"w": F.lit("later")}).collect()} == expected


def test_insert_ignore_and_failures(spark):
    old = spark.createDataFrame([(1, "a")], "k int, v string")
    batch = spark.createDataFrame([(1, "z"), (2, "b"), (2, "c")], "k int, v string")
    assert {tuple(r) for r in store.insert_ignore(old, batch, ["k"], [F.col("v")]).collect()} == {(1, "a"), (2, "b")}
    log = store.log_failures(spark.createDataFrame([], schemas.FAILURES), spark.createDataFrame([("s", "m" * 3000)], "stage string, message string"))
    assert len(log.first().message) == 2000
    assert store.migrate(batch, spark, "k int, v string, extra double").columns == ["k", "v", "extra"]


def failures(spark):
    rows = [("a", "exception")] * 3 + [("b", "exception")] * 2 + [("c", "blocked")] * 5 + [(None, "exception")] * 4 + [("d", None)] * 3
    return spark.createDataFrame([(i, "fetch", e) for i, e in rows], "listing_id string, stage string, error_class string")


def test_pending_fetch(spark):
    listings = spark.createDataFrame([(x, g, p, 1) for x, g, p in [("a", "Cairo", "s"), ("b", "Cairo", "s"), ("c", "Giza", "s"), ("d", "القاهرة", "r"), ("e", None, "s"), ("f", "Cairo", "s")]], "listing_id string, governorate string, purpose string, discovered_at int")
    pages = spark.createDataFrame([("f",)], "listing_id string")
    got = [r.listing_id for r in queues.pending_fetch(listings, pages, failures(spark)).collect()]
    assert got == ["d", "b", "c", "e"]
    assert len(queues.pending_fetch(listings, pages, failures(spark), limit=2).collect()) == 2


def test_pending_parse_and_extract(spark):
    pages = spark.createDataFrame([("a", "1"), ("b", "2"), ("c", None), ("d", "4")], "listing_id string, content_hash string")
    records = spark.createDataFrame([("a", "1"), ("b", "0"), ("c", None)], "listing_id string, content_hash string")
    assert {r.listing_id for r in queues.pending_parse(pages, records).collect()} == {"b", "d"}
    said = spark.createDataFrame([("a", "x"), ("b", "x"), ("c", None)], "listing_id string, description_raw string")
    done = spark.createDataFrame([("a", "v1", "m", None), ("b", "v1", "m", "error"), ("b", "v0", "m", None)], "listing_id string, prompt_version string, model string, error string")
    assert [r.listing_id for r in queues.pending_extract(said, done, "v1").collect()] == ["b"]
    assert len(queues.pending_extract(said, done, "v1", "other").collect()) == 2


def test_grounding(spark):
    rows = [
        (1500000.0, "Acme", "pay 1500000 to acme", [], 1500000.0, "Acme"),
        (1500000.0, "Acme", "pay 1,500,000", ["down_payment_amount", "developer_name"], None, None),
        (5.0, "Hyde Park", "١٥ سنة", [], 5.0, "Hyde Park"),
        (12.5, None, "12.5 each", [], 12.5, None),
        (1e7, "", "10000000", [], 1e7, ""),
        (7.0, "x", None, ["down_payment_amount", "developer_name"], None, None),
    ]
    df = spark.createDataFrame([(i, *r[:3]) for i, r in enumerate(rows)], "i int, down_payment_amount double, developer_name string, said string")
    for got, want in zip(grounding.ground(df, F.col("said")).orderBy("i").collect(), rows, strict=True):
        assert (got.rejected, got.down_payment_amount, got.developer_name) == want[3:]


def record(**values):
    base = {c: None for c in ("compound_name", "sale_type", "installment_frequency", "hint_compound_name", "hint_ownership", "purpose")}
    base |= {c: None for c in ("installment_amount", "installment_years", "down_payment_amount", "down_payment_pct", "cash_discount_pct", "hint_down_payment", "hint_monthly_installment", "hint_installment_years", "price")}
    return base | values


def laid_over(spark, **values):
    row = record(**values)
    texts = {"compound_name", "sale_type", "installment_frequency", "hint_compound_name", "hint_ownership", "purpose"}
    return overlay.overlay(spark.createDataFrame([tuple(row.values())], ", ".join(f"{c} {'string' if c in texts else 'double'}" for c in row))).first()


def test_overlay(spark):
    r = laid_over(spark, compound_name="Old", hint_compound_name="New", sale_type="resale", hint_ownership="Primary", hint_monthly_installment=2.0, installment_frequency="annual", hint_installment_years=1.0, down_payment_amount=10.0, hint_down_payment=99.0, price=100.0, purpose="sale")
    assert (r.compound_name, r.sale_type, r.installment_amount, r.installment_frequency, r.down_payment_amount, r.down_payment_pct, r.total_installment_cost) == ("New", "primary", 2.0, "monthly", 10.0, 10.0, 34.0)
    r = laid_over(spark, down_payment_amount=0.0, hint_monthly_installment=0.0, installment_amount=5.0, hint_ownership="unknown", sale_type="resale")
    assert (r.down_payment_amount, r.installment_amount, r.sale_type, r.total_installment_cost) == (None, 5.0, "resale", None)
    r = laid_over(spark, purpose="Rent", sale_type="resale", installment_years=3.0, hint_down_payment=50.0, price=200.0)
    assert (r.sale_type, r.installment_years, r.down_payment_amount, r.down_payment_pct) == (None, None, 50.0, 25.0)


def test_extractions(spark):
    rows = spark.createDataFrame([(1, 'Sure: {"floor_number": "3", "installment_years": "7"} done'), (2, "nothing"), (3, None), (4, '{"bad": ')], "i int, raw_json string")
    got = {r.i: r for r in extractions.parse_raw(rows).collect()}
    assert (got[1].fields.floor_number, got[1].fields.installment_years, got[1].bad) == ("3", "7", False)
    assert [got[i].bad for i in (2, 3, 4)] == [True, True, True]
    priced = extractions.with_cost(spark.createDataFrame([("m", 1000, 500), ("z", 1, 1), ("m", None, 1)], "model string, tokens_in long, tokens_out long"), {"m": (1.0, 2.0)})
    assert sorted((r.cost_usd for r in priced.collect()), key=str) == [0.002, None, None]


def test_gold_and_scores(spark, tmp_path):
    fields = schemas.names(schemas.GROUP_B)
    path = tmp_path / "gold.csv"
    blank = dict.fromkeys(fields, "")
    lines = [{"listing_id": " a "} | blank | {"city": "Giza"}, {"listing_id": "a"} | blank | {"city": " Cairo", "installment_years": "5", "amenities": "pool; gym"}, {"listing_id": "z"} | blank]
    path.write_text("﻿" + ",".join(lines[0]) + "\n" + "\n".join(",".join(x.values()) for x in lines) + "\n", encoding="utf-8")
    labels = gold.read_gold(spark, str(path))
    assert sorted(r.listing_id for r in labels.collect()) == ["a", "z"]
    records = spark.createDataFrame([("a",)], "listing_id string").withColumns({c: F.lit(None).cast(t) for c, t in spark.createDataFrame([], schemas.GROUP_B).dtypes})
    records = records.withColumns({"city": F.lit("CAIRO"), "installment_years": F.lit(5.2), "amenities": F.array(F.lit("gym")), "district": F.lit("made up")})
    got = {r.field: r for r in scoring.score_fields(labels, records).collect()}
    assert (got["city"].accuracy, got["installment_years"].accuracy, got["amenities"].accuracy) == (1.0, 1.0, 1.0)
    assert (got["district"].hallucination_rate, got["district"].accuracy, got["floor_number"].hallucination_rate) == (1.0, None, 0.0)
    assert [r.listing_id for r in scoring.unmatched(labels, records).collect()] == ["z"]
    assert "| district | 0 | 1 | n/a | 100% |" in scoring.to_markdown(scoring.score_fields(labels, records))


def test_labels_by_place_in_the_file(spark, tmp_path):
    """Of duplicates the last in file order counts, though files are read in parts and the largest first."""
    fields = ["listing_id", *schemas.names(schemas.GROUP_B)]
    line = lambda i, city: ",".join([str(i), *(city if c == "city" else "" for c in fields[1:])])
    for name, rows in (("a.csv", [line(i % 50, f"a{i}") for i in range(4000)]), ("b.csv", [line(7, "b"), line(99, "only")])):
        (tmp_path / name).write_text("\n".join([",".join(fields), *rows]) + "\n")
    size = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "16k")
    try:
        labels = gold.read_gold(spark, str(tmp_path))
        assert spark.read.csv(str(tmp_path), header=True).rdd.getNumPartitions() > 3
        got = {r.listing_id: r.city for r in labels.collect()}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
    assert got == {str(i): f"a{3950 + i}" for i in range(50)} | {"7": "b", "99": "only"}


def test_scores_in_one_shuffle(spark):
    fields = ["a", "b", "c"]
    df = spark.range(50).select(F.col("id").cast("string").alias("listing_id"), *(F.when(F.col("id") % (i + 2) != 0, F.concat(F.lit(" É "), F.col("id") % 3)).alias(c) for i, c in enumerate(fields)))
    pred = df.withColumns({"a": F.lower("a"), "b": F.lit("other")})
    wide = scoring.score_fields(df, pred, fields)
    pairs = scoring.long_form(df, "listing_id", fields, "gold").join(scoring.long_form(pred, "listing_id", fields, "pred"), ["listing_id", "field"])
    key = lambda rows: sorted(str(tuple(r)) for r in rows)
    long = scoring.tally(pairs, scoring.matches(F.col("field"))).collect()
    assert key(wide.collect()) == key(long)
    plan = scoring.score_fields(df, pred, fields)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") <= 2 and plan.count("ArrowEvalPython") == 1  # the join's own two sides, one call


def test_export(spark, tmp_path):
    records = spark.createDataFrame([], schemas.RECORDS)
    assert len(export.dataset_view(records).columns) == 39
    assert export.field_dictionary(spark).count() == 39
    assert [r.k for r in export.seeded_sample(spark.range(5).withColumnRenamed("id", "k"), "k", 9).collect()] == [0, 1, 2, 3, 4]
