"""Scalar functions on hand-made vectors, traps included."""

import math

import pytest
from pyspark.sql import functions as F

from groundtable.functions import enums, matching, money, numbers, text

AR_MILLION, AR_THOUSAND = "مليون", "الف"


def column(spark, values, body, kind="string"):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, x {kind}")
    return [r.y for r in rows.select("i", body(F.col("x")).alias("y")).orderBy("i").collect()]


def test_numbers(spark):
    cases = {
        "1,500,000 EGP": 1.5e6, "1.5M": 1.5e6, f"{AR_MILLION} ونصف": 1.5e6, f"3 {AR_MILLION}": 3e6, "1.5 مليار": 1.5e9, AR_MILLION: None, "": None, None: None,
        "5 months": 5e6, f"1,500 {AR_THOUSAND}": 5e5, "٢٥٠ ألف": 2.5e5, f"واحد {AR_MILLION}": 1e6, f"تلاتة {AR_MILLION}": None, "soon": None, "2 km": 2e3,
    }
    assert column(spark, list(cases), numbers.parse_number) == list(cases.values())


def test_numbers_put_right(spark):
    cases = {"5 months": 5.0, f"1,500 {AR_THOUSAND}": 1.5e6, f"تلاتة {AR_MILLION}": 3e6, "2 km": 2.0, "2k": 2e3, "1.5M": 1.5e6}
    assert column(spark, list(cases), lambda c: numbers.parse_number(c, faithful=False)) == list(cases.values())


def test_percentages_and_dates(spark):
    assert column(spark, ["10%", "10 في المية", "12.5 %", "no", None], numbers.parse_percentage) == [10.0, 10.0, 12.5, None, None]
    dates = {"2027": "2027", "Q1 2028": "2028-Q1", "soon": None, "1999": None, "2000000": "2000", "الربع الثالث 2029": "2029-Q2", "2029 الربع الثالث": "2029-Q3", None: None}
    assert column(spark, list(dates), numbers.parse_delivery_date) == list(dates.values())
    assert column(spark, ["2000000", "by 2027.", "الربع الثالث 2029"], lambda c: numbers.parse_delivery_date(c, faithful=False)) == [None, "2027", "2029-Q3"]


def test_language(spark):
    cases = {"شقة": "ar", "flat": "en", "123 !": None, "": None, None: None, "a" * 85 + "ب" * 15: "en", "a" * 84 + "ب" * 16: "mixed", "aب": "mixed"}
    assert column(spark, list(cases), text.detect_language) == list(cases.values())


def test_letters(spark):
    assert column(spark, [" أحمـَد ة٧ ", None, "ﷺ"], text.clean_arabic)[:2] == ["احمد ه7", None]
    assert column(spark, ["١٢۳", "a1"], text.to_ascii_digits) == ["123", "a1"]
    names = {"Taj City Compound": "Taj City", "كومباوند هايد بارك": "هايد بارك", "Project": "Project", "": None, None: None, "Compounding": "Compounding"}
    assert column(spark, list(names), text.clean_compound) == list(names.values())


def test_markup(spark):
    assert column(spark, ["a<br/>b<BR><i>c</i> &amp;lt; &quot;d&quot; ", None], text.strip_markup) == ['a\nbc &lt; "d"', None]
    assert column(spark, ["&eacute;&amp;"], lambda c: text.strip_markup(c, all_entities=True)) == ["é&"]


def test_enums(spark):
    field = lambda f: lambda c: enums.canon_enum(f, c)
    assert column(spark, ["Cash or installments", "both", "barter", "", None, "بالتقسيط"], field("payment_type")) == ["cash", "both", None, None, None, "installments"]
    assert column(spark, ["unfurnished", "Super Lux", "تشطيب سوبر لوكس"], field("finishing_level")) == ["furnished", "super lux", "super lux"]
    assert column(spark, [" Twin House ", "castle", None], enums.property_type) == ["villa", "other", "other"]
    assert column(spark, ["الإسكندرية", " ", None, "Luxor"], text.canonical_governorate) == ["Alexandria", "Unknown", "Unknown", "Luxor"]


@pytest.mark.parametrize(("price", "area", "expected"), [(100.0, 0.0, None), (100.0, None, None), (None, 5.0, None), (100.0, 3.0, 100 / 3)])
def test_unit_price(spark, price, area, expected):
    got = spark.createDataFrame([(price, area)], "p double, a double").select(money.unit_price(F.col("p"), F.col("a")).alias("y")).first().y
    assert got is None if expected is None else math.isclose(got, expected)


def test_plan_total(spark):
    rows = [(10.0, 2.0, "monthly", 1.0), (10.0, 2.0, "weekly", 1.0), (None, 2.0, "annual", 1.0), (10.0, 2.0, "quarterly", 2.0)]
    df = spark.createDataFrame(rows, "d double, a double, f string, y double")
    assert [r.t for r in df.select(money.plan_total(*map(F.col, "dafy")).alias("t")).collect()] == [34.0, None, None, 26.0]


def test_matching(spark):
    df = spark.createDataFrame([("100", "105"), ("100", "105.1"), ("0", "0"), ("0", "1"), ("x", "1"), (None, "1")], "g string, p string")
    assert [r.m for r in df.select(matching.numeric_match(F.col("g"), F.col("p")).alias("m")).collect()] == [True, False, True, False, False, False]
    lists = spark.createDataFrame([("a; b", "b,a,c"), ("Pool", "pool"), ("", ""), ("a,b", "b,c,d")], "g string, p string")
    assert [r.m for r in lists.select(matching.jaccard_match(matching.split_list(F.col("g")), matching.split_list(F.col("p"))).alias("m")).collect()] == [True, True, True, False]


def test_every_reference(spark):
    """As the standard library resolves them: names with and without semicolons, numbers of every kind, and what is no reference."""
    import html
    import random
    from html.entities import html5

    rng = random.Random(1)
    cases = [f"&{n}" for n in html5] + [f"&{n.rstrip(';')}x y" for n in list(html5)[:200]] + [f"&#{n};" for n in (*range(300), 0xD800, 0xFDD0, 0xFEFF, 0xFFFE, 0x1FFFE, 0x10FFFF, 0x110000, 10**12, 10**45)]
    cases += [f"&#x{n:x}" for n in (*range(300), 0x1F600, 0x110000)] + ["&#0065", "&#x41z", f"&#{'0' * 60}65;", "&amp;lt;", "&notit;", "&&lt;&", "&#;", "&#xG;", "&" + "a" * 40 + ";", "", "&"]
    cases += ["".join(rng.choice(["&", "#", "x", "amp", "lt", "no", "t", ";", " ", "1", "4", "é", "not", "in", "copy", "\n"]) for _ in range(rng.randrange(12))) for _ in range(800)]
    assert column(spark, cases, text.unescape) == [html.unescape(c) for c in cases]
    assert column(spark, ["&lt;&eacute;&amp;lt;"], lambda c: text.unescape(c, all_=False)) == ["<&eacute;&lt;"]


def test_no_python_in_markup(spark):
    plan = spark.range(1).select(text.strip_markup(F.col("id").cast("string")).alias("x"))._jdf.queryExecution().toString()
    assert "EvalPython" not in plan and "InArrow" not in plan and "InPandas" not in plan


def test_composed_together(spark):
    values = ["ﬁ", None, "e\u0301", "", "\u0301x"]
    df = spark.createDataFrame([tuple(values)], ", ".join(f"c{i} string" for i in range(5)))
    assert list(df.select(*text.nfkc_all([F.col(c) for c in df.columns])).first()) == ["fi", None, "é", "", "\u0301x"]


def test_page_text_by_its_sql_on_odd_pages(spark, tmp_path):
    """Cut references, references that are not common, odd spaces: the query gives what its SQL gives; the library's own form resolves them all."""
    import duckdb

    from groundtable.plans import catalog

    pages = ["<title>a &amp;&amp</title><style>p{}</style>", "&copy 1 &eacute; &#39;x&#39; &amp;#39; &amp;lt;", "\x0b a<br\x0b/>b \x0b", " a<BR>b<br\n/>c  ", " &nbsp; x ", "", None, "&#65;&notit;&"]
    spark.createDataFrame(list(enumerate(pages)), "page_id long, html string").coalesce(1).write.parquet(f"{tmp_path}/pages.parquet")
    got = sorted(tuple(r) for r in catalog.QUERIES["strip_markup"](spark, str(tmp_path)).select("page_id", "digest", "chars").collect())
    c = duckdb.connect()
    c.execute(f"CREATE VIEW pages AS SELECT * FROM '{tmp_path}/pages.parquet/*.parquet'")
    assert got == sorted(c.execute(catalog.ORACLE_SQL["strip_markup"]).fetchall())
    assert column(spark, pages[:1], text.strip_markup) == ["a &&p{}"]
