"""Landed hits and pages."""

import json

from groundtable import cli, schemas
from groundtable.operators.overlay import TOUCHED
from groundtable.plans import batch
from groundtable.sources import hits, pages

HIT = {
    "externalID": "1", "purpose": "for-sale", "price": 300.0, "area": 100.0, "rooms": 3.0, "baths": 2.0, "isVerified": True, "createdAt": 86400.0, "agency": {"name": "local", "name_l1": ""},
    "category": [{"level": 0, "name_l1": "land"}, {"level": 1, "nameSingular_l1": "Apartment"}, {"level": 1, "nameSingular_l1": "Villa"}],
    "location": [{"level": 0, "name": "E"}, {"level": 1, "name": "c", "name_l1": "Cairo"}, {"level": 2, "name": "n", "name_l1": "First"}, {"level": 2, "name": "m", "name_l1": "Last"}, {"level": 4, "name": "x", "name_l1": "Taj Compound"}],
    "extraFields": {"ownership": "primary", "monthly_installment": 2.0, "installments_payment_duration_years": 1.0}, "downPayment": 10.0,
}


def stated(spark, *found):
    rows = spark.createDataFrame([(str(i), "u", h if isinstance(h, str) else json.dumps(h)) for i, h in enumerate(found)], "listing_id string, url string, hit_json string")
    return hits.stated_columns(hits.parse_hits(rows)).orderBy("listing_id").collect()


def test_hit(spark):
    a, b, c = stated(spark, HIT, HIT | {"category": [{"level": 1, "name_l1": "Studio"}], "purpose": "for-rent", "rentFrequency": "monthly", "createdAt": 0, "isVerified": None, "location": [], "rooms": 4.9}, "{broken")
    assert (a.purpose, a.property_type, a.bedrooms, a.agency_name, a.city, a.district, a.location_raw, a.hint_compound_name, str(a.date_listed)) == ("sale", "apartment", 3, "local", "Last", None, "c > n > m > x", "Taj", "1970-01-02")
    assert (b.purpose, b.price_period, b.bedrooms, b.date_listed, b.is_verified, b.location_raw) == ("rent", "monthly", 0, None, False, None)
    assert (c.price, c.purpose, c.property_type, c.is_verified) == (None, None, "other", False)


def state(data, tail=""):
    return f'<script id="browserInitialState" x>w={{"value":{data}{tail}</script>'


def test_descriptions(spark):
    said = json.dumps({"property": {"data": {"mainDescription": "one<br />two &amp; three"}}})
    ld = '<script type="application/ld+json">{"@graph": [{"mainEntity": {"description": "from ld"}}]}</script>'
    dom = '<div aria-label="وصف العقار" a><div b> <span c>from<br>dom</span></div>'
    cases = {
        state(said, "};more();") + ld: "one\ntwo & three",
        state('{"property":', "") + '<script type="application/ld+json">{bad</script>' + ld + dom: "from ld",
        dom: "from\ndom", "<html></html>": None, None: None,
    }
    rows = spark.createDataFrame([(i, h) for i, h in enumerate(cases)], "i int, html string")
    assert [r.d for r in rows.select("i", pages.description(rows.html).alias("d")).orderBy("i").collect()] == list(cases.values())


def test_blocked(spark):
    pad = "x" * 1000
    cases = {None: True, "browserInitialState": True, pad + "browserInitialState": False, pad: True, pad + 'browserInitialState"routeName":"captchaChallenge"': True, pad + '"@type":"RealEstateListing"': False}
    rows = spark.createDataFrame([(i, h) for i, h in enumerate(cases)], "i int, html string")
    assert [r.b for r in rows.select("i", pages.is_blocked(rows.html).alias("b")).orderBy("i").collect()] == list(cases.values())


def test_batch_is_idempotent(spark, tmp_path):
    store = str(tmp_path / "store")
    said = json.dumps({"property": {"data": {"mainDescription": "سعر 5 years with Acme, cash"}}})
    listings = [("a", "u", "for-sale", "Cairo", "c", json.dumps(HIT), None), ("b", "u", "for-sale", "Cairo", "c", json.dumps(HIT | {"price": None}), None)]
    spark.createDataFrame(listings, schemas.LISTINGS).write.parquet(f"{store}/listings")
    page = [(i, "u", state(said), 1, "h", None) for i in ("a", "b", "orphan")]
    spark.createDataFrame(page, schemas.PAGES).write.parquet(f"{store}/pages")
    raw = json.dumps({"developer_name": "Acme", "installment_years": "9", "payment_type": "Cash", "finishing_level": "ultra lux"})
    spark.createDataFrame([("a", "v1", "m", raw, 1, 1, None, None, None, None)], schemas.EXTRACTIONS).write.parquet(f"{store}/landed")
    batch.run(spark, store, "v1", "m")
    first = batch.load(spark, store, "records").collect()
    assert len(first) == 1
    r = first[0]
    assert (r.listing_id, r.developer_name, r.payment_type, r.finishing_level, r.installment_years, r.total_installment_cost, r.price_per_sqm, r.language) == ("a", "Acme", "cash", None, 1.0, 34.0, 3.0, "en")
    letters = sorted((x.id, x.listing_id, x.error_class) for x in batch.load(spark, store, "failures").collect())
    assert letters == [(1, "b", "sanity"), (2, "orphan", "missing_hit")]
    batch.run(spark, store, "v1", "m")
    assert sorted((x.id, x.listing_id, x.error_class) for x in batch.load(spark, store, "failures").collect()) == letters
    again = batch.load(spark, store, "records").collect()
    assert [x.asDict() | {"parsed_at": None} for x in again] == [x.asDict() | {"parsed_at": None} for x in first]
    log = {x.listing_id: x for x in batch.load(spark, store, "extractions").collect()}
    assert log["a"].grounded == 0 and first[0].taxonomy_version == "1" and first[0].normalized_at is not None and first[0].amenities == []
    _, counts = batch.refill(batch.load(spark, store, "records"), batch.load(spark, store, "listings"))
    assert set(counts.first().asDict().values()) == {0} and len(counts.columns) == len(TOUCHED)


def test_saves_survive_a_stop(spark, tmp_path):
    """A version that is not complete does not count, whatever it holds; the one before is still there for plans that read it."""
    store, rows = str(tmp_path), lambda n: spark.createDataFrame([(str(i), "u", None, None, None, "{}", None) for i in range(n)], schemas.LISTINGS)
    assert batch.load(spark, store, "listings").count() == 0
    batch.save(rows(5), store, "listings")
    rows(3).write.parquet(f"{store}/listings/data/000000000002-stopped/bucket=0")
    (tmp_path / "listings" / "manifest" / ".draft").write_text('{"vers')
    assert batch.load(spark, store, "listings").count() == 5
    held = batch.load(spark, store, "listings")
    batch.save(held.limit(4), store, "listings")
    assert batch.load(spark, store, "listings").count() == 4 and held.count() == 5
    assert not (tmp_path / "listings" / "data" / "000000000002-stopped").exists()
    batch.save(held.limit(2), store, "listings")
    assert sorted(p.name for p in (tmp_path / "listings" / "manifest").glob("0*")) == ["000000000002.json", "000000000003.json"]
    assert sorted(p.name[:12] for p in (tmp_path / "listings" / "data").iterdir()) == ["000000000002", "000000000003"]


def test_commands(spark, tmp_path, capsys):
    """discover, parse, extract, backfill, status and export from landed files, by the command line."""
    store = str(tmp_path / "store")
    folder = tmp_path / "store" / "hits" / "purpose=for-sale" / "governorate=Cairo" / "category=flats"
    folder.mkdir(parents=True)
    (folder / "hits.json").write_text("\n".join(json.dumps(HIT | {"externalID": str(i)}) for i in (1, 2, 3, 3)) + "\n{}\n")
    cli.main(["discover", store], spark)
    cli.main(["discover", store], spark)
    found = batch.load(spark, store, "listings").orderBy("listing_id").collect()
    assert [(r.listing_id, r.governorate, r.category) for r in found] == [(i, "Cairo", "flats") for i in "123"]
    said = json.dumps({"property": {"data": {"mainDescription": "flat by Acme"}}})
    spark.createDataFrame([(i, "u", state(said), 1, "h", None) for i in "12"], schemas.PAGES).write.parquet(f"{store}/pages")
    spark.createDataFrame([(i, "v1", "m", json.dumps({"developer_name": "Acme"}), 1, 1, None, None, None, None) for i in "12"], schemas.EXTRACTIONS).write.parquet(f"{store}/landed")
    cli.main(["parse", store, "--limit", "1"], spark)
    assert [r.listing_id for r in batch.load(spark, store, "records").collect()] == ["1"]
    cli.main(["parse", store], spark)
    cli.main(["extract", store, "--model", "m"], spark)
    assert {(r.listing_id, r.developer_name, r.prompt_version) for r in batch.load(spark, store, "records").collect()} == {("1", "Acme", "v1"), ("2", "Acme", "v1")}
    cli.main(["backfill", store], spark)
    capsys.readouterr()
    cli.main(["status", store, "--model", "m"], spark)
    out = capsys.readouterr().out
    assert "pending_fetch" in out and "described" in out
    cli.main(["export", store, "--out", f"{tmp_path}/out"], spark)
    assert spark.read.parquet(f"{tmp_path}/out/dataset.parquet").count() == 2
    for _ in range(2):
        cli.main(["template", store, "--out", f"{tmp_path}/gold"], spark)
    assert (tmp_path / "gold.bak").exists() and spark.read.csv(f"{tmp_path}/gold", header=True).count() == 2
