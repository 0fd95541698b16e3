"""Line dedup and the shingle join against brute force, and the pipeline."""

import random

import numpy as np
import pyarrow as pa
import pytest

import corpus_pipeline
from groundtable.llm import line_dedup, ngram_join
from groundtable.llm.byte_words import find_words
from groundtable.llm.components import components


@pytest.fixture(scope="module")
def near_rows(odd_rows):
    rng = random.Random(6)
    vocabulary = ["v%d" % i for i in range(3000)]
    base = [rng.choice(vocabulary) for _ in range(60)]
    rows = list(odd_rows)
    for i in range(100, 260):  # a group of near copies: pairs of them are above and below the threshold
        words = list(base)
        for _ in range(rng.randint(0, 2)):
            words[rng.randrange(60)] = rng.choice(vocabulary)
        rows.append((i, " ".join(words)))
    for i in range(300, 420):  # texts with one passage in common, which are not copies
        rows.append((i, " ".join(base[:10]) + "\n" + " ".join(rng.choice(vocabulary) for _ in range(40)) + "\n" + " ".join(base[20:45])))
    rows += [(i, "a b c d") for i in range(500, 530)]
    rng.shuffle(rows)
    return rows


def sets_of(rows):
    out = []
    for i, t, *_ in rows:
        w = (t or "").encode().split()
        k = min(5, len(w))
        out.append((i, frozenset(tuple(w[j : j + k]) for j in range(len(w) - k + 1)) if w else frozenset()))
    return out


def alike(a, b, t=0.8):
    return bool(a) and bool(b) and len(a & b) >= t * len(a | b) - 1e-9


def test_join(stored, near_rows):
    found = sorted(((r.doc_id, r.class_id, r.n_links) for r in ngram_join.join(stored(near_rows)).collect() if r.doc_id is not None))
    sets = [(i, s) for i, s in sets_of(near_rows) if i is not None]
    top = {i: i for i, _ in sets}

    def root(i):
        while top[i] != i:
            i = top[i]
        return i

    links = [0] * len(sets)
    for x, (i, a) in enumerate(sets):
        for y, (j, b) in enumerate(sets[:x]):
            if alike(a, b):
                links[x] += 1
                links[y] += 1
                p, q = root(i), root(j)
                top[max(p, q)] = min(p, q)
    assert found == sorted((i, root(i), n) for (i, _), n in zip(sets, links, strict=True))


def test_join_chunks(stored, near_rows, monkeypatch):
    """Groups cut in many chunks give the same."""
    docs = stored(near_rows)
    whole = sorted(map(str, ngram_join.join(docs).collect()))
    monkeypatch.setattr(ngram_join, "CHUNK", 16)
    monkeypatch.setattr(ngram_join, "COMPONENT_CHUNK", 16)
    assert sorted(map(str, ngram_join.join(docs).collect())) == whole


def test_keep_one(spark, stored, near_rows):
    docs = stored(near_rows)
    classes = {r.doc_id: r.class_id for r in ngram_join.join(docs).collect() if r.doc_id is not None}
    kept = ngram_join.keep_one(docs)
    assert kept.columns == docs.columns
    rows = kept.collect()
    blank = [r for r in rows if r.doc_id is not None and not (r.text or "").encode().split()]
    assert len(blank) == sum(1 for i, t, *_ in near_rows if i is not None and not (t or "").encode().split())
    ids = [r.doc_id for r in rows if r.doc_id is None or r not in blank]
    worded = {i for i, t, *_ in near_rows if i is not None and (t or "").encode().split()}
    assert sorted(i for i in ids if i is not None) == sorted(i for i, c in classes.items() if i == c and i in worded)
    assert ids.count(None) == 2
    assert ngram_join.join(docs.limit(0)).count() == 0


def test_keep_one_of_repeated_ids(spark):
    """An id that stands for several texts: each class keeps one row, in any names of columns."""
    long = " ".join("w%d" % i for i in range(60))
    rows = [(4, long), (4, long + " end"), (2, long), (9, "quite another text of seven words here"), (9, "and one more that is not like it"), (9, None), (8, "  ")]
    docs = spark.createDataFrame([(i, t, "a", "b", "c", "d") for i, t in rows], ["doc_id", "text", "_id", "id", "tie", "a.b"])
    kept = ngram_join.keep_one(docs)
    assert kept.columns == docs.columns
    got = kept.collect()
    assert sorted((r.doc_id, r.text or "") for r in got) == sorted([(2, long), (8, "  "), (9, rows[3][1]), (9, rows[4][1]), (9, "")])
    assert {tuple(r[2:]) for r in got} == {("a", "b", "c", "d")}


def test_proven_links_stay(spark):
    """Sets that overlap enough are linked, whatever their MinHash values are."""
    a, b = np.arange(100, dtype=np.uint64), np.arange(10, 100, dtype=np.uint64)
    rows = [(i, 1, 1, np.full(ngram_join.HASHES, i, np.uint16).tobytes(), s.tobytes()) for i, s in enumerate((a, b))]
    held = spark.createDataFrame(rows, "id long, group long, copies long, values binary, set binary")
    groups = spark.createDataFrame([(1, 2, 190)], "group long, n long, shingles long")
    assert sorted((r.a, r.docs) for r in ngram_join.verified(held, groups, 0.8).collect()) == [(0, 1), (1, 1)]


def test_posterior():
    """The fewest matches at which a pair goes on, against the binomial sum that the posterior's tail is."""
    from math import comb

    for n, least in zip((32, 64, 96), ngram_join.least_matches(0.8, 1e-7), strict=True):
        tail = lambda m, n=n: sum(comb(n + 1, k) * 0.8**k * 0.2 ** (n + 1 - k) for k in range(m + 1))
        assert tail(least) >= 1e-7 > tail(least - 1)
    s = np.arange(1, 2000, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    a, b = ngram_join.min_hashes(s[:1000]), ngram_join.min_hashes(s[100:1100])
    assert abs((a == b).mean() - 900 / 1100) < 0.15


def removed_by_brute_force(rows, least=5, t=0.8):
    order = sorted(range(len(rows)), key=lambda k: (rows[k][0] is None, rows[k][0] or 0))
    seen, out = [], {}
    for k in order:
        out[k] = []
        for j, line in enumerate((rows[k][1] or "").split("\n")):
            s = frozenset(line.encode().split())
            if len(s) >= least:
                if any(alike(s, x, t) for x in seen):
                    out[k].append(j)
                seen.append(s)
    return out


@pytest.fixture(scope="module")
def line_rows(near_rows):
    # ids are unique here, so that results can be told apart by them; test_line_ties has repeated and null ids
    return [r for k, r in enumerate(near_rows) if r[0] is not None and r[0] not in {x[0] for x in near_rows[:k]}]


def test_lines(stored, line_rows):
    docs = stored(line_rows)
    expected = removed_by_brute_force(line_rows)
    found = {r.doc_id: r for r in line_dedup.report(docs).collect()}
    assert len(found) == len(line_rows)
    for k, (i, text, *_) in enumerate(line_rows):
        assert list(found[i].removed) == expected[k] and found[i].n_lines == (text.count("\n") + 1 if text else 0)
    out = line_dedup.deduplicate(docs)
    assert out.columns == docs.columns
    texts = {r.doc_id: (r.text, r.n_chars) for r in out.collect()}
    for k, (i, text, *_) in enumerate(line_rows):
        left = None if text is None else "\n".join(x for j, x in enumerate(text.split("\n")) if j not in expected[k])
        assert texts[i] == (left, len(left or ""))


def test_lines_by_another_way(stored, line_rows, monkeypatch):
    """With one candidate a line the second comparison has to find the rest; results are the same."""
    monkeypatch.setattr(line_dedup, "BEST", 1)
    monkeypatch.setattr(line_dedup, "MANY", 1)
    docs = stored(line_rows)
    expected = removed_by_brute_force(line_rows)
    found = {r.doc_id: list(r.removed) for r in line_dedup.report(docs).collect()}
    assert found == {line_rows[k][0]: v for k, v in expected.items()}


def test_short_lines(spark, stored, line_rows, tmp_path):
    """The query and the pipeline's stage take lines of any number of words."""
    from groundtable.llm.queries import op4_line_dedup

    short = ["read more", "read  more", "more", "a b c d", "a b c d e", "e d c b", "x x x x x x", "x", "p q r s t", "p q r s", "p q r u"]
    rows = [*line_rows, *((1000 + i, "\n".join(short[i % 7 :] + ["", "own %d" % i])) for i in range(20))]
    expected = removed_by_brute_force(rows, least=1)
    docs = stored(rows)
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    found = {r.doc_id: list(r.removed) for r in op4_line_dedup(spark, str(tmp_path)).collect()}
    assert found == {rows[k][0]: v for k, v in expected.items()}
    texts = {r.doc_id: r.text for r in corpus_pipeline.drop_lines(spark, docs, str(tmp_path)).collect()}
    for k, (i, text, *_) in enumerate(rows):
        assert texts[i] == (None if text is None else "\n".join(x for j, x in enumerate(text.split("\n")) if j not in expected[k]))


def test_line_ties(stored, near_rows):
    """Repeated and null ids: of lines with the same id and number the one with the smaller hash is the earlier."""
    base = ["w%d" % i for i in range(20)]
    rows = [*near_rows[:120], *((7, " ".join(base[:k] + ["own%d" % k] + base[k + 1 :])) for k in range(6)), (7, "x y z"), (7, "x y z"), (None, "z y x"), (2**63 - 1, "z x y\nnew line"), (None, "new line\nz y")]
    sets = [(i, t, j, line_dedup.line_sets(line_dedup.find_words(pa.array([line])), 1)) for i, t, *_ in rows for j, line in enumerate((t or "").split("\n")) if line.split()]
    order = sorted(((i is None, i or 0, j, next(x).id[0], t, line) for i, t, j, x in sets for line in [t.split("\n")[j]]), key=lambda r: r[:5])
    seen, expected = [], []
    for _, _, j, _, t, line in order:
        s = frozenset(line.encode().split())
        expected += [(t, j)] if any(alike(s, x) for x in seen) else []
        seen.append(s)
    found = line_dedup.deduplicate(stored(rows), least=1).select("doc_id").union(line_dedup.report(stored(rows), least=1).selectExpr("doc_id"))
    assert found.count() == 2 * len(rows)
    removed = line_dedup.report(stored(rows), least=1).collect()
    assert sum(r.n_removed for r in removed) == len(expected)
    assert {r.doc_id for r in removed} == {r[0] for r in rows}
    again = line_dedup.report(stored(rows).repartition(7), least=1).collect()
    assert sorted(map(str, again)) == sorted(map(str, removed))


def test_line_columns_that_clash(spark):
    """Columns named like the operator's own come through as they are."""
    names = ["removed", "_row", "row", "Touched", "held", "gone", "_touched", "_lines", "a.b", "id", "n"]
    docs = spark.createDataFrame([(k, "one two three\nown line %d" % k, *(["%s%d" % (n, k) for n in names])) for k in range(4)], ["doc_id", "text", *names])
    out = line_dedup.deduplicate(docs, least=1)
    assert out.columns == docs.columns
    got = {r.doc_id: r for r in out.collect()}
    for k in range(4):
        assert got[k].text == ("one two three\nown line 0" if k == 0 else "own line %d" % k)
        assert [got[k][2 + j] for j in range(len(names))] == ["%s%d" % (n, k) for n in names]


def test_words_in_bytes():
    """Words, lines and hashes against split(), over sliced and large arrays, in parts of any size."""
    rng = random.Random(3)
    texts = [None, "", " a b\nc", "x" * 9000 + " y", "a\n\n", "\nb", "é\x85z 日本語　x\x1cy", *("".join(rng.choice("ab \n\tcdeé") for _ in range(rng.randint(0, 60))) for _ in range(300))]
    seen = {}
    for arr in (pa.array(texts), pa.array(texts)[2:100], pa.array(texts, pa.large_string()), pa.array(texts)[:0]):
        w = find_words(arr)
        text, line, first = w.lines()
        h, k = w.hashes(), 0
        for i, t in enumerate(arr.to_pylist()):
            for j, raw in enumerate((t or "").encode().split(b"\n")):
                assert (text[k], line[k]) == (i, j)
                assert [w.data[a:b].tobytes() for a, b in zip(w.start[first[k] : first[k + 1]], w.end[first[k] : first[k + 1]], strict=True)] == raw.split()
                for word, x in zip(raw.split(), h[first[k] : first[k + 1]], strict=True):
                    assert seen.setdefault(word, x) == x
                k += 1
        assert k == len(text)
    assert len(set(seen.values())) == len(seen)
    assert find_words(pa.array(["ABZ[`az{é"]), lower=True).data[:10].tobytes() == "abz[`az{é".encode()


def test_words_in_order(monkeypatch):
    """By owner, rarity and hash, whether or not upper bits of hashes are equal and words repeat."""
    rng = np.random.default_rng(9)
    h = rng.integers(0, 1 << 63, 400, dtype=np.uint64)
    h[::3] = h[0] + rng.integers(0, 4, len(h[::3]), dtype=np.uint64)
    owner, rarity = np.sort(rng.integers(0, 30, 400)), (h % np.uint64(3)).astype(np.uint8)
    order = np.lexsort((h, rarity, owner))
    for part in (512, 64):
        monkeypatch.setattr(line_dedup, "WORDS_AT_ONCE", part)
        got = line_dedup.in_order(h, owner, rarity)
        assert (got[0] == h[order]).all() and (got[1] == owner[order]).all()


def test_rows_of_another_scan(spark, stored, monkeypatch):
    """The rewrite finds its rows though the table is cut otherwise after the survey."""
    docs = stored([(i, "one two three four five\nown line of %d is this" % i) for i in range(400)])
    name, whole = "spark.sql.files.maxPartitionBytes", line_dedup.repeated_lines
    before = spark.conf.get(name)

    def then_cut_otherwise(*args):
        found = line_dedup.cut(whole(*args))
        spark.conf.set(name, "700")
        return found

    monkeypatch.setattr(line_dedup, "repeated_lines", then_cut_otherwise)
    try:
        texts = {r.doc_id: r.text for r in line_dedup.deduplicate(docs).collect()}
    finally:
        spark.conf.set(name, before)
    assert all(("one two three" in t) == (i == 0) for i, t in texts.items()) and len(texts) == 400


def test_odd_lines(stored, odd_rows):
    docs = stored(odd_rows)
    assert line_dedup.deduplicate(docs).count() == len(odd_rows)
    assert line_dedup.report(docs.limit(0)).count() == 0


def test_components(spark):
    rng = random.Random(2)
    edges = [(i, i + 1) for i in range(0, 90)] + [(200, i) for i in range(201, 260)] + [(500, 400), (5, 5)]
    rng.shuffle(edges)
    found = {r.id: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert found == {i: 0 for i in range(1, 91)} | {i: 200 for i in range(201, 260)} | {500: 400}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_pipeline(spark, tmp_path, odd_rows):
    from tests.llm.conftest import DOCS

    columns = DOCS.split(", score")[0]
    rows = [(r[0], r[1], "en", r[2] if len(r) > 2 else "s", len(r[1] or "")) for r in odd_rows]
    folder = str(tmp_path)
    spark.createDataFrame(rows, columns).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(i, 1, 0) for i in range(11, 30)], "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, folder).columns == docs.columns
    out = corpus_pipeline.run(spark, folder)
    assert out.columns == ["doc_id", "lang", "source", "n_tokens", "ids"] and out.filter("n_tokens = 0").count() == 0


def test_the_callers_columns_come_through_every_stage(spark, tmp_path, odd_rows):
    """Columns named like what the stages work with keep the caller's values, whatever their case."""
    names = ["Score", "IDS", "size", "Taken", "held_out", "predicted", "source_size", "target", "Row", "id", "cluster", "a.b"]
    rows = [(r[0], r[1], "en", r[2] if len(r) > 2 else "s", len(r[1] or ""), *(f"{c}{r[0]}" for c in names)) for r in odd_rows]
    folder, at = str(tmp_path), f"{tmp_path}/documents.parquet"
    spark.createDataFrame(rows, ["doc_id", "text", "lang", "source", "n_chars", *names]).write.parquet(at)
    spark.createDataFrame([(i, 1, 0) for i in range(11, 30)] + [(30, 0, 0)], "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = spark.read.parquet(at)
        stage(spark, docs, folder).write.parquet(at := f"{folder}/{name}")
        after = spark.read.parquet(at)
        assert after.columns == docs.columns
        found = after.collect()
        assert found and all(r[5 + k] == f"{c}{r.doc_id}" for r in found for k, c in enumerate(names))
    last = corpus_pipeline.STAGES[-1][1](spark, spark.read.parquet(at), folder)
    assert last.columns == ["doc_id", "lang", "source", "n_tokens", "ids"] and isinstance(last.first().ids, bytes | bytearray)


@pytest.mark.parametrize(("n", "bits"), [(1, 5), (1000, 5), (1000, 24)])
def test_bucketed_postings(n, bits):
    """Postings come out of their buckets as they went in, each bucket in one row, further bits at the long lines'."""
    rng = np.random.default_rng(n)
    c = {k: rng.integers(0, 2**32, n) for k in ("cell", "line", "place", "chunk")} | {k: rng.integers(-(2**63), 2**63 - 1, n) for k in ("doc", "id", "low", "high")}
    c |= {"cell": c["cell"].astype(np.uint32), "k": rng.integers(1, 2 * line_dedup.LONG, n)}
    long = c["k"] > line_dedup.LONG
    more = np.zeros((n, 2), np.uint64)
    more[long] = rng.integers(1, 2**63, (long.sum(), 2))
    rows, half = line_dedup.rows_of_bytes(c), n // 2
    b = line_dedup.in_buckets([(rows[:half], more[:half][long[:half]]), (rows[half:], more[half:][long[half:]])], bits)
    assert b.column("bucket").to_pylist() == sorted({int(x) >> (32 - bits) for x in c["cell"]})
    got, bits_got = line_dedup.out_of_buckets(pa.Table.from_batches([b]))
    flat = lambda c, more: sorted(zip(*(c[k].tolist() for k in line_dedup.COLUMNS), *more.T.tolist(), strict=True))
    assert flat(got, bits_got) == flat(c, more)


def test_postings_by_cell():
    """Of postings alike in cell, id, place and chunk the earliest line's stays; ids that share their upper half are told apart."""
    rng = np.random.default_rng(7)
    c = {k: rng.integers(0, 3, 500) for k in ("place", "chunk", "doc", "line")} | {"cell": rng.integers(0, 4, 500).astype(np.uint32), "id": rng.integers(-2, 3, 500)}
    got = line_dedup.by_cell(c)
    first = {}
    for r in zip(*(c[k].tolist() for k in ("cell", "id", "place", "chunk", "doc", "line")), strict=True):
        first[r[:4]] = min(r[4:], first.get(r[:4], r[4:]))
    assert sorted((*(int(c[k][i]) for k in ("cell", "id", "place", "chunk")),) for i in got) == sorted(first)
    assert all((c["doc"][i], c["line"][i]) == first[tuple(int(c[k][i]) for k in ("cell", "id", "place", "chunk"))] for i in got)
    assert (np.diff(c["cell"][got].astype(int)) >= 0).all()
