"""Runs against a word-by-word search, on random words of few kinds, long repeats and odd rows."""

import random
import time

from pyspark.sql import functions as F

from groundtable.llm import periodic_runs, queries


def by_hand(words, repeats=4, least=6):
    """Every maximal stretch of each lag, by comparing words; its smallest period by trying all."""
    n, found = len(words), set()
    for q in range(1, n // repeats + 1):
        i = 0
        while i < n - q:
            if words[i] != words[i + q]:
                i += 1
                continue
            j = i
            while j < n - q and words[j] == words[j + q]:
                j += 1
            if j + q - i >= max(least, repeats * q):
                stretch = words[i : j + q]
                if not any(all(a == b for a, b in zip(stretch, stretch[p:], strict=False)) for p in range(1, q)):
                    found.add((i, j + q - i, q))
            i = j
    return sorted(found)


def collapsed(words, runs):
    gone = {k for start, length, q in runs for k in range(start + q, start + length)}
    return " ".join(w for k, w in enumerate(words) if k not in gone)


def cases():
    rng = random.Random(8)
    for kinds in (1, 2, 3, 6, 40):
        for n in (0, 1, 5, 6, 7, 23, 60, 150):
            yield [rng.choice("abcdefghijklmnopqrstuvwxyz") + str(rng.randrange(kinds)) if kinds > 9 else "abcdef"[rng.randrange(kinds)] for _ in range(n)]
    for period in (1, 2, 3, 5, 17, 40):
        base = [rng.choice("abcdefgh") for _ in range(period)]
        for times in (3, 4, 5, 9):
            yield ["x", "y"] + base * times + base[: period // 2] + ["z"] + base * times
    nested = (list("ababababc") * 5 + ["d"]) * 5
    yield nested


def test_find_runs(monkeypatch):
    for near in (512, 0, 3):  # with no and with early looks at the blocks
        monkeypatch.setattr(periodic_runs, "NEAR", near)
        for words in cases():
            assert periodic_runs.find_runs([w.encode() for w in words]) == by_hand(words), (near, words)
            assert periodic_runs.find_runs([w.encode() for w in words], 3, 4) == by_hand(words, 3, 4)
            assert periodic_runs.find_runs([w.encode() for w in words], 2, 2) == by_hand(words, 2, 2)


def test_long_texts_end():
    rng = random.Random(2)
    prose = [b"%d" % int(rng.paretovariate(0.8)) for _ in range(200_000)]
    t = time.perf_counter()
    assert periodic_runs.find_runs([b"w"] * 200_000) == [(0, 200_000, 1)]
    block = prose[:9_000]
    words = prose[9_000:100_000] + block * 5 + prose[100_000:]
    assert [r for r in periodic_runs.find_runs(words) if r[2] > 50] == [r for r in [(91_000, 45_000, 9_000)]]
    assert time.perf_counter() - t < 60


def test_detect(stored, odd_rows):
    rows = [*odd_rows, (50, "a b " * 9), (50, "a b " * 9), (51, "go " * 6), (52, "go " * 5), (53, "x " + "é 日 " * 4 + "é")]
    docs = stored(rows)
    found = periodic_runs.detect(docs.withColumn("RUNS", F.lit("mine")))
    assert found.columns == [*docs.columns, "n_words", "runs", "collapsed"]
    got = found.collect()
    assert len(got) == len(rows)
    for r in got:
        words = [w.decode() for w in (r.text or "").encode().split()]
        assert r.n_words == len(words) and r["score"] == "x"
        runs = [tuple(x) for x in r.runs]
        assert runs == (by_hand(words) if len(words) < 2_000 else runs)
        assert r.collapsed == collapsed(words, runs)
    assert {r.doc_id: [tuple(x) for x in r.runs] for r in got if r.doc_id in (50, 51, 52, 53)} == {50: [(0, 18, 2)], 51: [(0, 6, 1)], 52: [], 53: [(1, 9, 2)]}
    assert periodic_runs.detect(docs.limit(0)).count() == 0


def test_query(spark, stored, tmp_path, odd_rows):
    import hashlib
    from zlib import crc32

    rows = [*odd_rows, *((k, "one two three four five six seven " * 3 + "end") for k in range(100, 160))]
    stored(rows).write.parquet(f"{tmp_path}/documents.parquet")
    got = queries.op11_periodic_runs(spark, str(tmp_path)).collect()
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    expected = []
    for key, text, *_ in rows:
        words = [w.decode() for w in (text or "").encode().split()]
        h, n = (crc32(str(key).encode()) if key is not None else 1), len(words)
        if h % 10 == 0 and n:
            a = (h // 10) % n
            p = 1 + (n - a) // (3 + (h // 10) % 8)
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
        runs = by_hand(words) if n < 2_000 else [tuple(x) for x in periodic_runs.find_runs([w.encode() for w in words])]
        top = max(runs, key=lambda r: (r[1], -r[0], -r[2]), default=(None, None, None))
        milli = 1000 * top[1] // top[2] if runs else None
        expected.append((key, len(runs), *top, milli, sha("".join(f"{s},{n},{q}\n" for s, n, q in runs)), sha(collapsed(words, runs))))
    order = lambda rows: sorted(map(tuple, rows), key=str)
    assert order(got) == order(expected)
    assert sum(r.n_runs > 0 for r in got) > 3
