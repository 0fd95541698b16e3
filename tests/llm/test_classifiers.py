"""Toxicity and quality: what held-out rows show, and odd rows."""

import os
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from groundtable.llm import quality_mil, quality_rules, toxicity_fm
from groundtable.session import table

DATA = "/root/testdata/sf0.1"
LABELS = "doc_id long, quality int, toxic int"


def area(scores, labels):
    order = np.argsort(np.argsort(scores, kind="stable"))
    y = np.asarray(labels, dtype=bool)
    return (order[y].sum() - y.sum() * (y.sum() - 1) / 2) / (y.sum() * (~y).sum())


@pytest.mark.skipif(not os.path.isdir(DATA), reason="the driver's tables are not here")
@pytest.mark.parametrize(("module", "label", "least"), [(toxicity_fm, "toxic", 0.985), (quality_mil, "quality", 0.98)])
def test_held_out(spark, module, label, least):
    docs, labels = table(spark, DATA, "documents"), table(spark, DATA, "labels")
    known = docs.join(labels.select("doc_id"), "doc_id", "left_semi")
    rows = module.score(known, labels).join(labels, "doc_id").filter("held_out").select("score", "predicted", label).toPandas()
    assert area(rows["score"], rows[label]) > least
    assert ((rows["score"] >= 0.7) == (rows["predicted"] == 1)).all()
    found = rows[rows["predicted"] == 1]
    assert (found[label] == 1).sum() >= 0.8 * (rows[label] == 1).sum() and (found[label] == 1).mean() > 0.95


@pytest.mark.parametrize(("module", "modulus", "rest"), [(toxicity_fm, 3, 1), (quality_mil, 4, 2)])
def test_odd_rows(spark, stored, odd_rows, module, modulus, rest):
    docs = stored(odd_rows)
    labels = spark.createDataFrame([(i, i % 2, i % 2) for i in range(11, 40)] + [(1, None, None), (11, 1, 1), (None, 1, 1)], LABELS)
    rows = module.score(docs, labels).collect()
    assert len(rows) == len(odd_rows)
    for r in rows:
        assert 0 <= r.score <= 1 and r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % modulus == rest)
    by_text = {}
    for r in rows:
        assert by_text.setdefault(r.text, r.score) == r.score
    assert module.score(docs.limit(0), labels).count() == 0
    assert len({r.score for r in module.score(docs, labels.limit(0)).collect()}) <= 2


def test_network_gradients():
    rng = np.random.default_rng(3)
    x, sizes, y = rng.normal(size=(9, quality_mil.FEATURES)), np.array([2, 3, 4]), np.array([1.0, 0.0, 1.0])
    net = quality_mil.train(x, sizes, y, 1.0, epochs=1)

    def loss():
        z = net.forward(x, sizes)["z"]
        return float(np.mean(np.log1p(np.exp(z)) - y * z)) + sum(5e-5 * float((p**2).sum()) for p in net.p.values())

    grads = net.gradients(x, sizes, y)
    for k, p in net.p.items():
        at = tuple(rng.integers(0, n) for n in p.shape)
        p[at] += 1e-5
        up = loss()
        p[at] -= 2e-5
        down = loss()
        p[at] += 1e-5
        assert abs((up - down) / 2e-5 - grads[k][at]) < 1e-6


def brute_counts(text):
    import re
    from collections import Counter

    w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    windows = list(zip(w, w[1:], w[2:], strict=False))
    times = Counter(windows)
    covered = {k + j for k, x in enumerate(windows) if times[x] > 1 for j in range(3)}
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)), len(covered)


def test_rules(spark, stored, odd_rows):
    rng = random.Random(8)
    rows = list(odd_rows) + [(100, "a b c a b c a b c"), (101, "l1 x\nl1 x\n\nl1 x\nother")]
    labels = []
    for i in range(200, 500):
        bad = i % 3 == 0
        rows.append((i, " ".join("".join(rng.choice("abcdefghij") for _ in range(5)) + ("#" if bad else "") for _ in range(80))))
        labels.append((i, int(not bad), 0))
    docs = stored(rows)
    found = quality_rules.apply(docs.select("doc_id", "text"), spark.createDataFrame(labels, LABELS)).collect()
    assert len(found) == len(rows)
    expected = sorted((str(i), *brute_counts(t)) for i, t, *_ in rows)
    assert sorted((str(r.doc_id), r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in found) == expected
    for r in found:
        assert r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words)
        if r.doc_id and r.doc_id >= 200:
            assert r.kept == (r.doc_id % 3 != 0)
    none = quality_rules.apply(docs.select("doc_id", "text"), spark.createDataFrame([], LABELS)).filter(F.col("kept") == F.col("base_failed"))
    assert none.count() == 0
    assert quality_rules.apply(docs.limit(0).select("doc_id", "text"), spark.createDataFrame(labels, LABELS)).count() == 0


def test_pairs_without_a_sign_of_their_own_are_learnt():
    """An insult or a group alone is harmless, both together are not: no weights alone can tell, so a linear model of the same terms cannot."""
    rng = np.random.default_rng(1)
    rows, labels = [], []
    for _ in range(3000):
        a, b = rng.random(2) < 0.5
        rows.append(np.unique(np.concatenate([rng.integers(10, 400, 12), [1] if a else [2], [3] if b else [4]])))
        labels.append(int(a == b))
    m = toxicity_fm.train(rows[:2000], np.array(labels[:2000]), 1.0)
    place = {int(s): i for i, s in enumerate(m.slots)}
    assert {1, 2, 3, 4} <= set(place)
    x = np.zeros((3000, 400))
    for i, r in enumerate(rows):
        x[i, r] = 1
    y = np.array(labels, dtype=float)
    linear = np.linalg.lstsq(x[:2000].T @ x[:2000] + np.eye(400), x[:2000].T @ (y[:2000] - y[:2000].mean()), rcond=None)[0]
    assert area(x[2000:] @ linear, labels[2000:]) < 0.7
    assert area(m.scores([np.array([place[int(i)] for i in r if int(i) in place], dtype=int) for r in rows[2000:]]), labels[2000:]) > 0.95


def test_toxicity_learns_from_five_thousand_a_class(spark, stored, monkeypatch):
    seen = []
    monkeypatch.setattr(toxicity_fm, "labelled_sample", lambda docs, labels, label, held_out, per_class: seen.append(per_class) or (docs.select("doc_id", "text", F.lit(1).alias("label")), {1: 2}))
    assert toxicity_fm.score(stored([(1, "b a b"), (2, "")]), spark.createDataFrame([(1, 1, 1)], LABELS)).count() == 2
    assert seen == [5000]
    rows, labels = toxicity_fm.sample_rows(stored([(1, "b a b"), (2, "")]).select("doc_id", "text", F.lit(1).alias("label")))
    assert [r.tolist() for r in rows] == [sorted({*toxicity_fm.terms(b"a"), *toxicity_fm.terms(b"b")}), []] and labels.tolist() == [1, 1]


def test_pair_sum_by_explicit_pairs():
    rng = np.random.default_rng(2)
    m = toxicity_fm.Machine(np.arange(9), 0.3, rng.normal(size=9), rng.normal(size=(9, 4)))
    for r in (np.array([1, 4, 7]), np.array([], dtype=int), np.arange(9)):
        z = 0.3
        if len(r):
            z += m.weights[r].sum() / np.sqrt(len(r)) + sum(m.vectors[a] @ m.vectors[b] for k, a in enumerate(r) for b in r[:k]) / len(r)
        assert abs(m.scores([r])[0] - 1 / (1 + np.exp(-z))) < 1e-9


def test_values_and_scaled_pairs():
    """A slot's value by its four counts; scores with values by explicit pairs."""
    got = toxicity_fm.told(10, 4, np.array([5, 5, 10]), np.array([2, 4, 4]))
    assert np.allclose(got**2 - 1, [0, 10 * (4 * 5 - 1 * 0) ** 2 / (5 * 5 * 4 * 6), 0], atol=1e-5) and toxicity_fm.told(10**6, 10**5, np.array([10**5]), np.array([10**5]))[0] == toxicity_fm.MOST
    rng = np.random.default_rng(3)
    m = toxicity_fm.Machine(np.arange(6), -0.2, rng.normal(size=6), rng.normal(size=(6, 3)), np.array([1.0, 2.0, 5.0, 1.0, 3.0, 1.0]))
    r = np.array([0, 2, 5])
    x = m.values[r] / np.sqrt((m.values[r] ** 2).sum())
    z = -0.2 + m.weights[r] @ x + sum(x[i] * x[j] * (m.vectors[r[i]] @ m.vectors[r[j]]) for i in range(3) for j in range(i))
    assert abs(m.scores([r])[0] - 1 / (1 + np.exp(-z))) < 1e-9


def test_slots_of_many_texts(monkeypatch):
    """The distinct kept slots of each text, as when each is looked at alone, also once the words known are forgotten."""
    place = np.full(toxicity_fm.SLOTS, -1, dtype=np.int32)
    texts = ["an insult, An INSULT", None, "", "groups of people grouped", "x", "insulting"]
    kept = np.array(sorted({s for w in b"insult groups people an".split() for s in toxicity_fm.terms(w)}))
    place[kept] = np.arange(len(kept))
    known = toxicity_fm.Known(place)
    for most in (50_000, 0):
        monkeypatch.setattr(toxicity_fm, "CACHE", most)
        ids, who = known.of(texts)
        for k, t in enumerate(texts):
            alone = sorted({int(place[s]) for w in (t or "").encode().split() for s in toxicity_fm.terms(w) if place[s] >= 0})
            assert ids[who == k].tolist() == alone
    assert [x.tolist() for x in known.of([None])] == [[], []] and [x.tolist() for x in known.of([])] == [[], []]


def test_new_words_are_looked_up_together():
    """The slots of all new words of a batch are found by one look-up, and are the hashes of the words and their starts."""
    import xxhash

    class Asked:
        times = 0

        def __getitem__(self, i):
            self.times += 1
            return np.arange(toxicity_fm.SLOTS, dtype=np.int32)[i]

    place, texts = Asked(), ["Ab, abcdefghij ÉCOLEÉCOLE", None, "ab ***", "x y z"]
    ids, who = toxicity_fm.Known(place).of(texts)
    assert place.times == 1
    for k, t in enumerate(texts):
        bare = {w.strip(toxicity_fm.EDGES.decode()).lower() for w in (t or "").split()} - {""}
        forms = bare | {"\0" + b[:n] for b in bare for n in toxicity_fm.STARTS if len(b) > n}
        assert ids[who == k].tolist() == sorted({xxhash.xxh3_64_intdigest(f.encode()) % toxicity_fm.SLOTS for f in forms})


def test_attention_by_loops():
    """The network's scores, passage by passage."""
    rng = np.random.default_rng(5)
    x, sizes = rng.normal(size=(9, quality_mil.FEATURES)), np.array([2, 3, 4])
    net = quality_mil.train(x, sizes, np.array([1.0, 0.0, 1.0]), 2.0, epochs=2)
    at = 0
    for k, n in enumerate(sizes):
        h = [np.tanh((v - net.centre) / net.scale @ net.p["w"] + net.p["b"]) for v in x[at : at + n]]
        e = np.exp([sum(np.tanh(v @ net.p["v"]) / (1 + np.exp(-(v @ net.p["u"]))) * net.p["a"]) for v in h])
        bag = sum(w * v for w, v in zip(e / e.sum(), h, strict=True))
        assert abs(net.scores(x, sizes)[k] - 1 / (1 + np.exp(-(bag @ net.p["c"] + net.p["d"][0] + net.shift)))) < 1e-9
        at += n


def test_all_passages_are_learnt_from(spark, stored):
    """No passage of a sampled text is left out; the bound takes whole texts away."""
    docs = stored([(1, "a b " * 5000), (2, "c"), (3, "d " * 100)]).withColumn("label", (F.col("doc_id") % 2).cast("int")).select("doc_id", "text", "label")
    x, sizes, labels = quality_mil.sample_passages(docs, 1000)
    assert sizes.tolist() == [-(-10000 // quality_mil.PASSAGE), 1, -(-100 // quality_mil.PASSAGE)] and len(x) == sizes.sum() and labels.tolist() == [1, 0, 1]
    assert quality_mil.sample_passages(docs, 100)[1].tolist() == [1, 3]
