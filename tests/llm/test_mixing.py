"""Targets by repeated dealing, and how near the takings come."""

import random
import re

import numpy as np

from groundtable.llm import mixing


def dealt(sizes, weights=(3, 1, 2)):
    """Share 150 % by weight; cut at twice the size and deal out the excess again until none is above."""
    order = sorted((s for s in sizes if s is not None)) + [None] * (None in sizes)
    w = {s: weights[i % 3] for i, s in enumerate(order)}
    target, free, budget = dict.fromkeys(order, 0.0), list(order), 1.5 * sum(sizes.values())
    while free:
        level = budget / sum(w[s] for s in free)
        over = [s for s in free if level * w[s] > 2 * sizes[s]]
        if not over:
            for s in free:
                target[s] = level * w[s]
            break
        for s in over:
            target[s] = 2.0 * sizes[s]
            budget -= target[s]
            free.remove(s)
    return target


def check(rows, mixed):
    sizes, taken = {}, {}
    for r in mixed:
        n = len(re.findall(r"[^\x20\x09-\x0D]+", r.text or ""))
        assert r["size"] == n and r.taken in (0, n, 2 * n)
        sizes[r.source] = sizes.get(r.source, 0) + n
        taken[r.source] = taken.get(r.source, 0) + r.taken
    target = dealt(sizes)
    for r in mixed:
        assert r.source_size == sizes[r.source] and abs(r.target - target[r.source]) < 1e-6
    assert len(mixed) == len(rows)
    return {s: taken[s] - target[s] for s in sizes}


def test_mix(stored):
    rng = random.Random(3)
    rows = [(i, " ".join(["w"] * rng.choice([0, 1, 3, 3, 7, 20, 55, 200])), rng.choice(["hot", "hot", "hot", "a", "b", "é", None])) for i in range(900)]
    docs = stored(rows)
    first = mixing.mix(docs).collect()
    assert max(abs(x) for x in check(rows, first).values()) <= 0.5
    pick = lambda rows: sorted((r.doc_id, r.taken) for r in rows)
    assert pick(first) == pick(mixing.mix(docs.repartition(5)).collect())


def test_odd_rows(spark, stored, odd_rows):
    docs = stored(odd_rows)
    off = check(odd_rows, mixing.mix(docs).collect())
    assert len(off) == 6
    sizes = {}
    for _, text, *source in odd_rows:
        sizes.setdefault(source[0] if source else "s", []).append(len(re.findall(r"[^\x20\x09-\x0D]+", text or "")))
    target = dealt({s: sum(x) for s, x in sizes.items()})
    for s, found in sizes.items():  # about as near as any choice of documents comes
        whole, sums = sum(found), 1
        for n in found:
            sums |= sums << n
        best = min((abs(target[s] - whole * (target[s] // whole) - k) for k in range(whole + 1) if sums >> k & 1), default=0) if whole else 0
        assert abs(off[s]) <= best + 8  # each size's share is set before the knapsack closes the rest
    assert mixing.mix(docs.limit(0)).count() == 0
    assert {r.taken for r in mixing.mix(stored([(1, None, "a"), (2, "", None)])).collect()} == {0}


def test_fit():
    sizes, counts = np.array([0, 4, 6]), np.array([5, 3, 3])
    for budget, total in ((0, 0), (10, 10), (13, 12), (14, 14), (29, 28), (30, 30), (99, 30)):
        take = mixing.fit(sizes, counts, budget)
        assert (take <= counts).all() and take[0] in (0, 5) and abs(int((take * sizes).sum()) - total) <= 2
    rng = np.random.default_rng(5)
    sizes = np.unique(rng.integers(1, 200_000, 3000))
    counts = rng.integers(1, 4, len(sizes))
    budget = int((sizes * counts).sum() * 0.37)
    assert int((mixing.fit(sizes, counts, budget) * sizes).sum()) == budget


def test_columns_that_clash(spark):
    """Columns named like the operator's own come through; sizes alone give the same choice."""
    from pyspark.sql import functions as F

    names = ["n", "copies", "quota", "_rank", "_slice", "_source", "_draw", "doc", "a.b"]
    docs = spark.createDataFrame([(k % 7, "w " * (1 + k % 5), "s%d" % (k % 2), *(["%s%d" % (c, k) for c in names])) for k in range(60)], ["doc_id", "text", "source", *names])
    mixed = mixing.mix(docs)
    assert mixed.columns == [*docs.columns, "size", "source_size", "target", "taken"]
    rows = mixed.collect()
    assert len(rows) == 60 and len({r[3] for r in rows}) == 60
    for r in rows:
        assert [r[3 + j][len(c) :] for j, c in enumerate(names)] == [r[3][1:]] * len(names)
    sized = docs.select("doc_id", "source", mixing.size_in_words(F.col("text")).alias("size"), F.xxhash64("text").alias("tie"))
    pick = lambda rows: sorted((r.doc_id, r.source, r["size"], r.taken) for r in rows)
    assert pick(mixing.mix_sizes(sized, tie=F.col("tie")).collect()) == pick(rows)
