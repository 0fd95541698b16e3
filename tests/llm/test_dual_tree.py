"""Clusters against plain integer arithmetic; the trees' promises."""

import hashlib
import math

import numpy as np
from pyspark.sql import functions as F

from groundtable.llm import dual_tree


def by_hand(rows, k, rounds, scale, dim, seed=1):
    kept = [(i, [math.floor(scale * float(x)) for x in v]) for i, v in rows if v is not None and len(v) == dim and all(x is not None and math.isfinite(x) for x in v)]
    drawn = sorted(kept, key=lambda r: (r[0] is None, hashlib.sha256(f"{seed}:{r[0]}".encode()).hexdigest(), r[1]))
    centroids = [v for _, v in drawn[:k]]
    gap = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b, strict=True))
    nearest = lambda v: min(range(len(centroids)), key=lambda c: (gap(v, centroids[c]), c))
    for _ in range(rounds):
        of = [nearest(v) for _, v in kept]
        for c in range(len(centroids)):
            own = [v for (_, v), x in zip(kept, of, strict=True) if x == c]
            centroids[c] = [sum(xs) // len(own) for xs in zip(*own, strict=True)] if own else centroids[c]
    out = [(i, c := nearest(v), gap(v, centroids[c])) for i, v in kept]
    inertia = {c: sum(d for _, x, d in out if x == c) for c in range(len(centroids))}
    digest = [hashlib.sha256(",".join(map(str, x)).encode()).hexdigest() for x in centroids]
    return sorted(((i, c, d, inertia[c], sum(inertia.values()), digest[c]) for i, c, d in out), key=str)


def test_report(spark):
    rng = np.random.default_rng(4)
    hubs = rng.normal(0, 3, (9, 8))
    rows = [(int(i), [float(x) for x in np.float32(hubs[i % 9] + rng.normal(0, 0.3, 8))]) for i in range(700)]
    rows += [(1000 + i, [0.5] * 8) for i in range(300)] + [(5, rows[5][1])] * 3 + [(None, [1.0] * 8), (None, [-1.0] * 8)]
    odd = [(2000, None), (2001, []), (2002, [1.0] * 7), (2003, [None] + [1.0] * 7), (2004, [float("nan")] * 8), (2005, [float("inf")] + [0.0] * 7), (2006, [0.0] * 8), (2007, [-0.01] * 8)]
    df = spark.createDataFrame(rows + odd, "vec_id long, embedding array<float>").withColumns({"Cluster": F.lit("x"), "distance": F.lit("y"), "v": F.lit(1), "id": F.lit(2)})
    options = {"k": 7, "rounds": 3, "scale": 64, "dim": 8}
    got = dual_tree.report(df.repartition(3), **options)
    assert got.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
    expected = by_hand([(i, v and [x if x is None else float(np.float32(x)) for x in v]) for i, v in rows + odd], 7, 3, 64, 8)
    assert sorted(map(tuple, got.collect()), key=str) == expected
    few = df.filter("vec_id in (3, 4, 2004)")
    assert [r.distance for r in dual_tree.report(few, **options).collect()] == [0, 0]
    assert dual_tree.report(df.limit(0), **options).count() == 0
    far = spark.createDataFrame([(1, [1e30] * 8), (2, [2e6] * 8), (3, [-2e6] * 8)], "vec_id long, embedding array<float>")
    assert sorted(r.vec_id for r in dual_tree.report(far, k=1, rounds=1, dim=8).collect()) == [2, 3]


def test_equal_distances_go_to_the_smaller_number():
    points = np.array([[x, y] for x in range(-6, 7) for y in range(-6, 7)], dtype=np.int64)
    centroids = np.array([[4, 0], [0, 4], [-4, 0], [0, -4], [4, 0], [0, 0]], dtype=np.int64)
    tree, order = dual_tree.grow(points)
    middle, numbers = dual_tree.grow(centroids)
    d = ((tree.points[:, None] - centroids[None]) ** 2).sum(axis=2)
    assert (dual_tree.assign(tree, middle, numbers) == d.argmin(axis=1)).all()
    assert sorted(order.tolist()) == list(range(len(points)))


def test_cover_tree_and_pruning(monkeypatch):
    rng = np.random.default_rng(9)
    hubs = rng.integers(-20_000, 20_000, (16, 16))
    points = np.repeat(hubs, 120, axis=0) + rng.integers(-300, 300, (1920, 16))
    points[1000:1400] = points[1000]
    tree, order = dual_tree.grow(points)
    assert (tree.points == points[order]).all()
    for i in range(len(tree.lo)):
        d = np.sqrt(((tree.points[tree.lo[i] : tree.hi[i]] - tree.points[tree.lo[i]]) ** 2).sum(axis=1))
        assert d.max() <= tree.radius[i] <= d.max() * (1 + 1e-9)
        kids, _ = tree.below(np.array([i]))
        if len(kids):
            assert tree.lo[kids[0]] == tree.lo[i] and tree.hi[kids[-1]] == tree.hi[i] and (tree.lo[kids[1:]] == tree.hi[kids[:-1]]).all()
            assert tree.radius[kids].max() <= tree.radius[i] / 2 * (1 + 1e-9)
            gaps = np.sqrt(((tree.points[tree.lo[kids]][:, None] - tree.points[tree.lo[kids]][None]) ** 2).sum(axis=2))
            assert gaps[np.triu_indices(len(kids), 1)].min() > tree.radius[i] / 2 * (1 - 1e-9)
    middle, numbers = dual_tree.grow(hubs)
    pairs, own = [], dual_tree.squared
    monkeypatch.setattr(dual_tree, "squared", lambda a, b, i, j: pairs.append(len(i)) or own(a, b, i, j))
    of = dual_tree.assign(tree, middle, numbers)
    assert (of == ((tree.points[:, None] - hubs[None]) ** 2).sum(axis=2).argmin(axis=1)).all()
    assert sum(pairs) < 0.1 * len(points) * len(hubs)  # most pairs are never worked out
