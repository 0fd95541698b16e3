"""Search against brute force."""

import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from groundtable import session
from groundtable.llm import ann

DATA = "/root/testdata"


def table(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int, score string")


def search(df, **more):
    return ann.nearest(df, F.col("vec_id") % 20 == 0, **more).orderBy("query_id", "rank").collect()


def brute(ids, vectors, k):
    out = {}
    for q, v in zip(ids, vectors, strict=True):
        if q % 20 == 0:
            s = (vectors * v).sum(axis=1)
            order = [i for i in np.lexsort((ids, -s)) if ids[i] != q][:k]
            out[q] = [(int(ids[i]), float(s[i])) for i in order]
    return out


def test_recall(spark):
    rng = np.random.default_rng(2)
    v = rng.standard_normal((3000, 32)).astype(np.float32)
    v[100:400] = v[5]  # one very common vector
    df = table(spark, [(i, [float(x) for x in r], 0, "s") for i, r in enumerate(v)])
    truth = brute(np.arange(3000), v.astype(float), 20)
    rows = search(df, block=1000, query_block=64)
    assert len(rows) == 150 * 20
    hits = 0
    for q, best in truth.items():
        mine = [r for r in rows if r.query_id == q]
        assert [r.rank for r in mine] == list(range(1, 21))
        hits += len({r.vec_id for r in mine} & {i for i, _ in best})
        for r in mine:
            assert abs(r.score - float((v[q].astype(float) * v[r.vec_id].astype(float)).sum())) < 1e-9
    assert hits / (150 * 20) >= 0.9
    copies = [r for r in rows if r.query_id == 200]
    assert [r.vec_id for r in copies] == [5, *range(100, 119)]


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (1, [0.5, 0.5]), (2, [0.5, -0.5]), (3, None), (4, [0.0, 0.0]), (5, [nan, 1.0]), (6, [inf, 1.0]), (7, [None, 1.0]), (8, []), (9, [1.0, 0.0, 0.0]), (20, [nan, 1.0]), (None, [1.0, 0.0]), (1, [0.5, 0.5]), (40, [3.0, 0.0])]
    found = [(r.query_id, r["rank"], r.vec_id, r.score) for r in search(table(spark, [(i, v, 0, "s") for i, v in rows]))]
    assert found == [(0, 1, 40, 3.0), (0, 2, 1, 0.5), (0, 3, 2, 0.5), (40, 1, 0, 3.0), (40, 2, 1, 1.5), (40, 3, 2, 1.5)]
    assert search(table(spark, [])) == []


@pytest.mark.skipif(not os.path.isdir(DATA), reason="the driver's tables are not here")
@pytest.mark.parametrize("scale", ["sf0.001", "sf0.01", "sf0.1"])
def test_recall_on_the_tables(spark, scale):
    """At least 0.9 of the true neighbours at every size."""
    df = session.table(spark, f"{DATA}/{scale}", "embeddings")
    rows = df.select("vec_id", "embedding").toPandas()
    truth = brute(rows["vec_id"].to_numpy(), np.stack(rows["embedding"]).astype(float), 20)
    found = {}
    for r in search(df):
        found.setdefault(r.query_id, set()).add(r.vec_id)
    assert sum(len(found[q] & {i for i, _ in best}) for q, best in truth.items()) >= 0.9 * sum(map(len, truth.values()))
