"""Exact quantiles and dense numbers against sorting by hand."""

import random
from statistics import median

import numpy as np
from pyspark.sql import functions as F

from groundtable.operators import order


def test_quantiles(spark):
    rng = random.Random(6)
    groups = {
        "hot": [rng.gauss(0, 1) for _ in range(20_000)], "few": [3.0], "two": [1.0, 2.0], "equal": [7.0] * 900, "steps": [float(rng.randrange(4)) for _ in range(5_001)],
        None: [float(i) for i in range(1_000)], "wild": [rng.choice([-1, 1]) * 10 ** rng.uniform(-300, 300) for _ in range(3_000)],
    }
    rows = [(g, v) for g, vs in groups.items() for v in vs] + [("few", None), ("none", None), ("two", float("nan"))]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "g string, v double").repartition(7)
    for accuracy in (100, 10_000):  # marks far apart and close together
        got = {r.g: r for r in order.quantiles(df, ["g"], "v", (0.5, 0.0, 0.9, 1.0), accuracy).collect()}
        assert set(got) == set(groups)
        for g, vs in groups.items():
            assert (got[g].n, got[g].least, got[g].most, got[g].q1, got[g].q3) == (len(vs), min(vs), max(vs), min(vs), max(vs))
            assert np.isclose(got[g].q0, median(vs), rtol=1e-12) and np.isclose(got[g].q2, np.quantile(vs, 0.9), rtol=1e-12)
    one = order.quantiles(df, [], "v").collect()
    assert len(one) == 1 and one[0].n == len(rows) - 3 and one[0].asDict().keys() == {"n", "mean", "least", "most", "q0"}
    assert order.quantiles(df.limit(0), ["g"], "v").count() == 0


def test_no_group_in_one_task(spark):
    """Of a group only what is between the marks is ever sorted or shuffled."""
    n = 400_000
    df = spark.range(n).select(F.lit(1).alias("g"), F.rand(3).alias("v"))
    found = order.quantiles(df, ["g"], "v")
    found.collect()
    plan, sizes = found._jdf.queryExecution().executedPlan(), []

    def walk(node):
        if "Window" in node.nodeName() or "Exchange" in node.nodeName():
            m = node.metrics()
            sizes.extend(m.apply(k).value() for k in ("numOutputRows", "shuffleRecordsWritten", "spillSize") if m.contains(k) and k != "spillSize")
        for k in range(node.children().size()):
            walk(node.children().apply(k))
        if "AdaptiveSparkPlan" in node.nodeName():
            walk(node.executedPlan())
        if "QueryStage" in node.nodeName():
            walk(node.plan())

    walk(plan)
    assert sizes and max(sizes) < n * 12 / order.ACCURACY + 10


def test_numbered(spark):
    df = spark.range(5_000).select((F.col("id") * 7919 % 1_000).alias("a"), F.lit("x").alias("b"))
    got = order.numbered(df, ["a", "b"]).collect()
    assert sorted(r.nth for r in got) == list(range(5_000))
    assert [r.a for r in sorted(got, key=lambda r: r.nth)] == sorted(r.a for r in got)
    assert order.numbered(df.limit(0), ["a"]).count() == 0
