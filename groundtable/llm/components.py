"""Connected components of an edge list by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from groundtable.session import cut


def components(edges: DataFrame, most_rounds: int = 60) -> DataFrame:
    """id, root: the smallest id that each id of the edges (a long, b long) is connected to.

    Each round points every node's larger neighbours at its smallest one, then every node and its smaller
    neighbours at the smallest (large and small stars), so trees flatten in a number of rounds that grows with
    the logarithm of their size. Least neighbours come from partial aggregation, so a hub is one row a task.
    Rounds are written to the shared folder; it ends when a round changes nothing. An answer that is not ready after `most_rounds` is an error.
    """
    now = cut(edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    before = None
    for _ in range(most_rounds):
        both = now.union(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        # large star: neighbours above a node go to its least neighbour (or itself)
        large = both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        # small star: neighbours below a node, and itself, go to its least neighbour
        small = large.groupBy("a").agg(F.min("b").alias("m"))
        now = large.join(small, "a").select(F.explode(F.array(F.struct("a", F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("e")).select("e.*").filter("a <> b").distinct()
        now = cut(now)
        state = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == before:
            break
        before = state
    else:
        raise RuntimeError(f"components still change after {most_rounds} rounds")
    return now.groupBy(F.col("a").alias("id")).agg(F.min("b").alias("root"))
