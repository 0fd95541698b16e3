"""Exact histogram of encoded lengths, and what it answers.

Documents are counted by exact length first (partial counts before the shuffle, so a third of all
documents with one length is one row a task). Suffix sums then run over distinct lengths: within blocks
of lengths side by side, and over one row a block.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Lengths in a block of the suffix sums.
BLOCK = 1024


def histogram(lengths: DataFrame, column: str = "n_tokens") -> DataFrame:
    """n_tokens, n_docs: documents of each exact length. Null lengths are not counted."""
    return lengths.filter(F.col(column).isNotNull()).groupBy(F.col(column).alias("n_tokens")).agg(F.count(F.lit(1)).alias("n_docs"))


def suffix_sums(hist: DataFrame) -> DataFrame:
    """For each length of a histogram as a context limit:

    docs_at_least, tokens_at_least: documents of that length or more, and their tokens; total_docs,
    total_tokens: of all; truncated_tokens: what all documents have once each is cut to the limit;
    share_shorter: documents shorter than the limit as a share of all. An empty histogram gives no rows.
    """
    tokens = F.col("n_tokens") * F.col("n_docs")
    rows = hist.withColumn("block", F.floor(F.col("n_tokens") / BLOCK))
    down = Window.partitionBy("block").orderBy(F.desc("n_tokens")).rowsBetween(Window.unboundedPreceding, 0)
    blocks = rows.groupBy("block").agg(F.sum("n_docs").alias("d"), F.sum(tokens).alias("t"))
    above, all_ = Window.orderBy(F.desc("block")).rowsBetween(Window.unboundedPreceding, -1), Window.orderBy(F.desc("block")).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    zero = F.lit(0).cast("long")
    blocks = blocks.select(
        "block", F.coalesce(F.sum("d").over(above), zero).alias("docs_above"), F.coalesce(F.sum("t").over(above), zero).alias("tokens_above"),
        F.sum("d").over(all_).alias("total_docs"), F.sum("t").over(all_).alias("total_tokens"),
    )
    return (
        rows.withColumns({"d": F.sum("n_docs").over(down), "t": F.sum(tokens).over(down)})
        .join(blocks, "block")
        .select(
            "n_tokens", "n_docs", (F.col("d") + F.col("docs_above")).alias("docs_at_least"), (F.col("t") + F.col("tokens_above")).alias("tokens_at_least"), "total_docs", "total_tokens",
        )
        .withColumns({
            "truncated_tokens": F.col("total_tokens") - F.col("tokens_at_least") + F.col("n_tokens") * F.col("docs_at_least"),
            "share_shorter": 1 - F.col("docs_at_least") / F.col("total_docs"),
        })
    )


def truncated_totals(sums: DataFrame, limits: list[int]) -> DataFrame:
    """context_limit, truncated_tokens for any limits, those between two lengths included."""
    asked = sums.sparkSession.createDataFrame([(x,) for x in limits], "context_limit long")
    # the longer documents of a limit are those at least as long as the next length that occurs
    cells = sums.select(*(F.when(F.col("n_tokens") >= x, F.struct("n_tokens", "docs_at_least", "tokens_at_least")).alias(f"l{i}") for i, x in enumerate(limits)), "total_tokens")
    one = cells.agg(F.max("total_tokens").alias("all"), *(F.min(f"l{i}").alias(f"l{i}") for i in range(len(limits))))
    found = one.select(F.explode(F.array(*(F.struct(F.lit(x).cast("long").alias("context_limit"), F.coalesce(F.col("all") - F.col(f"l{i}.tokens_at_least") + x * F.col(f"l{i}.docs_at_least"), F.col("all")).alias("truncated_tokens")) for i, x in enumerate(limits)))).alias("r")).select("r.*")
    return asked.join(found, "context_limit", "left")


def quantiles(sums: DataFrame, shares: list[float]) -> DataFrame:
    """share, n_tokens: the least length such that at least that share of documents is no longer."""
    up_to = (F.col("total_docs") - F.col("docs_at_least") + F.col("n_docs")) / F.col("total_docs")
    one = sums.agg(*(F.min(F.when(up_to >= q, F.col("n_tokens"))).alias(f"q{i}") for i, q in enumerate(shares)))
    return one.select(F.explode(F.array(*(F.struct(F.lit(q).alias("share"), F.col(f"q{i}").alias("n_tokens")) for i, q in enumerate(shares)))).alias("r")).select("r.*")
