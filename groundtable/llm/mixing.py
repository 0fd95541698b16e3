"""Mixing sources to target weights by fitting subset sums.

Every document has a size in words. Sources get targets by weight; a target of t copies and a bit is met by
t copies of every document and a choice of documents whose sizes add up to the rest. The choice is made on
counts: documents are counted by exact size, a source's counts go to one group (as many rows as it has sizes,
not documents), each size gives its share, and a bounded knapsack over the sizes left closes what remains.
Documents are then chosen for each size in a seeded order.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from groundtable.llm.common import SPACE, quoted

#: Hash slices of a (source, size); only the slice in which the quota ends is ordered.
SLICES = 256
#: What the knapsack is left with at most, in words, where the sizes allow it.
REST = 1 << 15


def size_in_words(text: Column) -> Column:
    """Number of words `[^\\x20\\x09-\\x0D]+`; null counts 0."""
    return F.coalesce(F.regexp_count(text, F.lit(SPACE.replace("[", "[^", 1) + "+")), F.lit(0)).cast("long")


def targets(totals: DataFrame, weights: tuple[int, ...] = (3, 1, 2), share: float = 1.5, most: float = 2.0) -> DataFrame:
    """source, source_size -> and target double: `share` of all sizes dealt by weight, none above `most` times its source.

    Sources take the weights in turn, by code point, null last. With all sources ordered by where they hit
    their cap, the capped ones come first and the others share what is left by weight, which is where dealing
    out the excess again and again ends. The windows run over one row a source.
    """
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last()))
    weight = F.element_at(F.array(*(F.lit(float(w)) for w in weights)), ((place - 1) % len(weights) + 1).cast("int"))
    rows = totals.withColumns({"place": place, "w": weight, "cap": most * F.col("source_size")})
    by_cap = Window.orderBy(F.col("cap") / F.col("w"), "place")
    all_ = Window.partitionBy(F.lit(1))
    before, after = by_cap.rowsBetween(Window.unboundedPreceding, -1), by_cap.rowsBetween(0, Window.unboundedFollowing)
    level = (share * F.sum("source_size").over(all_) - F.coalesce(F.sum("cap").over(before), F.lit(0.0))) / F.sum("w").over(after)
    rows = rows.withColumn("level", level).withColumn("capped", F.col("level") > F.col("cap") / F.col("w"))
    shared = F.max(F.when(~F.col("capped"), F.col("level"))).over(all_)
    return rows.withColumn("shared", shared).select("source", "source_size", F.when(F.col("capped"), F.col("cap")).otherwise(F.col("w") * F.col("shared")).alias("target"))


def fit(sizes: np.ndarray, counts: np.ndarray, budget: int) -> np.ndarray:
    """How many documents of each size to take so that their sizes add up as near to `budget` as can be found."""
    take = np.zeros(len(sizes), dtype=np.int64)
    use = np.flatnonzero((sizes > 0) & (counts > 0))
    total = int(sum(int(s) * int(c) for s, c in zip(sizes[use], counts[use], strict=True)))
    if budget <= 0 or not total:
        return take
    if budget >= total:
        take[use] = counts[use]
        return take
    left = budget
    for i in use:  # the share of each size, in whole documents
        take[i] = int(counts[i]) * budget // total
        left -= int(take[i]) * int(sizes[i])
    for i in use[np.argsort(-sizes[use], kind="stable")]:  # the rounded-off part, from the largest sizes down
        if left <= REST:
            break
        more = min(int(counts[i] - take[i]), max(0, left - REST // 2) // int(sizes[i]))
        take[i] += more
        left -= more * int(sizes[i])
    # bounded knapsack: bit s of `sums` tells that s can be reached; counts are split in powers of two
    fits = use[(counts[use] > take[use])]
    if not left or not len(fits):
        return take
    width = 2 * left  # a sum beyond is farther off than none
    mask, sums, steps = (1 << (width + 1)) - 1, 1, []
    for i in fits[np.argsort(sizes[fits], kind="stable")]:
        spare, part = int(counts[i] - take[i]), 1
        while spare > 0 and int(sizes[i]) <= width and not sums >> left & 1:
            n = min(part, spare)
            grown = (sums | sums << (n * int(sizes[i]))) & mask if n * int(sizes[i]) <= width else sums
            if grown != sums:
                steps.append((sums, i, n))
                sums = grown
            spare, part = spare - n, part * 2
            if n * int(sizes[i]) > width:
                break
        if sums >> left & 1:
            break
    under = (sums & ((1 << (left + 1)) - 1)).bit_length() - 1
    over = sums >> left
    over = left + (over & -over).bit_length() - 1 if over else 4 * left
    at = under if left - under <= over - left else over
    for before, i, n in reversed(steps):
        if not before >> at & 1:
            take[i] += n
            at -= n * int(sizes[i])
    return take


def quotas(counts: DataFrame, goals: DataFrame) -> DataFrame:
    """_source, size -> copies (of every document), extra (documents that get one more)."""

    def plan(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("size", kind="stable")
        whole, goal = int(group["source_size"].iloc[0]), float(group["target"].iloc[0])
        copies = int(goal // whole) if whole else 0
        extra = fit(group["size"].to_numpy(), group["n"].to_numpy(), round(goal - copies * whole) if whole else 0)
        return pd.DataFrame({"_source": group["_source"], "size": group["size"], "copies": copies, "extra": extra, "source_size": whole, "target": goal})

    rows = counts.join(goals, "_source").select("_source", "size", "n", "source_size", "target")
    return rows.groupBy("_source").applyInPandas(plan, "_source string, size long, copies long, extra long, source_size long, target double")


ADDED = ("size", "source_size", "target", "taken")


def mix(docs: DataFrame, seed: int = 42, weights: tuple[int, ...] = (3, 1, 2), share: float = 1.5) -> DataFrame:
    """`docs` with size, source_size, target (its source's) and taken: the words the mix takes of it, repeats counted.

    taken is 0, 1 or 2 times the size. Null texts have size 0 and are never taken; documents without a source are
    a source of their own, the last. Which documents of a size are taken depends on the seed, their ids and texts
    alone, so reruns agree; of equal rows any may be taken, which gives the same rows. Input columns named like the
    added ones are replaced, all others stay, whatever their names. An empty table gives no rows.
    """
    return mix_sizes(docs.drop(*ADDED).withColumn("size", size_in_words(F.col("text"))), seed, weights, share, F.xxhash64("text"))


def mix_sizes(rows: DataFrame, seed: int = 42, weights: tuple[int, ...] = (3, 1, 2), share: float = 1.5, tie: Column | None = None) -> DataFrame:
    """mix() for rows that have doc_id, source and size already; `tie`, a hash of the text, tells rows of one id apart."""
    own = [c for c in rows.columns if c.lower() not in ADDED]
    named = F.coalesce(F.concat(F.lit("="), "source"), F.lit(""))
    draw = F.xxhash64(F.lit(seed), F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(0).cast("long") if tie is None else tie)
    # columns of the caller travel in one, so that no name of theirs meets one of these
    rows = rows.select(F.struct(*quoted(own)).alias("doc"), "size", "source", named.alias("_source"), draw.alias("_draw"))
    return _select(rows, weights, share).select("doc.*", *ADDED)


def _select(rows: DataFrame, weights: tuple[int, ...], share: float) -> DataFrame:
    rows = rows.withColumn("_slice", F.pmod(F.hash("_draw"), F.lit(SLICES)))
    sliced = rows.groupBy("_source", "source", "size", "_slice").agg(F.count(F.lit(1)).alias("n"))
    counts = sliced.groupBy("_source", "source", "size").agg(F.sum("n").alias("n"))
    goals = targets(counts.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).alias("source_size")), weights, share)
    goals = goals.select(F.coalesce(F.concat(F.lit("="), "source"), F.lit("")).alias("_source"), "source_size", "target")
    before = F.coalesce(F.sum("n").over(Window.partitionBy("_source", "size").orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    quota = sliced.join(quotas(counts, goals), ["_source", "size"]).select(
        "_source", "size", "_slice", "n", "copies", "source_size", "target", F.greatest(F.lit(0).cast("long"), F.col("extra") - before).alias("quota")
    )
    order = F.row_number().over(Window.partitionBy("_source", "size", "_slice").orderBy("_draw"))
    chosen = rows.join(quota, ["_source", "size", "_slice"]).withColumn("_rank", F.when(F.col("quota") <= 0, F.lit(1)).otherwise(order))
    return chosen.withColumn("taken", F.col("size") * (F.col("copies") + (F.col("_rank") <= F.col("quota")).cast("long")))
