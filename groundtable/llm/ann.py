"""Nearest neighbours by collision counting.

Every vector is projected on single random directions; for each direction an array holds the projections
in order. A query opens a window around its own projection in every array and counts, for each vector,
the windows that hold it. Windows widen step by step over the same arrays (virtual rehashing); a vector
that reaches the collision threshold is verified with the exact inner product, and widening ends once
enough have been verified. When windows hold everything, everything has been verified, so small or odd
inputs are searched exactly.

The largest inner product is turned into the least distance by one more coordinate, which brings all
vectors of a block to one length; queries have 0 there.

The table is dealt into blocks of about `block` vectors and `query_block` queries; each pair of blocks is
one group. Blocks are joined on their numbers, so each vector goes once to each block of queries and each
query once to each block of vectors. Of a small table the queries are dealt into more blocks, for `tiles` groups.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Directions, first half window (in deviations of a projection), growth of windows, threshold as a share of directions.
DIRECTIONS, HALF, GROWTH, THRESHOLD = 64, 0.7, 1.2, 0.65
#: Vectors of a block of n that are verified before widening ends, besides those asked for: this many times the root of n.
VERIFY = 14
#: Queries that a tile has at least, where queries are dealt out for more tiles.
LEAST_QUERIES = 64


def usable(vector: Column) -> Column:
    """Not null, not empty, not zero, no null or non-finite component."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf"))))
    return vector.isNotNull() & (F.size(vector) > 0) & ~bad & F.exists(vector, lambda x: x != 0)


def directions(dim: int, n: int, seed: int) -> np.ndarray:
    """n directions of `dim` coordinates: orthogonal as far as the dimension allows, each of length sqrt(dim)."""
    rng, out = np.random.default_rng(seed), []
    while sum(x.shape[1] for x in out) < n:
        out.append(np.linalg.qr(rng.standard_normal((dim, dim)))[0])
    return np.concatenate(out, axis=1)[:, :n] * np.sqrt(dim)


class Block:
    """The sorted arrays of a block of vectors, and the search in them."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, seed: int):
        order = np.argsort(ids, kind="stable")
        self.ids, self.vectors = ids[order], np.ascontiguousarray(vectors[order])
        self.short = self.vectors.astype(np.float32)
        norms = np.sqrt((self.vectors**2).sum(axis=1))
        top = norms.max()
        scaled = np.column_stack([self.vectors / top, np.sqrt(np.maximum(0, 1 - (norms / top) ** 2))])
        self.a = directions(scaled.shape[1], DIRECTIONS, seed)
        at = scaled @ self.a
        self.order = np.ascontiguousarray(np.argsort(at, axis=0).T.astype(np.int32))
        self.sorted = np.ascontiguousarray(np.sort(at, axis=0).T)

    def search(self, query_id: int, query: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids and inner products of the best k found: the largest first, ties to the smaller id."""
        n = len(self.ids)
        at = np.append(query / np.sqrt((query**2).sum()), 0.0) @ self.a
        counts, seen = np.zeros(n, dtype=np.int64), np.zeros(n, dtype=bool)
        least, enough = max(1, int(THRESHOLD * DIRECTIONS)), k + 1 + int(VERIFY * n**0.5)
        lo = hi = np.array([np.searchsorted(s, x) for s, x in zip(self.sorted, at, strict=True)])
        half, found, scores = HALF, [], []
        while True:
            new_lo = np.array([np.searchsorted(s, x - half, "left") for s, x in zip(self.sorted, at, strict=True)])
            new_hi = np.array([np.searchsorted(s, x + half, "right") for s, x in zip(self.sorted, at, strict=True)])
            fresh = [o[a:b] for o, p, q, r, t in zip(self.order, new_lo, lo, hi, new_hi, strict=True) for a, b in ((p, q), (r, t)) if a < b]
            if fresh:
                counts += np.bincount(np.concatenate(fresh), minlength=n)
            lo, hi = new_lo, new_hi
            whole = bool((hi - lo).min() >= n)
            now = np.flatnonzero(~seen & ((counts >= least) | whole))
            if len(now):
                seen[now] = True
                found.append(now)
                scores.append(self.short[now] @ query.astype(np.float32))
            if whole or sum(map(len, found)) >= enough:
                break
            half *= GROWTH
        rows, near = np.concatenate(found), np.concatenate(scores)
        near = np.where(self.ids[rows] == query_id, -np.inf, near)
        if len(rows) > k:  # all within rounding of the k-th stay, for the exact order
            kth = np.partition(near, len(near) - k)[len(near) - k]
            rows = rows[near >= kth - 1e-4 * (1 + abs(kth))] if np.isfinite(kth) else rows
        rows = rows[self.ids[rows] != query_id]
        exact = (self.vectors[rows] * query).sum(axis=1)
        best = np.lexsort((self.ids[rows], -exact))[:k]
        return self.ids[rows[best]], exact[best]


def nearest(
    vectors: DataFrame, is_query: Column, k: int = 20, id_col: str = "vec_id", vector_col: str = "embedding", block: int = 16384, query_block: int = 4096, tiles: int = 24, seed: int = 7
) -> DataFrame:
    """query_id, rank (from 1), <id_col>, score: the k rows of largest inner product found for each query row.

    Rows whose id is the query's own are not candidates. Vectors that are null, empty, zero or hold null or
    non-finite components take no part, nor do rows with a null id; vectors of another length than the
    query's are not comparable and are not candidates. Repeated rows (same id) count as one: the
    first in the order of their components. An empty table gives no rows; with fewer than k candidates all are returned.
    """
    rows = (
        vectors.filter(usable(F.col(vector_col)) & F.col(id_col).isNotNull())
        .select(F.col(id_col).cast("long").alias("id"), F.transform(vector_col, lambda x: x.cast("double")).alias("v"), F.coalesce(is_query, F.lit(False)).alias("q"))
        .groupBy("id").agg(F.min("v").alias("v"), F.max("q").alias("q"))
        .withColumn("dim", F.size("v"))
    )
    n, queries = vectors.agg(F.count(F.lit(1)), F.coalesce(F.sum(is_query.cast("int")), F.lit(0))).first()
    blocks, query_blocks = max(1, -(-n // block)), max(1, -(-queries // query_block))
    query_blocks = max(query_blocks, min(-(-tiles // blocks), -(-queries // LEAST_QUERIES)))  # small tables too give work to many tasks
    keys = ["dim", "block", "query_block"]
    index = rows.withColumns({"block": F.pmod(F.xxhash64("id"), F.lit(blocks)), "query_block": F.explode(F.sequence(F.lit(0), F.lit(query_blocks - 1)))})
    asked = rows.filter("q").withColumns({"query_block": F.pmod(F.xxhash64("id", F.lit(1)), F.lit(query_blocks)).cast("int"), "block": F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long")))})

    def search(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        out = {"query_id": [], "id": [], "score": []}
        if len(left) and len(right):
            b = Block(left["id"].to_numpy(), np.stack(left["v"]), seed)
            for i, v in zip(right["id"], right["v"], strict=True):
                ids, scores = b.search(i, np.asarray(v), k)
                out["query_id"].append(np.full(len(ids), i))
                out["id"].append(ids)
                out["score"].append(scores)
        return pd.DataFrame({c: np.concatenate(x) if x else np.zeros(0) for c, x in out.items()})

    found = index.select(*keys, "id", "v").groupBy(*keys).cogroup(asked.select(*keys, "id", "v").groupBy(*keys)).applyInPandas(search, "query_id long, id long, score double")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "id"))
    return found.withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", F.col("rank").cast("int").alias("rank"), F.col("id").alias(id_col), "score")
