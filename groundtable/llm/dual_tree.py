"""Lloyd's rounds over integer vectors by two trees.

Vectors are dealt in blocks of a batch; each block gets a cover tree, built once and written to the shared folder. In every round the
centroids get a cover tree too, and each block's tree meets it: pairs of nodes are dropped when the least distance that two of their
members can have is above the greatest that some centroid is sure to be within. A node that is left with one centroid is
assigned whole; pairs of leaves are compared exactly, in integers. Rounds exchange sums: one row a centroid and task.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from groundtable.llm.common import small_batches, tidy
from groundtable.session import stored

#: Integers below this keep squared distances of 64 components, and sums of 2^35 vectors, within 64 bits.
LIMIT = 1 << 27
#: Vectors of a leaf at most, unless they are equal; pairs whose distances are worked out at once.
LEAF, PAIRS = 8, 1 << 15
TREE = T.StructType([T.StructField("ids", T.ArrayType(T.LongType()))] + [T.StructField(c, T.BinaryType()) for c in ("vectors", "lo", "hi", "after", "radius")])


def squared(a: np.ndarray, b: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Exact squared distances of rows a[i], b[j]."""
    out = np.empty(len(i), dtype=np.int64)
    for s in range(0, len(i), PAIRS):
        gap = a[i[s : s + PAIRS]] - b[j[s : s + PAIRS]]
        out[s : s + PAIRS] = np.einsum("ij,ij->i", gap, gap)
    return out


def spread(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The numbers start, start + 1, ... of each range, one range after another."""
    ends = np.cumsum(counts)
    return np.repeat(starts - (ends - counts), counts) + np.arange(ends[-1] if len(ends) else 0)


@dataclass
class Tree:
    """A cover tree over `points` (int64 rows), nodes in preorder.

    A node's members are points[lo:hi], its centre is points[lo], radius the distance of its farthest member; its children are the nodes
    from the next one up to after - 1, less theirs. Children's centres lie in the node, more than half its radius apart, and
    cover it within half its radius.
    """

    points: np.ndarray
    lo: np.ndarray
    hi: np.ndarray
    after: np.ndarray
    radius: np.ndarray

    def __post_init__(self):
        n = len(self.lo)
        self.leaf = self.after == np.arange(n) + 1
        parent, open_ = np.full(n, -1), []
        for i in range(n):
            while open_ and self.after[open_[-1]] <= i:
                open_.pop()
            parent[i] = open_[-1] if open_ else -1
            open_.append(i)
        self.children = np.argsort(parent, kind="stable")[1:]  # by parent; the root comes first and goes
        self.held = np.bincount(parent[1:], minlength=n)
        self.first = np.cumsum(self.held) - self.held

    def below(self, nodes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All children of the nodes, and for each the place in `nodes` of its parent."""
        counts = self.held[nodes]
        return self.children[spread(self.first[nodes], counts)], np.repeat(np.arange(len(nodes)), counts)


def grow(points: np.ndarray) -> tuple[Tree, np.ndarray]:
    """A tree over at least one point, and the place in `points` of each of the tree's points."""
    lo, hi, after, radius, order = [], [], [], [], []

    def node(members: np.ndarray, far: np.ndarray) -> None:
        """members[0] is the centre; far: squared distances from it."""
        i, most = len(lo), int(far.max())
        lo.append(len(order))
        hi.append(len(order) + len(members))
        after.append(0)
        radius.append(np.sqrt(most) * (1 + 1e-12))
        if len(members) <= LEAF or not most:
            order.extend(members.tolist())
        else:
            near, owner, centres = far.copy(), np.zeros(len(members), dtype=np.int64), [0]
            while 4 * near[k := int(np.argmax(near))] > most:  # farthest first, until half the radius covers all
                d = points[members] - points[members[k]]
                d = np.einsum("ij,ij->i", d, d)
                owner[d < near] = len(centres)
                near = np.minimum(near, d)
                centres.append(k)
            for c, k in enumerate(centres):
                own = np.flatnonzero(owner == c)
                own = np.concatenate(([k], own[own != k]))
                node(members[own], near[own])
        after[i] = len(lo)

    away = points - points[0]
    node(np.arange(len(points)), np.einsum("ij,ij->i", away, away))
    order = np.array(order)
    return Tree(points[order], np.array(lo), np.array(hi), np.array(after), np.array(radius)), order


def assign(vectors: Tree, centroids: Tree, numbers: np.ndarray) -> np.ndarray:
    """For each point of `vectors` the number of its nearest centroid, the smaller of equals. numbers: of the centroid tree's points."""
    out = np.full(len(vectors.points), -1, dtype=np.int64)
    n, q = np.zeros(1, dtype=np.int64), np.zeros(1, dtype=np.int64)
    size = centroids.hi - centroids.lo
    while len(n):
        d = np.sqrt(squared(vectors.points, centroids.points, vectors.lo[n], centroids.lo[q]))
        sure = np.full(len(vectors.lo), np.inf)
        np.minimum.at(sure, n, d + vectors.radius[n])
        keep = d - vectors.radius[n] - centroids.radius[q] <= sure[n] * (1 + 1e-9) + 1e-6
        n, q = n[keep], q[keep]
        alone = (np.bincount(n, minlength=len(vectors.lo))[n] == 1) & (size[q] == 1)
        done, of = n[alone], q[alone]
        out[spread(vectors.lo[done], vectors.hi[done] - vectors.lo[done])] = np.repeat(numbers[centroids.lo[of]], vectors.hi[done] - vectors.lo[done])
        n, q = n[~alone], q[~alone]
        open_q = ~centroids.leaf[q]
        waits = np.zeros(len(vectors.lo), dtype=bool)
        waits[n[open_q]] = True  # nodes of which some centroid node is still to be opened
        level = ~waits[n]
        exact = level & vectors.leaf[n]
        compare(vectors, centroids, numbers, n[exact], q[exact], out)
        kids, at = centroids.below(q[open_q])
        deeper = level & ~exact
        sons, of = vectors.below(n[deeper])
        stay = ~level & ~open_q
        n, q = np.concatenate((n[open_q][at], sons, n[stay])), np.concatenate((kids, q[deeper][of], q[stay]))
    return out


def compare(vectors: Tree, centroids: Tree, numbers: np.ndarray, n: np.ndarray, q: np.ndarray, out: np.ndarray) -> None:
    """Leaf against leaf: every point of leaf n with every centroid of leaf q, for each pair; of all pairs of a point the nearest counts."""
    if not len(n):
        return
    points = spread(vectors.lo[n], vectors.hi[n] - vectors.lo[n])
    pair = np.repeat(np.arange(len(n)), vectors.hi[n] - vectors.lo[n])
    counts = (centroids.hi - centroids.lo)[q[pair]]
    places = spread(centroids.lo[q[pair]], counts)
    points = np.repeat(points, counts)
    order = np.lexsort((numbers[places], squared(vectors.points, centroids.points, points, places), points))
    points, places = points[order], places[order]
    first = np.concatenate(([True], points[1:] != points[:-1]))
    out[points[first]] = numbers[places[first]]


def usable(vector: Column, dim: int, scale: int) -> Column:
    """Exactly `dim` components, none null or non-finite, and none so large that distances would not fit 64 bits."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x.cast("double")) >= LIMIT / scale))
    return F.coalesce((F.size(vector) == dim) & ~bad, F.lit(False))


def integers(vectors: DataFrame, id_col: str, vector_col: str, dim: int, scale: int) -> DataFrame:
    """id and v: floor(scale * x) of each component, of the usable vectors."""
    return vectors.filter(usable(F.col(vector_col), dim, scale)).select(F.col(id_col).cast("long").alias("id"), F.transform(vector_col, lambda x: F.floor(x.cast("double") * F.lit(float(scale))).cast("long")).alias("v"))


def forest(points: DataFrame, dim: int) -> DataFrame:
    """A row for each block: its cover tree with ids."""
    small_batches(points.sparkSession)

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            tree, order = grow(b.column("v").flatten().to_numpy().reshape(-1, dim))
            packed = (tree.points.astype("<i4"), tree.lo.astype("<i4"), tree.hi.astype("<i4"), tree.after.astype("<i4"), tree.radius.astype("<f8"))
            ids = b.column("id").take(pa.array(order))
            yield pa.RecordBatch.from_arrays([pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), ids), *(pa.array([x.tobytes()], pa.binary()) for x in packed)], names=TREE.names)

    return points.mapInArrow(tidy(build), TREE)


def trees(batches: Iterator[pa.RecordBatch], dim: int) -> Iterator[tuple[pa.Array, Tree]]:
    """ids and tree of each row of a forest."""
    for b in batches:
        for row in range(b.num_rows):
            points, lo, hi, after, radius = (np.frombuffer(b.column(c)[row].as_py(), kind) for c, kind in zip(TREE.names[1:], ("<i4", "<i4", "<i4", "<i4", "<f8"), strict=True))
            yield b.column("ids")[row].values, Tree(points.reshape(-1, dim).astype(np.int64), lo.astype(np.int64), hi.astype(np.int64), after.astype(np.int64), radius)


def sums(blocks: DataFrame, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Exact componentwise sums (Python integers) and counts of the vectors nearest to each centroid."""
    k, dim = centroids.shape

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tree, order = grow(centroids)
        total, count = np.zeros((k, dim), dtype=np.int64), np.zeros(k, dtype=np.int64)
        for _, block in trees(batches, dim):
            of = assign(block, tree, order)
            for c in np.unique(of):
                total[c] += block.points[of == c].sum(axis=0)
            count += np.bincount(of, minlength=k)
        there = np.flatnonzero(count)
        yield pa.RecordBatch.from_arrays([pa.array(there), pa.array(count[there]), pa.array(list(total[there]), pa.list_(pa.int64()))], names=["cluster", "n", "total"])

    part = blocks.mapInArrow(tidy(add), "cluster long, n long, total array<long>")
    rows = part.select("cluster", F.posexplode(F.concat("total", F.array("n")))).groupBy("cluster", "pos").agg(F.sum(F.col("col").cast("decimal(38,0)")).alias("s")).collect()
    out = np.zeros((k, dim + 1), dtype=object)
    for r in rows:  # k * (dim + 1) numbers
        out[r["cluster"], r["pos"]] = int(r["s"])
    return out[:, :dim], out[:, dim]


def lloyd(blocks: DataFrame, centroids: np.ndarray, rounds: int) -> np.ndarray:
    """The centroids after `rounds` rounds; a centroid without vectors stays."""
    for _ in range(rounds):
        total, count = sums(blocks, centroids)
        centroids = np.array([[t // int(n) for t in row] if n else old for row, n, old in zip(total, count, centroids.tolist(), strict=True)], dtype=np.int64)
    return centroids


def labelled(blocks: DataFrame, centroids: np.ndarray, id_col: str) -> DataFrame:
    """<id_col>, cluster, distance (squared) of every vector."""
    dim = centroids.shape[1]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tree, order = grow(centroids)
        for ids, block in trees(batches, dim):
            of = assign(block, tree, order)
            d = squared(block.points, centroids, np.arange(len(of)), of)
            yield pa.RecordBatch.from_arrays([ids, pa.array(of, pa.int32()), pa.array(d)], names=[id_col, "cluster", "distance"])

    return blocks.mapInArrow(tidy(work), T.StructType([T.StructField(id_col, T.LongType()), T.StructField("cluster", T.IntegerType()), T.StructField("distance", T.LongType())]))


def seeds(points: DataFrame, k: int, seed: int) -> np.ndarray:
    """The k vectors of smallest sha256 of "<seed>:<id>", in that order; of equal ids the smaller vector first, null ids last."""
    drawn = points.withColumn("h", F.sha2(F.concat(F.lit(f"{seed}:"), F.col("id").cast("string")), 256))
    return np.array([r["v"] for r in drawn.orderBy(F.col("h").asc_nulls_last(), "v").limit(k).collect()], dtype=np.int64)


def cluster(vectors: DataFrame, k: int = 16, rounds: int = 3, scale: int = 64, dim: int = 64, seed: int = 1, id_col: str = "vec_id", vector_col: str = "embedding") -> tuple[DataFrame, np.ndarray]:
    """<id_col>, cluster, distance (squared) of every vector kept, and the final centroids.

    Kept are vectors with exactly `dim` components, none null or non-finite; each component becomes floor(scale * x). A component
    whose integer would be LIMIT or more (or -LIMIT or less) drops its vector, since distances would not fit. The first centroids
    are seeds(); with fewer vectors than k there are as many centroids as vectors. Rounds assign every vector to its nearest
    centroid, ties to the smaller number, and take floor(sum / count) as the new one; empty ones stay. Repeated rows count as often as they
    come, whatever their ids; null ids take part. An empty table gives no rows and no centroids.
    """
    points = integers(vectors, id_col, vector_col, dim, scale)
    blocks = stored(forest(points, dim), "forest")
    centroids = seeds(points, k, seed)
    if not len(centroids):
        return vectors.sparkSession.createDataFrame([], f"`{id_col}` long, cluster int, distance long"), np.zeros((0, dim), dtype=np.int64)
    centroids = lloyd(blocks, centroids, rounds)
    return labelled(blocks, centroids, id_col), centroids


def report(vectors: DataFrame, **options) -> DataFrame:
    """cluster()'s rows with cluster_inertia and inertia (distances summed over the cluster, over all; null beyond 64 bits) and centroid_sha256."""
    rows, centroids = cluster(vectors, **options)
    spark = vectors.sparkSession
    rows = stored(rows, "clustered")
    per = rows.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("s"))
    per = per.crossJoin(per.agg(F.sum("s").alias("whole")))  # a row a centroid, by one row
    digests = [(c, hashlib.sha256(",".join(map(str, x)).encode()).hexdigest()) for c, x in enumerate(centroids.tolist())]
    per = per.join(spark.createDataFrame(digests, "cluster int, centroid_sha256 string"), "cluster")
    per = per.select("cluster", F.col("s").try_cast("long").alias("cluster_inertia"), F.col("whole").try_cast("long").alias("inertia"), "centroid_sha256")
    return rows.join(F.broadcast(per), "cluster").select(rows.columns[0], "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
