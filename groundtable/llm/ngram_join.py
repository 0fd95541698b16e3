"""Similarity join on word shingles with Bayesian pruning.

Texts are sets of `words` words in a row; texts of the same set are copies and form one class. Every class has
MinHash values; classes that agree on a whole band of them are candidates. Candidates' values are compared a
few at a time: a pair is dropped as soon as the posterior probability that its Jaccard similarity reaches the
threshold falls below a tolerance. What is left is verified exactly on the sets.

No pair is ever a row. A band's group is cut in chunks and pairs of chunks are compared in one task; what
leaves it is a forest of the surviving pairs, at most one row for each member. The forests' components are
then cut in chunks likewise, and each pair of chunks gives its members' numbers of links and a forest
of the links. Small groups are compared together, large ones spread over as many tasks as they have pairs of chunks.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from math import lgamma

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from groundtable.llm.byte_words import find_words
from groundtable.llm.common import SPACE, fresh, mix, quoted, runs, small_batches, sorted_groups, tidy
from groundtable.llm.components import components
from groundtable.session import cut

#: MinHash values, values in a band, values compared at a time.
HASHES, BAND, STEP = 96, 4, 32
#: Classes in a chunk of a band's group; classes and shingles in a chunk of a component.
CHUNK, COMPONENT_CHUNK, SHINGLES = 512, 256, 1 << 17
#: A pair is dropped when the posterior probability of reaching the threshold is below this.
TOLERANCE = 1e-7
MULTIPLIERS = np.random.default_rng(20).integers(1, 1 << 63, HASHES, dtype=np.uint64) | np.uint64(1)
SHIFTS = np.random.default_rng(21).integers(0, 1 << 63, HASHES, dtype=np.uint64)


def shingles(texts: pa.Array, n: int) -> Iterator[np.ndarray]:
    """Of each text the sorted distinct hashes of all runs of n words; a text of fewer words is one shingle, one without words has none."""
    found = find_words(texts)
    h, first = found.hashes(), found.first()
    return (text_shingles(h[lo:hi], n) for lo, hi in zip(first[:-1], first[1:], strict=True))


def text_shingles(h: np.ndarray, n: int) -> np.ndarray:
    if not len(h):
        return h
    n = min(n, len(h))
    out = np.zeros(len(h) - n + 1, dtype=np.uint64)
    for i in range(n):
        out = mix(out + h[i : len(h) - n + 1 + i])
    return np.unique(out)


def min_hashes(s: np.ndarray) -> np.ndarray:
    """The least of each hash function's values, folded to 16 bits: values that differ agree once in 65,536 times."""
    out = np.full(HASHES, np.iinfo(np.uint64).max, dtype=np.uint64)
    for lo in range(0, len(s), 1 << 15):
        part = s[lo : lo + (1 << 15)]
        for k in range(HASHES):
            out[k] = min(out[k], ((part ^ SHIFTS[k]) * MULTIPLIERS[k]).min())
    return (mix(out) >> np.uint64(48)).astype(np.uint16)


@lru_cache(maxsize=8)
def least_matches(threshold: float, tolerance: float) -> tuple[int, ...]:
    """For STEP, 2 STEP, ... compared values: the fewest matches at which a pair goes on.

    With a uniform prior the similarity given m matches of n has the density of Beta(m + 1, n - m + 1).
    """
    x = (np.arange(20_000) + 0.5) / 20_000
    out = []
    for n in range(STEP, HASHES + 1, STEP):
        for m in range(n + 1):
            log = lgamma(n + 2) - lgamma(m + 1) - lgamma(n - m + 1) + m * np.log(x) + (n - m) * np.log1p(-x)
            if np.exp(log)[x >= threshold].sum() / len(x) >= tolerance:
                out.append(m)
                break
    return tuple(out)


def survivors(values: np.ndarray, a: np.ndarray, b: np.ndarray, threshold: float, tolerance: float) -> np.ndarray:
    """Places of the pairs that incremental comparison does not drop."""
    alive, matches = np.arange(len(a)), np.zeros(len(a), dtype=np.int64)
    for k, least in enumerate(least_matches(threshold, tolerance)):
        part = slice(k * STEP, (k + 1) * STEP)
        matches = matches + (values[a[alive], part] == values[b[alive], part]).sum(axis=1)
        on = matches >= least
        alive, matches = alive[on], matches[on]
    return alive


def pairs_within(group: np.ndarray, chunk: np.ndarray, cross: np.ndarray, most: int = 200_000) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of rows of one group, in parts: rows are sorted by group; where a group is of two chunks only pairs across them."""
    n, at = len(group), np.arange(len(group))
    held_a, held_b, size, d = [], [], 0, 1
    while d < n:
        at = at[at + d < n]
        at = at[group[at] == group[at + d]]
        if not len(at):
            break
        fits = at[~cross[at] | (chunk[at] != chunk[at + d])]
        held_a.append(fits)
        held_b.append(fits + d)
        size += len(fits)
        if size > most:
            yield np.concatenate(held_a), np.concatenate(held_b)
            held_a, held_b, size = [], [], 0
        d += 1
    if size:
        yield np.concatenate(held_a), np.concatenate(held_b)


def forest(n: int, a: np.ndarray, b: np.ndarray, label: np.ndarray | None = None) -> np.ndarray:
    """For each of n rows the least row that the pairs connect it to."""
    label = np.arange(n) if label is None else label
    while True:
        low = np.minimum(label[a], label[b])
        new = label.copy()
        np.minimum.at(new, label[a], low)
        np.minimum.at(new, label[b], low)
        np.minimum.at(new, a, low)
        np.minimum.at(new, b, low)
        while (new[new] != new).any():
            new = new[new]
        if (new == label).all():
            return label
        label = new


def signatures(docs: DataFrame, n: int) -> DataFrame:
    """row long, doc_id, tie (a hash of the text), copy binary (a digest of the set; null without words), size, values binary, for each row."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            copy, size, values = [], [], []
            for s in shingles(b.column("text"), n):
                copy.append(digest(s) if len(s) else None)
                size.append(len(s))
                values.append(min_hashes(s).tobytes() if len(s) else None)
            yield pa.RecordBatch.from_arrays([*b.columns[:3], pa.array(copy, pa.binary()), pa.array(size, pa.int64()), pa.array(values, pa.binary())], names=["row", "doc_id", "tie", "copy", "size", "values"])

    named = docs.select(F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("tie"), "text")
    return named.mapInArrow(tidy(work), "row long, doc_id long, tie long, copy binary, size long, values binary")


def digest(s: np.ndarray) -> bytes:
    return xxhash.xxh3_128_digest(s.tobytes())


def chunked(rows: DataFrame, counts: DataFrame, key: str, chunks) -> DataFrame:
    """Rows of groups dealt into `chunks` chunks, once for each pair of chunks they belong to: key, cell (of the pair), chunk, cross."""
    m = chunks.cast("int")
    joined = rows.join(counts.withColumn("m", m), key).withColumn("chunk", F.pmod(F.hash("id", F.lit(3)), F.col("m")))
    spread = joined.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("m") - 1)))
    low, high = F.least("chunk", "other"), F.greatest("chunk", "other")
    return spread.withColumns({"cell": F.xxhash64(key, low, high), "cross": low != high}).drop("m", "other")


def candidate_forest(classes: DataFrame, threshold: float, tolerance: float) -> DataFrame:
    """Edges (a, b) that connect all classes whose pairs survive the comparison of their MinHash values."""

    def bands(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            v = np.frombuffer(b"".join(b.column("values").to_pylist()), np.uint16).reshape(-1, HASHES // BAND, BAND).astype(np.uint64)
            key = np.zeros(v.shape[:2], dtype=np.uint64) + np.arange(HASHES // BAND, dtype=np.uint64) * np.uint64(0x632BE59BD9B4E019)
            for k in range(BAND):
                key = mix(key + v[:, :, k])
            yield pa.RecordBatch.from_arrays([pa.array(key.ravel().view(np.int64)), pa.array(np.repeat(b.column("id").to_numpy(), HASHES // BAND))], names=["band", "id"])

    keyed = classes.select("id", "values").mapInArrow(tidy(bands), "band long, id long")
    counts = keyed.groupBy("band").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    members = chunked(keyed, counts, "band", F.ceil(F.col("n") / CHUNK)).join(classes.select("id", "values"), "id")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in sorted_groups(batches, "cell"):
            ids, cell, chunk, cross = (t.column(c).to_numpy() for c in ("id", "cell", "chunk", "cross"))
            values = np.frombuffer(b"".join(t.column("values").to_pylist()), np.uint16).reshape(-1, HASHES)
            label = np.arange(len(ids))
            for a, b in pairs_within(cell, chunk, cross):
                on = survivors(values, a, b, threshold, tolerance)
                label = forest(len(ids), a[on], b[on], label)
            tied = np.flatnonzero(label != np.arange(len(ids)))
            yield pa.RecordBatch.from_arrays([pa.array(ids[tied]), pa.array(ids[label[tied]])], names=["a", "b"])

    dealt = members.select("cell", "id", "chunk", "cross", "values").repartition("cell").sortWithinPartitions("cell")
    return dealt.mapInArrow(tidy(compare), "a long, b long").distinct()


def overlaps(sets: list[np.ndarray], left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Sizes of the intersections of all sets in `left` with all in `right`."""
    sizes = np.array([len(s) for s in sets])
    flat = np.concatenate(sets) if sets else np.zeros(0, np.uint64)
    owner = np.repeat(np.arange(len(sets)), sizes)
    _, col, df = np.unique(flat, return_inverse=True, return_counts=True)
    shared = df[col] > 1
    owner, (used, col) = owner[shared], np.unique(col[shared], return_inverse=True)
    order = np.argsort(col, kind="stable")
    owner, col = owner[order], col[order]
    out = np.zeros((len(left), len(right)), dtype=np.float32)
    wide = 4096
    for lo in range(0, len(used), wide):
        part = slice(*np.searchsorted(col, [lo, lo + wide]))
        m = np.zeros((len(sets), min(wide, len(used) - lo)), dtype=np.float32)
        m[owner[part], col[part] - lo] = 1
        out += m[left] @ m[right].T
    return out


def sets_of(docs: DataFrame, near: DataFrame, n: int) -> DataFrame:
    """The classes of `near` with their sets: id, group, copies, values, set binary."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            s = list(shingles(b.column("text"), n))
            # a doc_id may stand for several texts: only the class's own counts
            own = pa.array([digest(x) == c for x, c in zip(s, b.column("copy").to_pylist(), strict=True)], pa.bool_())
            columns = [*(b.column(c) for c in ("id", "group", "copies", "values")), pa.array([x.tobytes() for x in s], pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=["id", "group", "copies", "values", "set"]).filter(own)

    texts = docs.select(F.col("doc_id").cast("long").alias("of"), "text").join(near.withColumnRenamed("doc_id", "of"), "of")
    found = texts.select("id", "group", "copies", "values", "copy", "text").mapInArrow(tidy(work), "id long, group long, copies long, values binary, set binary")
    return found.dropDuplicates(["id"])


def verified(held: DataFrame, groups: DataFrame, threshold: float) -> DataFrame:
    """a, b, docs: for each class with links in a pair of chunks how many documents it is linked to there, and an edge of a forest of the links."""
    cells = chunked(held, groups, "group", F.ceil(F.greatest(F.col("n") / COMPONENT_CHUNK, F.col("shingles") / SHINGLES)))

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in sorted_groups(batches, "cell"):
            out: list[list[np.ndarray]] = [[], [], []]
            edges = runs(whole.column("cell").to_numpy())
            for lo, hi in zip(edges[:-1], edges[1:], strict=True):
                t = whole.slice(lo, hi - lo)
                ids, chunk, copies = (t.column(c).to_numpy() for c in ("id", "chunk", "copies"))
                found = [np.frombuffer(x, np.uint64) for x in t.column("set").to_pylist()]
                cross = t.column("cross")[0].as_py()
                left, right = (np.flatnonzero(chunk == chunk.min()), np.flatnonzero(chunk != chunk.min())) if cross else (np.arange(len(ids)),) * 2
                if not len(left) or not len(right):
                    continue
                both = overlaps(found, left, right)
                size = np.array([len(x) for x in found])
                alike = both >= threshold * (size[left][:, None] + size[right][None, :] - both) - 1e-6
                if not cross:
                    np.fill_diagonal(alike, False)
                i, j = np.nonzero(alike)
                a, b = left[i], right[j]
                label = forest(len(ids), a, b)
                docs = np.bincount(a, copies[b], len(ids))
                if cross:
                    docs = docs + np.bincount(b, copies[a], len(ids))
                some = np.flatnonzero(docs)
                for to, x in zip(out, (ids[some], ids[label[some]], docs[some].astype(np.int64)), strict=True):
                    to.append(x)
            if out[0]:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in out], names=["a", "b", "docs"])

    dealt = cells.select("cell", "id", "chunk", "cross", "copies", "set").repartition("cell").sortWithinPartitions("cell")
    return dealt.mapInArrow(tidy(verify), "a long, b long, docs long")


def classified(docs: DataFrame, n: int, threshold: float, tolerance: float) -> DataFrame:
    """doc_id, tie, root (of the class), copy_id, class_id, n_links for every row that has a doc_id; root is null for texts without words."""
    small_batches(docs.sparkSession)
    rows = cut(signatures(docs.filter("doc_id is not null"), n))
    worded = rows.filter("copy is not null")
    classes = cut(worded.groupBy("copy").agg(F.min("row").alias("id"), F.min_by("doc_id", "row").alias("doc_id"), F.min("doc_id").alias("least"), F.count(F.lit(1)).alias("copies"), F.first("size").alias("size"), F.first("values").alias("values")))
    groups = components(candidate_forest(classes, threshold, tolerance))
    roots = groups.select(F.col("root").alias("id"), F.col("root").alias("group")).distinct()
    near = cut(groups.select("id", F.col("root").alias("group")).union(roots).join(classes, "id"))
    sizes = near.groupBy("group").agg(F.count(F.lit(1)).alias("n"), F.sum("size").alias("shingles"))
    links = cut(verified(sets_of(docs, near.select("id", "group", "copies", "values", "copy", "doc_id"), n), sizes, threshold))
    counted = links.groupBy(F.col("a").alias("id")).agg(F.sum("docs").alias("docs"))
    one = classes.select("copy", "id", "copies", "least").join(components(links.select("a", "b")), "id", "left").join(counted, "id", "left").withColumn("root", F.coalesce("root", "id"))
    leasts = one.groupBy("root").agg(F.min("least").alias("class_id"))
    final = one.join(leasts, "root").select("copy", "root", F.col("least").alias("copy_id"), "class_id", (F.coalesce("docs", F.lit(0)) + F.col("copies") - 1).alias("n_links"))
    with_words = worded.select("doc_id", "tie", "copy").join(final, "copy").select("doc_id", "tie", "root", "copy_id", "class_id", "n_links")
    same, none = F.col("doc_id"), F.lit(None).cast("long")
    alone = rows.filter("copy is null").select("doc_id", "tie", none.alias("root"), same.alias("copy_id"), same.alias("class_id"), F.lit(0).cast("long").alias("n_links"))
    return with_words.union(alone)


def join(docs: DataFrame, n: int = 5, threshold: float = 0.8, tolerance: float = TOLERANCE) -> DataFrame:
    """doc_id, copy_id, class_id, n_links, for every row of `docs` (its doc_id and text).

    copy_id: the least doc_id with the same set of shingles; class_id: the least doc_id that links lead to, step by
    step; n_links: how many other rows have a similarity of `threshold` or more to this one, copies included. A text of fewer
    than n words is one shingle of all its words; null, empty and blank texts have none, are alone and have no
    links. Repeated rows are copies of each other. Rows with a null doc_id take no part and come back with nulls.
    Other columns are ignored; an empty table gives no rows.
    """
    none = F.lit(None).cast("long")
    names = ["doc_id", "copy_id", "class_id", "n_links"]
    return classified(docs.select("doc_id", "text"), n, threshold, tolerance).select(*names).union(docs.filter("doc_id is null").select(*(none.alias(c) for c in names)))


def keep_one(docs: DataFrame, n: int = 5, threshold: float = 0.8) -> DataFrame:
    """`docs` with one document of each class: a row whose doc_id names the class, the least by a hash of its text.

    Of repeated rows one stays. Texts without words and rows with a null doc_id all stay. Columns stay as they are,
    whatever their names.
    """
    found = classified(docs.select("doc_id", "text"), n, threshold, TOLERANCE)
    id_, tie = fresh(docs, "id", "tie")
    first = found.filter("root is not null").groupBy("root").agg(F.min(F.struct("doc_id", "tie")).alias("first"))
    named = first.select(F.col("first.doc_id").alias(id_), F.col("first.tie").alias(tie)).distinct()
    mine = docs.withColumns({id_: F.col("doc_id").cast("long"), tie: F.xxhash64("text")})
    kept = mine.join(named, [id_, tie], "left_semi").dropDuplicates([id_, tie])
    blank = docs.filter(F.col("doc_id").isNull() | ~F.coalesce(F.col("text").rlike(SPACE.replace("[", "[^", 1)), F.lit(False)))
    return kept.select(*quoted(docs.columns)).union(blank.select(*quoted(docs.columns)))
