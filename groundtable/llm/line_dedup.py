"""Removal of lines that are alike: an exact set-similarity join on the lines' words.

A line is the set of its words. Words are ordered by rarity, from a table of counts by word hash that covers
the whole corpus and has a fixed size. Two lines of a Jaccard similarity of t share a word among the
first k - ceil(t k) + 1 of their k words, so lines meet in groups by these words only; of a pair that meets,
lengths and the places of the shared word bound the overlap, and so does the number of bits in which
signatures of the two sets differ. What passes is verified on the sets. A line goes if an earlier line, by
doc_id and line number, is alike.

Groups are cut in chunks (their sizes are bounded by the table of counts) and pairs of chunks are compared in
one task. Pairs are not rows: for each line at most BEST candidates leave a group. Lines whose
candidates all fail though they had more are compared again, with all their candidates.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType

from groundtable.llm.byte_words import Words, find_words
from groundtable.llm.common import fresh, mix, quoted, runs, small_batches, sorted_groups, tidy
from groundtable.llm.ngram_join import pairs_within
from groundtable.session import cut, release, stored

#: Slots of the tables by hash, and how many of them one row of a partial table has.
SLOTS, SLICE = 1 << 22, 1 << 14
#: Lines of a group in a chunk; candidates of a line that leave a pair of chunks.
CHUNK, BEST = 8192, 4
#: The same for a line whose nearest candidate is hardly near enough; lines with more words than LONG have longer signatures.
MANY, LONG = 128, 64
#: Words that are sorted at once, a power of 2; pairs of lines that are held at once.
WORDS_AT_ONCE, PAIRS = 1 << 18, 1 << 18
NEVER = np.iinfo(np.int64).max
#: Counts in a byte: exact below 16, then eight steps for each doubling.
EXACT, STEPS = 16, 8


def slot(h: np.ndarray) -> np.ndarray:
    """Slots of 64-bit hashes: their upper bits, so words of one slot stay together in what is sorted by hash."""
    return (h >> np.uint64(42)).astype(np.int64)


def in_a_byte(counts: np.ndarray) -> np.ndarray:
    """Counts on a scale that keeps their order."""
    large = EXACT + np.floor(STEPS * np.log2(np.maximum(counts, EXACT) / EXACT))
    return np.where(counts < EXACT, counts, np.minimum(large, 255)).astype(np.uint8)


#: The greatest count that each byte may stand for.
AT_MOST = np.where(np.arange(256) < EXACT, np.arange(256), np.floor(EXACT * 2.0 ** ((np.arange(256) - EXACT + 1) / STEPS))).astype(np.int64)


def partial_table(counts: np.ndarray) -> pa.RecordBatch:
    """A task's counts as rows of (slice, places, counts), without the slots it has not seen."""
    at = np.flatnonzero(counts)
    edges = runs(at // SLICE)
    parts = list(zip(edges[:-1], edges[1:], strict=True)) if len(at) else []
    return pa.RecordBatch.from_arrays(
        [
            pa.array([int(at[lo] // SLICE) for lo, _ in parts], pa.int64()),
            pa.array([(at[lo:hi] % SLICE).astype(np.uint16).tobytes() for lo, hi in parts], pa.binary()),
            pa.array([counts[at[lo:hi]].astype(np.uint32).tobytes() for lo, hi in parts], pa.binary()),
        ],
        names=["slice", "places", "counts"],
    )


PARTIAL = "slice long, places binary, counts binary"


def whole_table(partial: DataFrame) -> np.ndarray:
    """Partial tables added up slice by slice, as bytes; one row of bounded size for each slice reaches the driver, SLOTS bytes together."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, np.ndarray] = {}
        for b in batches:
            for i, places, counts in zip(b.column("slice").to_pylist(), b.column("places"), b.column("counts"), strict=True):
                part = held.setdefault(i, np.zeros(SLICE, dtype=np.int64))
                part[np.frombuffer(places.as_buffer(), np.uint16)] += np.frombuffer(counts.as_buffer(), np.uint32)
        yield pa.RecordBatch.from_arrays([pa.array(held.keys(), pa.int64()), pa.array([in_a_byte(x).tobytes() for x in held.values()], pa.binary())], names=["slice", "counts"])

    out = np.zeros((SLOTS // SLICE, SLICE), dtype=np.uint8)
    for r in partial.repartition("slice").mapInArrow(tidy(add), "slice long, counts binary").collect():
        out[r["slice"]] = np.frombuffer(r["counts"], np.uint8)
    return out.ravel()


def marked(rows: DataFrame, column: str) -> np.ndarray:
    """Which slots the scrambled 64-bit values of a column fall into."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(SLOTS, dtype=np.uint8)
        for b in batches:
            counts[slot_of(b.column(column).to_numpy())] = 1
        yield partial_table(counts)

    return whole_table(rows.select(column).mapInArrow(tidy(work), PARTIAL)) > 0


def slot_of(values: np.ndarray) -> np.ndarray:
    return slot(mix(mix(values.view(np.uint64))))


@dataclass
class Lines:
    """Lines of some texts as sets: which text, line number, set digest in two parts, where each line's words start, and the distinct word hashes line by line."""

    text: np.ndarray
    line: np.ndarray
    id: np.ndarray
    more: np.ndarray
    start: np.ndarray
    words: np.ndarray


def line_sets(found: Words, least: int, counts: np.ndarray | None = None) -> Iterator[Lines]:
    """All lines of at least `least` distinct words, a bounded number of words at a time; words by rarity, if counts are given, then hash."""
    text, line, first = found.lines()
    at, n = 0, len(text)
    while at < n:
        # as many lines as fit, and one at least
        to = max(at + 1, int(np.searchsorted(first, first[at] + WORDS_AT_ONCE, "right")) - 1)
        on = at + np.flatnonzero(first[at + 1 : to + 1] - first[at:to] >= max(1, least))
        if len(on):
            lo, hi = int(first[on[0]]), int(first[on[-1] + 1])
            h, sizes = found.hashes(lo, hi), first[on + 1] - first[on]
            owner = np.repeat(np.arange(len(on)), sizes)
            if len(h) > len(owner):  # shorter lines in between
                h = h[np.arange(len(owner)) + (first[on] - lo - np.cumsum(sizes) + sizes)[owner]]
            yield _line_sets(text[on], line[on], h, owner, least, counts)
        at = to


def in_order(h: np.ndarray, owner: np.ndarray, rarity: np.ndarray | int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes and owners (ascending already) by owner, rarity and hash."""
    n = len(h)
    if n > WORDS_AT_ONCE:
        order = np.lexsort((h, rarity + np.zeros(n, np.uint8), owner))
        return h[order], owner[order]
    # one sort of one number a word: owner, rarity, the hash's upper bits, and where it was
    bits = np.uint64(WORDS_AT_ONCE.bit_length() - 1)
    key = np.sort(((owner.astype(np.uint64) << np.uint64(8) | np.uint64(0) + rarity) << np.uint64(20) | h >> np.uint64(44)) << bits | np.arange(n, dtype=np.uint64))
    order = (key & np.uint64(WORDS_AT_ONCE - 1)).astype(np.int64)
    key >>= bits
    h, owner = h[order], owner[order]
    tied = np.flatnonzero(key[1:] == key[:-1])
    while len(wrong := tied[h[tied] > h[tied + 1]]):
        wrong = wrong[np.diff(wrong, prepend=-2) > 1]
        h[wrong], h[wrong + 1] = h[wrong + 1], h[wrong]
    return h, owner


def _line_sets(text: np.ndarray, line: np.ndarray, h: np.ndarray, owner: np.ndarray, least: int, counts: np.ndarray | None) -> Lines:
    h, owner = in_order(h, owner, 0 if counts is None else counts[slot(h)])
    once = np.ones(len(h), dtype=bool)
    once[1:] = (h[1:] != h[:-1]) | (owner[1:] != owner[:-1])
    h, owner = h[once], owner[once]
    k = np.bincount(owner, minlength=len(text))
    on = k >= least
    if not on.all():
        h, k, text, line = h[on[owner]], k[on], text[on], line[on]
    start = np.concatenate(([0], np.cumsum(k)))
    if not len(k):
        return Lines(text, line, np.zeros(0, np.int64), np.zeros(0, np.int64), start, h)
    a = mix(mix(h))
    ids, more = mix(np.add.reduceat(a, start[:-1])), mix(np.add.reduceat(mix(a ^ np.uint64(0xA5A5_5A5A_0F0F_F0F0)), start[:-1]))
    return Lines(text, line, ids.view(np.int64), more.view(np.int64), start, h)


SURVEYED = "id long, more long, doc long, line long, row long, tie long, doc_id long, " + PARTIAL


def meets_others(k: np.ndarray, threshold: float) -> np.ndarray:
    """Whether sets of k words can be alike to a set that is not equal: the nearest has one word more."""
    return k >= threshold * (k + 1) - 1e-9


def surveyed(docs: DataFrame, least: int, threshold: float) -> DataFrame:
    """One pass over all texts. Rows of three kinds, the other kinds' columns null: each line that takes part (id and more, doc, line, row, tie), each
    text (doc_id, row, and its number of lines as line), and the tasks' counts of words by slot, over the lines that may be alike to one of another set."""
    names = ["id", "more", "doc", "line", "row", "tie", "doc_id", "slice", "places", "counts"]
    kinds = [pa.int64()] * 8 + [pa.binary()] * 2

    def batch(**columns) -> pa.RecordBatch:
        n = len(next(iter(columns.values())))
        return pa.RecordBatch.from_arrays([pa.array(columns[c], t) if c in columns else pa.nulls(n, t) for c, t in zip(names, kinds, strict=True)], names=names)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(SLOTS, dtype=np.uint32)
        for b in batches:
            found = find_words(b.column("text"))
            text, _, _ = found.lines()
            n_lines = np.where(np.diff(found.offsets) > 0, np.bincount(text, minlength=b.num_rows), 0)
            doc, row, tie = (b.column(c).to_numpy() for c in ("doc", "row", "tie"))
            yield batch(doc_id=b.column("doc_id"), row=row, line=n_lines)
            for x in line_sets(found, least):
                k = np.diff(x.start)
                np.add.at(counts, slot(x.words[np.repeat(meets_others(k, threshold), k)]), 1)
                yield batch(id=x.id, more=x.more, doc=doc[x.text], line=x.line, row=row[x.text], tie=tie[x.text])
        p = partial_table(counts)
        yield batch(**{c: p.column(c) for c in ("slice", "places", "counts")})

    return docs.select("row", "doc_id", "doc", F.xxhash64("text").alias("tie"), "text").mapInArrow(tidy(work), SURVEYED)


#: Columns of a posting, a row of WIDTH bytes: what is sorted by, the line, the set's signature, then small numbers.
COLUMNS = {"cell": "<u4", "doc": "<i8", "id": "<i8", "low": "<i8", "high": "<i8", "line": "<u4", "k": "<u4", "place": "<u4", "chunk": "<u4"}
WIDTH = sum(np.dtype(kind).itemsize for kind in COLUMNS.values())
#: Postings that a task gathers before it passes them on; postings of a bucket, about; buckets for each partition, at least.
GATHERED, BUCKET, BUCKETS = 1 << 19, 1 << 15, 8


def rows_of_bytes(columns: dict[str, np.ndarray]) -> np.ndarray:
    """Postings as rows of WIDTH bytes."""
    parts = [np.ascontiguousarray(columns[c]).astype(kind) for c, kind in COLUMNS.items()]
    return np.concatenate([v.view(np.uint8).reshape(len(v), v.itemsize) for v in parts], axis=1)


def long_ones(rows: np.ndarray) -> np.ndarray:
    """Which postings, as rows of bytes, are of long lines."""
    at = sum(np.dtype(kind).itemsize for kind in list(COLUMNS.values())[: list(COLUMNS).index("k")])
    return np.ascontiguousarray(rows[:, at : at + 4]).view("<u4")[:, 0] > LONG


def columns_of_bytes(planes: np.ndarray) -> dict[str, np.ndarray]:
    """The columns of postings, from rows of bytes turned about: row i of `planes` holds byte i of each."""
    found, at = {}, 0
    for c, kind in COLUMNS.items():
        size = np.dtype(kind).itemsize
        values = np.ascontiguousarray(planes[at : at + size].T).view(kind)[:, 0]
        found[c], at = values if c == "cell" else values.astype(np.int64), at + size
    return found


def bucket_bits(counts: np.ndarray, threshold: float, partitions: int) -> int:
    """Upper bits of a cell that make its bucket: enough for buckets of about BUCKET postings, by the corpus's words, and for all partitions."""
    of_prefixes = int(AT_MOST[counts[counts > 1]].sum()) * (1 - threshold)
    return min(24, int(np.ceil(np.log2(max(of_prefixes / BUCKET, BUCKETS * partitions)))))


def in_buckets(held: list[tuple[np.ndarray, np.ndarray]], bits: int) -> pa.RecordBatch:
    """Postings, and further bits of signature of the long ones, as rows of (bucket, postings, wide), ordered by cell. Of a bucket's postings all first bytes
    lie together, then all second ones: many are zero, which the shuffle's compression makes use of."""
    rows, wide = (np.concatenate(parts) for parts in zip(*held, strict=True))
    cell, long = np.ascontiguousarray(rows[:, :4]).view("<u4")[:, 0], long_ones(rows)
    order = np.argsort(cell)
    wide = wide[(np.cumsum(long) - 1)[order][long[order]]]
    rows, bucket, long = rows[order], (cell[order] >> np.uint32(32 - bits)).astype(np.int32), long[order]
    edges = runs(bucket)
    upto = np.concatenate(([0], np.cumsum(long)))[edges]
    return pa.RecordBatch.from_arrays(
        [
            pa.array(bucket[edges[:-1]] if len(bucket) else bucket),
            pa.array([rows[lo:hi].T.tobytes() for lo, hi in zip(edges[:-1], edges[1:], strict=True)], pa.binary()),
            pa.array([wide[lo:hi].tobytes() for lo, hi in zip(upto[:-1], upto[1:], strict=True)], pa.binary()),
        ],
        names=["bucket", "postings", "wide"],
    )


def out_of_buckets(t: pa.Table) -> tuple[dict[str, np.ndarray], np.ndarray]:
    """The postings of rows of in_buckets(), and two numbers of further bits for each, zero where there are none."""
    planes = [np.frombuffer(v.as_buffer(), np.uint8).reshape(WIDTH, -1) for v in t.column("postings")]
    c = columns_of_bytes(np.concatenate(planes, axis=1))
    more = np.zeros((len(c["cell"]), 2), dtype=np.uint64)
    more[c["k"] > LONG] = np.frombuffer(b"".join(t.column("wide").to_pylist()), np.uint64).reshape(-1, 2)
    return c, more


def posted(batches: Iterator[pa.RecordBatch], least: int, threshold: float, counts: np.ndarray, some_docs: np.ndarray | None) -> Iterator[tuple[dict[str, np.ndarray], np.ndarray]]:
    """Columns of the postings of batches of (doc, text), and for each of a long line two numbers, further bits of its signature. `some_docs`, a table of
    slots, leaves out all other texts."""
    for b in batches:
        if some_docs is not None:
            b = b.filter(pa.array(some_docs[slot_of(b.column("doc").to_numpy())], pa.bool_()))
        doc = b.column("doc").to_numpy()
        for x in line_sets(find_words(b.column("text")), least, counts):
            if len(x.id):
                yield _postings(x, doc[x.text], counts, threshold)


def postings(docs: DataFrame, least: int, threshold: float, shipped, cells=None) -> DataFrame:
    """A posting for each line, word of its prefix and pair of chunks (its chunk is given twice, plus 1 for two chunks), many in a row: bucket, postings, wide.
    `cells`, a broadcast table of slots, leaves out all other cells."""
    partitions = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    bits = bucket_bits(shipped.value, threshold, partitions)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for c, wide in posted(batches, least, threshold, shipped.value, None):
            rows = rows_of_bytes(c)
            if cells is not None:
                on = cells.value[slot_of(c["cell"].astype(np.int64))]
                rows, wide = rows[on], wide[on[long_ones(rows)]]
            held.append((rows, wide))
            size += len(rows)
            if size >= GATHERED:
                yield in_buckets(held, bits)
                held, size = [], 0
        if size:
            yield in_buckets(held, bits)

    return docs.select("doc", "text").mapInArrow(tidy(work), "bucket int, postings binary, wide binary")


def cells_of(docs: DataFrame, least: int, threshold: float, shipped, ids, some_docs) -> DataFrame:
    """cell (long): the cells of the lines whose ids' slots are set in `ids`, from the texts whose slots are set in `some_docs`, both broadcast."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for c, _ in posted(batches, least, threshold, shipped.value, some_docs.value):
            yield pa.RecordBatch.from_arrays([pa.array(np.unique(c["cell"][ids.value[slot_of(c["id"])]]).astype(np.int64))], names=["cell"])

    return docs.select("doc", "text").mapInArrow(tidy(work), "cell long").distinct()


def _postings(x: Lines, doc: np.ndarray, counts: np.ndarray, threshold: float) -> tuple[dict[str, np.ndarray], np.ndarray]:
    k = np.diff(x.start)
    bit = mix(x.words)
    one = np.uint64(1) << (bit & np.uint64(63))
    upper = (bit >> np.uint64(6) & np.uint64(1)).astype(bool)
    low, high = (np.bitwise_xor.reduceat(np.where(side, one, np.uint64(0)), x.start[:-1]) for side in (~upper, upper))
    second = (bit >> np.uint64(7) & np.uint64(1)).astype(bool)
    wide = np.stack([np.bitwise_xor.reduceat(np.where(side & second, one, np.uint64(0)), x.start[:-1]) for side in (~upper, upper)], axis=1)
    # of lines with one set the earliest stands for all here
    order = np.lexsort((x.line, doc, x.id))
    alone = np.ones(len(order), dtype=bool)
    alone[1:] = x.id[order][1:] != x.id[order][:-1]
    stands = np.zeros(len(order), dtype=bool)
    stands[order[alone]] = True
    owner = np.repeat(np.arange(len(k)), k)
    place = np.arange(len(owner)) - x.start[owner]
    n = AT_MOST[counts[slot(x.words)]]
    # a word that was counted once stands in no other line; sets that only equal ones are alike to are found by id
    prefix = (stands & meets_others(k, threshold))[owner] & (place < k[owner] - np.ceil(threshold * k[owner] - 1e-9) + 1) & (n > 1)
    owner, h, n, place = owner[prefix], x.words[prefix], n[prefix], place[prefix]
    chunks = -(-n // CHUNK)
    mine = (mix(x.id[owner].view(np.uint64)) % chunks.astype(np.uint64)).astype(np.int64)
    if len(chunks) and chunks.max() > 1:
        at = np.repeat(np.arange(len(owner)), chunks)
        other = np.arange(len(at)) - np.repeat(np.cumsum(chunks) - chunks, chunks)
        owner, h, place, mine = owner[at], h[at], place[at], mine[at]
    else:
        other = mine
    a, b = np.minimum(mine, other), np.maximum(mine, other)
    cell = (mix(mix(h + a.astype(np.uint64)) + b.astype(np.uint64)) >> np.uint64(32)).astype(np.uint32)
    columns = {"cell": cell, "doc": doc[owner], "id": x.id[owner], "low": low[owner].view(np.int64), "high": high[owner].view(np.int64)}
    return columns | {"line": x.line[owner], "k": k[owner], "place": place, "chunk": mine * 2 + (a != b)}, wide[owner[k[owner] > LONG]]


class Nearest:
    """The pairs (x, y) of a table of lines, of each x the nearest only: BEST, or MANY if none of them is close. `cut` marks the x that had more."""

    def __init__(self, lines: int):
        self.cut, self.held, self.size = np.zeros(lines, dtype=bool), [], 0

    def add(self, x: np.ndarray, y: np.ndarray, apart: np.ndarray, close: np.ndarray) -> None:
        self.held.append((x, y, apart, close))
        self.size += len(x)
        if self.size > PAIRS:
            self.trim()
            self.size = 0

    def trim(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """x, y, apart of what is kept."""
        if not self.held:
            return (np.zeros(0, np.int64),) * 3
        x, y, apart, close = map(np.concatenate, zip(*self.held, strict=True))
        order = np.lexsort((y, apart, x))
        x, y, apart, close = x[order], y[order], apart[order], close[order]
        edges = runs(x)
        sizes = np.diff(edges)
        rank = np.arange(len(x)) - np.repeat(edges[:-1], sizes)
        most = np.where(np.logical_or.reduceat(close, edges[:-1]), BEST, MANY) if len(x) else np.zeros(0, np.int64)
        on = rank < np.repeat(most, sizes)
        self.cut[x[~on]] = True
        self.held = [(x[on], y[on], apart[on], close[on])]
        return self.held[0][:3]


def by_cell(c: dict[str, np.ndarray]) -> np.ndarray:
    """Where postings stand, ordered by cell and id; of those that are alike in cell, id, place and chunk the earliest line's only."""
    key = c["cell"].astype(np.uint64) << np.uint64(32) | c["id"].view(np.uint64) >> np.uint64(32)
    order = np.argsort(key)
    key = key[order]
    tied = np.zeros(len(order), dtype=bool)
    tied[1:] = key[1:] == key[:-1]
    tied[:-1] |= tied[1:]
    on = np.flatnonzero(tied)
    # few have equals; only these are put in order by all columns
    some = order[on]
    some = some[np.lexsort(tuple(c[name][some] for name in ("line", "doc", "chunk", "place", "id")) + (key[on],))]
    order[on] = some
    again = np.zeros(len(on), dtype=bool)
    again[1:] = np.all([c[name][some][1:] == c[name][some][:-1] for name in ("cell", "id", "place", "chunk")], axis=0)
    keep = np.ones(len(order), dtype=bool)
    keep[on[again]] = False
    return order[keep]


def candidates(cells: DataFrame, threshold: float, every=None) -> DataFrame:
    """x, x_doc, y, y_doc, apart, more: earlier lines y that may be alike to x.

    The BEST nearest by signature for each x and cell (MANY, if even the nearest is hardly near enough) and whether there were more; with `every` (a broadcast
    table of slots of ids) all of them for the x whose slots are set, and none for others. A cell is a hash: two words that share one only add comparisons.
    """
    share = threshold / (1 + threshold)

    def named(c: dict, x: np.ndarray, y: np.ndarray, apart: np.ndarray, more: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(v) for v in (c["id"][x], c["doc"][x], c["id"][y], c["doc"][y], apart, more)], names=["x", "x_doc", "y", "y_doc", "apart", "more"])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        few = (b.slice(at, 16) for b in batches for at in range(0, b.num_rows, 16))
        for t in sorted_groups(few, "bucket", 1 << 20):
            c, more_bits = out_of_buckets(t)
            order = by_cell(c)
            c, more_bits = {name: v[order] for name, v in c.items()}, more_bits[order]
            c["long"] = c["k"] > LONG
            k, place = c["k"], c["place"]
            low, high = c["low"].view(np.uint64), c["high"].view(np.uint64)
            wanted = None if every is None else every.value[slot_of(c["id"])]
            found = Nearest(len(k))
            for a, b in pairs_within(c["cell"], c["chunk"] >> 1, (c["chunk"] & 1).astype(bool)):
                both = k[a] + k[b]
                least = np.ceil(share * both - 1e-9).astype(np.int64)
                on = np.flatnonzero((np.minimum(k[a] - place[a], k[b] - place[b]) >= least) & (c["id"][a] != c["id"][b]))
                a, b, both, least = a[on], b[on], both[on], least[on]
                apart = np.bitwise_count(low[a] ^ low[b]).astype(np.int64) + np.bitwise_count(high[a] ^ high[b])
                on = np.flatnonzero(apart <= both - 2 * least)
                a, b, apart, most = a[on], b[on], apart[on], (both - 2 * least)[on]
                long = np.flatnonzero(c["long"][a] & c["long"][b])
                differ, bits = more_bits[a[long]] ^ more_bits[b[long]], np.stack([low[a[long]] ^ low[b[long]], high[a[long]] ^ high[b[long]]], axis=1)
                apart[long] = (np.bitwise_count(differ).astype(np.int64) + np.bitwise_count(differ ^ bits)).sum(axis=1)
                on = np.flatnonzero(apart <= most)
                a, b, apart, most = a[on], b[on], apart[on], most[on]
                later = (c["doc"][a] > c["doc"][b]) | ((c["doc"][a] == c["doc"][b]) & ((c["line"][a] > c["line"][b]) | ((c["line"][a] == c["line"][b]) & (c["id"][a] > c["id"][b]))))
                x, y = np.where(later, a, b), np.where(later, b, a)
                if wanted is None:
                    # signatures that differ in more bits than that tell little: two sets of any kind differ in half of them
                    found.add(x, y, apart, 2 * apart <= np.minimum(most, 64))
                elif len(on := np.flatnonzero(wanted[x])):
                    yield named(c, x[on], y[on], apart[on], np.zeros(len(on), dtype=bool))
            x, y, apart = found.trim()
            if len(x):
                yield named(c, x, y, apart, found.cut[x])

    return cells.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(tidy(work), "x long, x_doc long, y long, y_doc long, apart long, more boolean")


def enough_in_common(p: list[np.ndarray], q: list[np.ndarray], threshold: float) -> np.ndarray:
    """For each pair of sets, whether their Jaccard similarity is at least the threshold."""
    of_p, of_q = (np.array([len(s) for s in sets], dtype=np.int64) for sets in (p, q))
    owner = np.concatenate((np.repeat(np.arange(len(p)), of_p), np.repeat(np.arange(len(q)), of_q)))
    h = np.concatenate([*p, *q]) if len(p) else np.zeros(0, np.uint64)
    order = np.lexsort((h, owner))
    h, owner = h[order], owner[order]
    both = np.bincount(owner[1:][(h[1:] == h[:-1]) & (owner[1:] == owner[:-1])], minlength=len(p))
    return both >= threshold * (of_p + of_q - both) - 1e-9


def verify(docs: DataFrame, pairs: DataFrame, least: int, threshold: float) -> DataFrame:
    """x, x_more: the lines of `pairs` (x, x_doc, y, y_doc) that are alike to one of their candidates, judged on the sets."""
    spark = docs.sparkSession
    sides = pairs.select(F.col("x").alias("id"), F.col("x_doc").alias("doc")).union(pairs.select("y", "y_doc"))
    # tables of fixed size tell which texts and lines may be asked for; the joins below are exact
    some_docs, some_ids = (spark.sparkContext.broadcast(marked(sides, c)) for c in ("doc", "id"))

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            b = b.filter(pa.array(some_docs.value[slot_of(b.column("doc").to_numpy())], pa.bool_()))
            for x in line_sets(find_words(b.column("text")), least):
                on = np.flatnonzero(some_ids.value[slot_of(x.id)])
                on = on[np.unique(x.id[on], return_index=True)[1]]
                held = pa.array([np.sort(x.words[x.start[i] : x.start[i + 1]]).tobytes() for i in on], pa.binary())
                yield pa.RecordBatch.from_arrays([pa.array(x.id[on]), pa.array(x.more[on]), held], names=["id", "more", "set"])

    found = docs.select("doc", "text").mapInArrow(tidy(sets), "id long, more long, set binary").dropDuplicates(["id", "more"])
    pairs = pairs.select("x", "y").distinct().join(found.select(F.col("id").alias("x"), F.col("more").alias("x_more"), F.col("set").alias("x_set")), "x")
    pairs = pairs.join(found.select(F.col("id").alias("y"), F.col("set").alias("y_set")), "y")

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for lo in range(0, whole.num_rows, 500):
                b = whole.slice(lo, 500)
                p, q = ([np.frombuffer(s.as_buffer(), np.uint64) for s in b.column(c)] for c in ("x_set", "y_set"))
                yield b.select(["x", "x_more"]).filter(pa.array(enough_in_common(p, q, threshold), pa.bool_()))

    return pairs.select("x", "x_more", "x_set", "y_set").mapInArrow(tidy(judge), "x long, x_more long").distinct()


def repeated_lines(docs: DataFrame, threshold: float = 0.8, least: int = 5) -> DataFrame:
    """row, doc_id, n_lines, removed array<int>: for each row of `docs` (row, doc_id, text) the numbers (from 0) of the lines that go.

    Lines of fewer than `least` distinct words take no part and stay. The first of equal sets stays unless an earlier
    line is alike; earlier is by doc_id (null last), then line number; of lines with the same of both, by hashes of the
    line's words and then of the text. An earlier line counts whether it stays or not.
    """
    spark = docs.sparkSession
    small_batches(spark)
    docs = docs.select("row", F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("doc_id").cast("long"), F.lit(NEVER)).alias("doc"), "text")
    survey = stored(surveyed(docs, least, threshold), "lines")
    table = spark.sparkContext.broadcast(whole_table(survey.filter("slice is not null").select("slice", "places", "counts")))
    release(spark)
    best = candidates(postings(docs, least, threshold, table), threshold)
    found = cut(best.groupBy("x", "y").agg(F.first("x_doc").alias("x_doc"), F.first("y_doc").alias("y_doc"), F.min("apart").alias("apart"), F.max("more").alias("more")))
    del best
    near = F.row_number().over(Window.partitionBy("x").orderBy("apart", "y"))
    release(spark)
    of_x = Window.partitionBy("x")
    kept = F.when(F.min("apart").over(of_x) <= BEST, F.lit(2 * BEST)).otherwise(F.lit(2 * MANY))
    ranked = found.withColumns({"rank": near, "kept": kept, "more": F.max("more").over(of_x) | (F.count(F.lit(1)).over(of_x) > kept)}).filter(F.col("rank") <= F.col("kept"))
    alike = cut(verify(docs, ranked, least, threshold))
    release(spark)
    open_ = cut(ranked.filter("more").select("x", "x_doc").distinct().join(alike, "x", "left_anti"))
    if not open_.isEmpty():
        # the cells of the lines that are still open, from their own texts; then all lines of these cells
        ids, of = (spark.sparkContext.broadcast(marked(open_, c)) for c in ("x", "x_doc"))
        cells = cells_of(docs, least, threshold, table, ids, of)
        some = spark.sparkContext.broadcast(marked(cells, "cell"))
        every = candidates(postings(docs, least, threshold, table, some), threshold, ids).join(open_.select("x"), "x", "left_semi")
        rest = cut(every.groupBy("x", "y").agg(F.first("x_doc").alias("x_doc"), F.first("y_doc").alias("y_doc")))
        alike = alike.union(verify(docs, rest, least, threshold))
    lines, of_set = survey.filter("id is not null").select("id", "more", "doc", "line", "row", "tie"), ["id", "more"]
    earliest = F.struct("doc", "line", "tie", "row")
    firsts = lines.groupBy(*of_set).agg(F.count(F.lit(1)).alias("n"), F.min(earliest).alias("first"))
    firsts = firsts.join(alike.select(F.col("x").alias("id"), F.col("x_more").alias("more"), F.lit(True).alias("goes")), of_set, "left")
    # written first, so that both sides of the next join are plain exchanges and a line that is everywhere can be split
    firsts = cut(firsts.filter("n > 1 or goes"))
    gone = lines.join(firsts, of_set).filter(F.col("goes").isNotNull() | (earliest != F.col("first")))
    by_row = gone.groupBy("row").agg(F.sort_array(F.collect_list(F.col("line").cast("int"))).alias("removed"))
    every = survey.filter("id is null and slice is null").select("row", "doc_id", F.col("line").cast("int").alias("n_lines"))
    return every.join(by_row, "row", "left").withColumn("removed", F.coalesce("removed", F.array().cast("array<int>")))


def report(docs: DataFrame, threshold: float = 0.8, least: int = 5) -> DataFrame:
    """doc_id, n_lines, n_removed, removed: what deduplicate() takes from each row. Null and empty texts have no lines."""
    rows = docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", "text")
    return repeated_lines(rows, threshold, least).select("doc_id", "n_lines", F.size("removed").alias("n_removed"), "removed")


def deduplicate(docs: DataFrame, threshold: float = 0.8, least: int = 5) -> DataFrame:
    """`docs` with the lines removed from text that an earlier line is alike to.

    All rows stay, also those that lose every line (their text is empty); null texts stay null. Repeated rows
    are texts like any other: the later one loses its lines. Other columns stay as they are, whatever their
    names; n_chars, if there, is the new text's length. An empty table gives no rows.
    """
    kept, spark = docs.columns, docs.sparkSession
    row, touched, held, gone = fresh(docs, "row", "touched", "held", "gone")
    # numbers of rows hold for one scan only: they are written with the rows, and all that follows reads them
    rows = stored(docs.withColumn(row, F.monotonically_increasing_id()), "texts")
    mine = rows.select(F.col(row).alias("row"), "doc_id", "text")
    removed = cut(repeated_lines(mine, threshold, least).filter(F.size("removed") > 0).select(F.col("row").alias(row), F.col("removed").alias(gone)))
    release(spark)
    # texts that no slot marks lose nothing and need not move
    some = spark.sparkContext.broadcast(marked(removed, row))

    @F.pandas_udf(BooleanType())
    def is_touched(row: pd.Series) -> pd.Series:
        return pd.Series(some.value[slot_of(row.to_numpy(dtype=np.int64))])

    rows = rows.withColumn(touched, is_touched(row))
    joined = rows.filter(F.col(touched)).join(removed, row, "left").withColumn(held, F.when(F.col(gone).isNotNull(), F.split("text", "\n")))
    stay = F.array_except(F.sequence(F.lit(0), F.size(held) - 1), gone)
    changed = F.col(gone).isNotNull()
    new = {"text": F.when(changed, F.array_join(F.transform(stay, lambda i: F.element_at(held, i + 1)), "\n")).otherwise(F.col("text"))}
    out = joined.withColumns(new)
    if "n_chars" in kept:
        out = out.withColumn("n_chars", F.when(changed, F.length("text").cast("long")).otherwise(F.col("n_chars")))
    return rows.filter(~F.col(touched)).select(*quoted(kept)).union(out.select(*quoted(kept)))
