"""What the corpus operators share: words, hashes, bounded caches, row-aligned Arrow output."""

from __future__ import annotations

import ctypes
import platform
import sys
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: What separates words, as a Java and Python character class.
SPACE = r"[\x20\x09-\x0D]"
#: Entries that a worker's cache holds before they become the old ones; distinct words that a task counts before it passes them on.
CACHE, FLUSH = 50_000, 150_000
#: Rows in a batch between Spark and Python: texts may be long.
BATCH_ROWS = 1_000


def words(text: str | None) -> list[bytes]:
    """The words `[^\\x20\\x09-\\x0D]+` in UTF-8; bytes.split() cuts at exactly these six characters."""
    return text.encode().split() if text else []


def bucket(key: Column, n: int) -> Column:
    """crc32 of a key written as text, modulo n: the folds of the contracts; null for a null key."""
    return F.crc32(key.cast("string").cast("binary")) % n


class Cache(dict):
    """A dict that computes what is missing, in bounded memory: when it is full its entries become the old ones, which still serve what is asked again."""

    def __init__(self, make: Callable, most: int = CACHE):
        self.make, self.most, self.old = make, most, {}

    def __missing__(self, key):
        if len(self) >= self.most:
            self.old = dict(self)
            self.clear()
        value = self.old.get(key)
        if value is None:
            value = self.make(key)
        self[key] = value
        return value


def hash_cache() -> Cache:
    """Word to 64-bit hash."""
    return Cache(xxhash.xxh3_64_intdigest)


def hashes(found: list[bytes], cache: Cache) -> np.ndarray:
    return np.fromiter(map(cache.__getitem__, found), dtype=np.uint64, count=len(found))


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit values."""
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0x9E3779B97F4A7C15)
    return x ^ (x >> np.uint64(29))


def runs(sorted_values: np.ndarray) -> np.ndarray:
    """Where each run of equal values starts, and the end."""
    if not len(sorted_values):
        return np.zeros(1, dtype=np.int64)
    return np.concatenate(([0], np.flatnonzero(sorted_values[1:] != sorted_values[:-1]) + 1, [len(sorted_values)]))


def tidy(work: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """`work`, after which a worker that waits for its next task gives its free memory back: workers outlive tasks and share an executor's memory."""

    def then_give_back(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from work(batches)
        finally:
            pa.default_memory_pool().release_unused()
            if sys.platform == "linux" and platform.libc_ver()[0] == "glibc":
                ctypes.CDLL(None).malloc_trim(0)

    return then_give_back


def append_columns(
    df: DataFrame, added: dict[str, T.DataType], make: Callable[[], Callable[[pa.RecordBatch], list]], drop: tuple[str, ...] = ()
) -> DataFrame:
    """`df` with columns computed in Arrow batches; an input column of a same name, in any case, is replaced.

    `make()` runs once in each task and returns a function from a batch to one array for each added column; its
    attribute forget, if it has one, is called at the task's end.
    """
    small_batches(df.sparkSession)
    gone = {c.lower() for c in (*added, *drop)}
    kept = [c for c in df.columns if c.lower() not in gone]
    schema = T.StructType([f for f in df.schema.fields if f.name in kept] + [T.StructField(k, v) for k, v in added.items()])
    names = [*kept, *added]
    odd = [c for c in kept if set(c) & {".", "`"}]  # these can't go to Python under their names
    plain = dict(zip(odd, fresh(df, *(f"odd{i}" for i in range(len(odd)))), strict=True))
    kept = [plain.get(c, c) for c in kept]
    df = df.select(*(c.alias(plain.get(n, n)) for c, n in zip(quoted(df.columns), df.columns, strict=True))) if odd else df

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        each = make()
        try:
            for b in batches:
                yield pa.RecordBatch.from_arrays([*(b.column(c) for c in kept), *each(b)], names=names)
        finally:
            getattr(each, "forget", lambda: None)()

    return df.mapInArrow(tidy(work), schema)


def sorted_groups(batches: Iterator[pa.RecordBatch], key: str, size: int = 4 << 20) -> Iterator[pa.Table]:
    """Tables of about `size` bytes that hold whole groups, from batches sorted by `key`: a group never straddles two of them."""
    ready: list[pa.RecordBatch] = []
    rest: list[pa.RecordBatch] = []
    for b in batches:
        if not b.num_rows:
            continue
        k = b.column(key).to_numpy(zero_copy_only=False)
        last = int(np.searchsorted(k, k[-1], side="left"))
        if rest and last == 0 and rest[-1].column(key)[-1].as_py() == k[-1]:
            rest.append(b)
            continue
        ready += rest
        if last:
            ready.append(b.slice(0, last))
        rest = [b.slice(last)]
        if sum(x.nbytes for x in ready) > size:
            yield pa.Table.from_batches(ready)
            ready = []
    if ready or rest:
        yield pa.Table.from_batches([*ready, *rest])


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, held_out: Column, per_class: int) -> tuple[DataFrame, dict[int, int]]:
    """text and label of at most `per_class` labelled documents of each class, and how many labelled ids each class has.

    `held_out` is a condition on doc_id; ids for which it is true or null never take part. Ids labelled more than
    once count with their greatest label, ids of several documents with the least text. Which ids are taken depends on
    the ids alone. The ids (at most 2 * per_class) are broadcast; texts are not moved unless they are taken.
    """
    known = labels.filter(F.col(label).isin(0, 1) & ~F.coalesce(held_out, F.lit(True))).groupBy("doc_id").agg(F.max(label).cast("int").alias("label"))
    sizes = {int(r["label"]): r["count"] for r in known.groupBy("label").count().collect()}
    picked = [known.filter(F.col("label") == c).orderBy(F.xxhash64("doc_id"), "doc_id").limit(per_class) for c in (0, 1)]
    ids = picked[0].union(picked[1])
    found = docs.select("doc_id", "text").join(F.broadcast(ids), "doc_id")
    return found.groupBy("doc_id").agg(F.min("text").alias("text"), F.max("label").alias("label")), sizes


def small_batches(spark: SparkSession) -> None:
    """Fewer rows in a batch than Spark's default, unless the session has its own number."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if spark.conf.get(name) == "10000":
        spark.conf.set(name, str(BATCH_ROWS))


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


class Adam:
    """Adaptive gradient steps on a dict of arrays."""

    def __init__(self, params: dict[str, np.ndarray], rate: float):
        self.params, self.rate, self.step = params, rate, 0
        self.first = {k: np.zeros_like(v) for k, v in params.items()}
        self.second = {k: np.zeros_like(v) for k, v in params.items()}

    def update(self, grads: dict[str, np.ndarray]) -> None:
        self.step += 1
        for k, g in grads.items():
            m, v = self.first[k], self.second[k]
            m += 0.1 * (g - m)
            v += 0.001 * (g * g - v)
            self.params[k] -= self.rate * (m / (1 - 0.9**self.step)) / (np.sqrt(v / (1 - 0.999**self.step)) + 1e-8)


def fresh(df: DataFrame, *names: str) -> tuple[str, ...]:
    """Names for columns of one's own that no column of `df` has, whatever its case."""
    taken = {c.lower() for c in df.columns}
    while any(n.lower() in taken for n in names):
        names = tuple(f"_{n}" for n in names)
    return names


def quoted(names: list[str]) -> list[Column]:
    """Columns by their literal names, dots and all."""
    return [F.col("`" + n.replace("`", "``") + "`") for n in names]


def set_aside(df: DataFrame, names: tuple[str, ...]) -> tuple[DataFrame, Callable[[DataFrame], DataFrame]]:
    """`df` with its columns of these names, in any case, under names that nothing else has, and what gives them their own again."""
    mine = [c for c in df.columns if c.lower() in names]
    if not mine:
        return df, lambda out: out
    other = fresh(df, *(f"_{c}" for c in mine))
    there, again = dict(zip(mine, other, strict=True)), dict(zip(other, mine, strict=True))
    renamed = lambda rows, new: rows.select(*(c.alias(new.get(n, n)) for c, n in zip(quoted(rows.columns), rows.columns, strict=True)))
    return renamed(df, there), lambda out: renamed(out, again)
