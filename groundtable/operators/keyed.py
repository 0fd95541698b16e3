"""Tables laid out by key: a write touches only the buckets whose keys it brings.

A row's bucket is a hash of the first key. Below a table's folder, data/ has a folder for each write, in it one for
each bucket written, and manifest/ a file for each version: for every bucket the folders that hold it. A version counts once its manifest
is there, so a reader or a crash at any time finds a whole table; what a stopped write has left is nowhere named. The version before
stays for plans that still read it, older data goes. One writer at a time: of two that start from one version the second fails.

The hash is the one by which Spark buckets tables, and files are named accordingly. located() tells Spark so: joins of two such tables on their first
key need no exchange on either side.
"""

from __future__ import annotations

import hashlib
import json
import uuid
from dataclasses import dataclass, field, replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from groundtable.operators.order import numbered
from groundtable.operators.queues import first_seen
from groundtable.operators.store import cut_message, migrate, new_rows, upsert
from groundtable.session import dealt, stored

BUCKETS = 16


@dataclass(frozen=True)
class Keyed:
    """Where a table is, its columns (DDL) and its keys; `buckets` is of a table yet to be written, one that is there has its own number."""

    spark: SparkSession
    path: str
    schema: str
    keys: tuple[str, ...]
    buckets: int = BUCKETS


@dataclass(frozen=True)
class Manifest:
    """One version: how many buckets, the folders of each that has rows, and the next free number of a table that numbers its rows."""

    version: int
    buckets: int
    held: dict[int, list[str]] = field(default_factory=dict)
    next_id: int = 0


def _files(t: Keyed, name: str = ""):
    path = t.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{t.path}/{name}" if name else t.path)
    return path, path.getFileSystem(t.spark.sparkContext._jsc.hadoopConfiguration())


def _listed(t: Keyed, name: str = "") -> list[str]:
    path, fs = _files(t, name)
    return sorted(p.getPath().getName() for p in fs.listStatus(path)) if fs.exists(path) else []


def versions(t: Keyed) -> list[int]:
    """Numbers of the versions whose manifests are there, ascending."""
    return [int(n[:-5]) for n in _listed(t, "manifest") if n.endswith(".json") and n[:-5].isdigit()]


def manifest(t: Keyed, version: int | None = None) -> Manifest:
    """The last version's manifest, or that of `version`; of a table that is not there an empty one."""
    there = versions(t)
    if not there:
        return Manifest(0, t.buckets)
    path, fs = _files(t, f"manifest/{version or there[-1]:012d}.json")
    stream = fs.open(path)
    try:
        said = json.loads(t.spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    finally:
        stream.close()
    return Manifest(said["version"], said["buckets"], {int(k): v for k, v in said["held"].items()}, said["next_id"])


def _loose(t: Keyed) -> bool:
    """Whether Parquet files lie in the table's folder that no version has taken in."""
    return any(n.endswith(".parquet") for n in _listed(t))


def read(t: Keyed, buckets: list[int] | None = None, version: int | None = None) -> DataFrame:
    """The table's last version or `version`, of the given buckets or all; before the first version, Parquet files put there by hand."""
    m = manifest(t, version)
    if not m.version and _loose(t):
        return t.spark.read.schema(t.schema).option("pathGlobFilter", "*.parquet").option("recursiveFileLookup", "false").parquet(t.path)
    folders = [f"{t.path}/data/{f}" for b in sorted(m.held) if buckets is None or b in buckets for f in m.held[b]]
    return t.spark.read.schema(t.schema).parquet(*folders) if folders else t.spark.createDataFrame([], t.schema)


def located(t: Keyed) -> DataFrame:
    """read() of the whole last version as a table bucketed by the first key, registered in the session's catalog with a partition for each bucket's folder."""
    m = manifest(t)
    if not m.held:
        return read(t)
    stem = f"keyed_{hashlib.md5(t.path.encode()).hexdigest()[:16]}"
    name, key = f"{stem}_{m.version}", t.keys[0]
    if not t.spark.catalog.tableExists(name):
        path, _ = _files(t)
        where = path.getFileSystem(t.spark.sparkContext._jsc.hadoopConfiguration()).makeQualified(path).toString()
        t.spark.sql(f"CREATE TABLE {name} ({t.schema}, _write string, _bucket int) USING parquet PARTITIONED BY (_write, _bucket) CLUSTERED BY (`{key}`) INTO {m.buckets} BUCKETS LOCATION '{where}/data'")
        parts = [f"PARTITION (_write = '{f.split('/')[0]}', _bucket = {b}) LOCATION '{where}/data/{f}'" for b, folders in m.held.items() for f in folders]
        t.spark.sql(f"ALTER TABLE {name} ADD {' '.join(parts)}")
        if m.version > 2:
            t.spark.sql(f"DROP TABLE IF EXISTS {stem}_{m.version - 2}")  # its files are gone
    return t.spark.table(name).drop("_write", "_bucket")


def bucket(t: Keyed, n: int) -> Column:
    """Spark's own bucket of the first key."""
    return F.pmod(F.hash(t.keys[0]), F.lit(n)).cast("int")


def _write(t: Keyed, df: DataFrame, m: Manifest) -> dict[int, str]:
    """Writes `df` by bucket into a folder of its own; the folder of each bucket that got rows."""
    folder = f"{m.version + 1:012d}-{uuid.uuid4().hex[:8]}"
    rows = df.select(*t.spark.createDataFrame([], t.schema).columns).withColumn("bucket", bucket(t, m.buckets))
    draft = f"draft_{uuid.uuid4().hex}"  # only a named table can be written in buckets; the name goes, the files stay
    rows.repartition(m.buckets, "bucket").write.partitionBy("bucket").bucketBy(m.buckets, t.keys[0]).sortBy(t.keys[0]).option("path", f"{t.path}/data/{folder}").saveAsTable(draft)
    t.spark.sql(f"DROP TABLE {draft}")
    return {int(n.split("=")[1]): f"{folder}/{n}" for n in _listed(t, f"data/{folder}") if n.startswith("bucket=")}


def _commit(t: Keyed, m: Manifest) -> None:
    path, fs = _files(t, f"manifest/{m.version:012d}.json")
    if fs.exists(path):
        raise RuntimeError(f"{t.path} has been written meanwhile")
    draft, _ = _files(t, f"manifest/.{uuid.uuid4()}")
    out = fs.create(draft)
    out.write(bytearray(json.dumps({"version": m.version, "buckets": m.buckets, "held": m.held, "next_id": m.next_id}).encode()))
    out.close()
    if not fs.rename(draft, path):
        raise RuntimeError(f"{t.path} has been written meanwhile")
    _sweep(t, m)


def _sweep(t: Keyed, m: Manifest) -> None:
    """Drops all versions but the last two, what only they hold, and what stopped writes have left."""
    there = versions(t)
    for v in there[:-2]:
        path, fs = _files(t, f"manifest/{v:012d}.json")
        fs.delete(path, False)
    named = {f.split("/")[0] for v in there[-2:] for folders in manifest(t, v).held.values() for f in folders}
    for name in _listed(t, "data"):
        if name not in named and int(name.split("-")[0]) <= m.version:
            path, fs = _files(t, f"data/{name}")
            fs.delete(path, True)


def replace_all(t: Keyed, df: DataFrame) -> None:
    """Writes a version that holds exactly `df`."""
    m = manifest(t)
    _commit(t, replace(m, version=m.version + 1, held={b: [f] for b, f in _write(t, df, m).items()}))


def _touched(t: Keyed, rows: DataFrame) -> tuple[Manifest, list[int]]:
    """The table's manifest and the buckets that rows fall in; a table put there by hand is taken in first."""
    if not versions(t) and _loose(t):
        replace_all(t, read(t))
    m = manifest(t)
    return m, sorted(r["b"] for r in rows.select(bucket(t, m.buckets).alias("b")).distinct().collect())  # one row a bucket


def merge(t: Keyed, updates: DataFrame, on_insert: dict[str, Column] | None = None, order: list[Column] | None = None) -> list[int]:
    """upsert() of `updates` into the table; only buckets that they touch are read and written. Returns those.

    Keys that come more than once are reduced to their first row in `order`; without an order they are an error of the caller. Nothing is
    written for no updates.
    """
    rows = stored(first_seen(updates, [*t.keys], order) if order else updates, "updates")
    m, touched = _touched(t, rows)
    if touched:
        merged = upsert(read(t, touched), rows, [*t.keys], on_insert)
        _commit(t, replace(m, version=m.version + 1, held=m.held | {b: [f] for b, f in _write(t, merged, m).items()}))
    return touched


def insert(t: Keyed, batch: DataFrame, order: list[Column]) -> int:
    """Adds the batch's rows of new keys, the first of each key in `order`; what is there is neither changed nor written again. Returns their number."""
    rows = stored(batch, "batch")
    m, touched = _touched(t, rows)
    fresh = migrate(new_rows(read(t, touched), rows, [*t.keys], order), t.spark, t.schema)
    return _append(t, stored(fresh, "fresh"), m)


def _append(t: Keyed, fresh: DataFrame, m: Manifest, numbers: bool = False) -> int:
    n = fresh.count()
    if n:
        held = {b: [*f] for b, f in m.held.items()}
        for b, folder in _write(t, fresh, m).items():
            held.setdefault(b, []).append(folder)
        _commit(t, replace(m, version=m.version + 1, held=held, next_id=m.next_id + (n if numbers else 0)))
    return n


#: What tells two dead letters apart. Their time is that of what failed, so the same thing failing again is the same letter.
LETTER = ["listing_id", "stage", "error_class", "message", "ts"]


def log(t: Keyed, rows: DataFrame) -> int:
    """Adds dead letters that are not there yet, with dense ids from 1 in the order of LETTER; messages are cut. Returns how many.

    Running a stage again over the same input adds none. Only the buckets of the listings concerned are read.
    """
    rows = stored(rows.select(*LETTER).withColumn("message", cut_message(F.col("message"))).distinct(), "letters")
    m, touched = _touched(t, rows)
    if not m.next_id:
        m = replace(m, next_id=1 + (read(t).agg(F.max("id")).first()[0] or 0))
    old = read(t, touched)
    same = F.lit(True)
    for c in LETTER:
        same = same & rows[c].eqNullSafe(old[c])
    fresh = numbered(rows.join(dealt(old), same, "left_anti"), LETTER, "id").withColumn("id", F.col("id") + F.lit(m.next_id))
    return _append(t, stored(fresh, "fresh"), m, numbers=True)
