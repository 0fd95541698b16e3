"""Periodic runs of words, found for every lag at once with bit-parallel integers.

The words of a text get numbers in order of first occurrence; bit b of all numbers is one plane, a Python integer
with a bit for each word. For a lag q, a plane XOR the same plane shifted by q tells where that bit differs between
words q apart, and the OR over the planes where the words differ. Stretches of zeros of at least m places are
isolated by shift-doubling: z &= z >> 1, z &= z >> 2, ... leaves the places where m zeros begin. Planes are read
in turn and a lag ends as soon as those read so far leave no such stretch.

Most lags of a long text can be told off before that: see may_repeat().
"""

from __future__ import annotations

from collections.abc import Callable
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from groundtable.llm.common import append_columns

#: A run holds its period this many times, and this many words, at least.
REPEATS, LEAST = 4, 6
#: Lags beyond this are looked at by their blocks' first COLUMNS words before their planes are read.
NEAR, COLUMNS = 512, 8
RUN = T.StructType([T.StructField("start", T.LongType()), T.StructField("length", T.LongType()), T.StructField("period", T.LongType())])


def bit_planes(numbers: np.ndarray) -> list[int]:
    """Bit b of every number as one integer, for each b that occurs."""
    top = int(numbers.max(initial=0)).bit_length()
    return [int.from_bytes(np.packbits((numbers >> b) & 1, bitorder="little").tobytes(), "little") for b in range(top)]


def places(bits: int) -> np.ndarray:
    """Where the bits are set, ascending."""
    held = np.frombuffer(bits.to_bytes((bits.bit_length() + 7) // 8, "little"), np.uint8)
    return np.flatnonzero(np.unpackbits(held, bitorder="little"))


def stretches(zeros: int, least: int) -> int:
    """The places of `zeros` (set bits) where at least `least` of them begin."""
    have = 1
    while zeros and have < least:
        step = min(have, least - have)
        zeros &= zeros >> step
        have += step
    return zeros


def repeats_at(planes: list[int], q: int, within: int, least: int) -> int:
    """The places from which on `least` words equal those q further on; `within` has a bit for each place that has one."""
    differ, last = 0, len(planes) - 1
    if last < 0:
        return stretches(within, least)
    for k, plane in enumerate(planes):
        differ |= plane ^ (plane >> q)
        if k & 1 or k == last:
            left = stretches(within & ~differ, least)
            if not left:
                return 0
    return left


def may_repeat(numbers: np.ndarray, q: int, repeats: int, found: dict[tuple[int, int], int]) -> bool:
    """False only if no run of period q is left to be found.

    Cut into blocks of q words from word 0, a run of `repeats` periods holds repeats - 1 blocks one after another that are all
    equal, their first words too. Blocks that lie in a run already found whose period divides q are that run's: two stretches of
    periods p and q that share p + q words are one.
    """
    rows, whole = len(numbers) // q, repeats - 2
    head = numbers[: rows * q].reshape(rows, q)[:, :COLUMNS]
    same = (head[1:] == head[:-1]).all(axis=1)
    hit = same[: len(same) - whole + 1]
    for k in range(1, whole):
        hit = hit & same[k : len(same) - whole + 1 + k]
    if not hit.any():
        return False
    first = np.flatnonzero(hit) * q
    for (start, end), p in found.items():
        if q % p == 0:
            first = first[(first < start) | (first + (whole + 1) * q > end)]
            if not len(first):
                return False
    return True


def find_runs(words: list[bytes], repeats: int = REPEATS, least: int = LEAST) -> list[tuple[int, int, int]]:
    """(start, length, period) of every run, by start, then period.

    A run is a stretch of words with smallest period q (words q apart are equal), of at least max(least, repeats * q) words, that no
    neighbouring word extends. `repeats` is 2 or more: then a lag that is a multiple of a stretch's period gives the same stretch again,
    after the period itself, and is left out.
    """
    n = len(words)
    if n < least or repeats < 2:
        return []
    number: dict[bytes, int] = {}
    numbers = np.array([number.setdefault(w, len(number)) for w in words], dtype=np.int64)
    planes, found, within = bit_planes(numbers), {}, (1 << n) - 1
    for q in range(1, n // repeats + 1):
        within >>= 1
        if q > NEAR and repeats > 2 and not may_repeat(numbers, q, repeats, found):
            continue
        m = max(least, repeats * q) - q
        begins = repeats_at(planes, q, within, m)
        if begins:
            ends = places(begins & ~(begins >> 1)) + m + q
            for start, end in zip(places(begins & ~(begins << 1)).tolist(), ends.tolist(), strict=True):
                found.setdefault((start, end), q)
    return sorted((start, end - start, q) for (start, end), q in found.items())


def collapse(words: list[bytes], runs: list[tuple[int, int, int]]) -> bytes:
    """The words joined by one space, of each run only what its first period leaves."""
    if not runs:
        return b" ".join(words)
    depth = np.zeros(len(words) + 1, dtype=np.int64)
    for start, length, q in runs:
        depth[start + q] += 1
        depth[start + length] -= 1
    return b" ".join(compress(words, (np.cumsum(depth[:-1]) == 0).tolist()))


def detect(
    docs: DataFrame, text_col: str = "text", repeats: int = REPEATS, least: int = LEAST, drop: tuple[str, ...] = (),
    change: Callable[[int | None, list[bytes]], list[bytes]] | None = None, key_col: str = "doc_id",
) -> DataFrame:
    """`docs` with n_words, runs (by start, then period) and collapsed: the text with every run cut to its first period.

    Words are `[^\\x20\\x09-\\x0D]+`; whole texts are searched, however long. A null or empty text has no words, no runs and an empty
    collapsed text. Rows are looked at one by one, so repeated rows and ids give equal results; columns named like the added ones, in any
    case, are replaced. An empty table gives no rows. `change`, if given, turns a row's key and words into the words that are searched.
    """

    def make():
        def each(b: pa.RecordBatch) -> list:
            counts, offsets, found, texts = [], [0], [], []
            keys = b.column(key_col).to_pylist() if change else [None] * b.num_rows
            for key, text in zip(keys, b.column(text_col).cast(pa.binary()).to_pylist(), strict=True):
                words = text.split() if text else []
                if change:
                    words = change(key, words)
                runs = find_runs(words, repeats, least)
                counts.append(len(words))
                found += runs
                offsets.append(len(found))
                texts.append(collapse(words, runs))
            flat = np.array(found, dtype=np.int64).reshape(-1, 3)
            structs = pa.StructArray.from_arrays([pa.array(flat[:, k]) for k in range(3)], names=RUN.names)
            return [pa.array(counts, pa.int64()), pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), structs), pa.array(texts, pa.binary()).cast(pa.string())]

        return each

    return append_columns(docs, {"n_words": T.LongType(), "runs": T.ArrayType(RUN), "collapsed": T.StringType()}, make, drop)
