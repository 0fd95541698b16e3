"""Toxicity by a factorization machine over hashed terms.

A document's terms are its words, in lower case and without punctuation at their ends, and the starts of
longer words, hashed into a fixed number of slots. Each slot has a value, a weight and a short vector; the score adds
up values times weights and the products of all pairs of values times vectors, a document's values having length 1 together, so terms that matter only
together (an insult and a group) count together. The more a slot tells of the label by itself the larger its value, so that the many that tell nothing don't drown the few
that do; none is left out for that. The model is fitted on a bounded sample of labelled rows; texts are read whole.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from groundtable.llm.common import CACHE, Adam, Cache, append_columns, bucket, labelled_sample, sigmoid, words

SLOTS = 1 << 20
#: Lengths of a longer word's starts that are terms of their own.
STARTS = (4, 5, 6, 7, 8)
#: Documents of the sample that a slot is in, to be kept.
LEAST = 4
#: Largest value of a slot; one that tells nothing by itself has about 1.
MOST = 30.0
EDGES = b".,;:!?\"'()[]{}|*#$%&<>-_/\\+=~`^@"
#: Documents with a score of at least this are predicted toxic.
CUT = 0.7


def terms(word: bytes) -> tuple[int, ...]:
    """Slots of a word as it stands in a text."""
    bare = word.strip(EDGES)
    if not bare:
        return ()
    if bare.isascii():  # its bytes are its characters
        bare = bare.lower()
        forms = [bare, *[b"\0" + bare[:k] for k in STARTS if len(bare) > k]]
    else:
        text = bare.decode().lower()
        forms = [text.encode(), *[b"\0" + text[:k].encode() for k in STARTS if len(text) > k]]
    return tuple([xxhash.xxh3_64_intdigest(f) % SLOTS for f in forms])


@dataclass
class Machine:
    """Weights and vectors of the slots that are kept; a text without any of them scores by the bias alone."""

    slots: np.ndarray  # sorted
    bias: float
    weights: np.ndarray
    vectors: np.ndarray
    values: np.ndarray | None = None  # all alike, if none are given

    def scores(self, rows: list[np.ndarray]) -> np.ndarray:
        """Probabilities for documents given as places of kept slots."""
        return self.all_scores(np.concatenate([np.zeros(0, np.int64), *rows]).astype(np.int64), np.repeat(np.arange(len(rows)), [len(r) for r in rows]), len(rows))

    def all_scores(self, ids: np.ndarray, who: np.ndarray, n: int) -> np.ndarray:
        """The same for n documents at once: places of slots, and the document of each."""
        add = lambda v: np.bincount(who, v, n)
        x = np.ones(len(ids)) if self.values is None else self.values[ids].astype(float)
        x /= np.sqrt(add(x * x))[who]
        z = self.bias + add(self.weights[ids] * x)
        for v in self.vectors.T:
            part = v[ids] * x
            z += 0.5 * (add(part) ** 2 - add(part * part))
        return sigmoid(z)


class Known(dict):
    """The kept slots of words, found once a word: a word's number tells where they begin in one array, and how many they are."""

    def __init__(self, place: np.ndarray):
        self.place = place
        self.forget()

    def forget(self) -> None:
        self.clear()
        self.slots, self.held, self.new = np.zeros(0, np.int64), np.zeros(0, np.int64), []

    def __missing__(self, word: bytes) -> int:
        self.new.append(word)
        self[word] = number = len(self)
        return number

    def learn(self) -> None:
        """The slots of the new words, looked up together."""
        found = [terms(w) for w in self.new]
        sizes = np.fromiter(map(len, found), np.int64, len(found))
        kept = self.place[np.fromiter(chain.from_iterable(found), np.int64, int(sizes.sum()))].astype(np.int64)
        there = kept >= 0
        self.slots = np.append(self.slots, kept[there])
        self.held = np.append(self.held, np.bincount(np.repeat(np.arange(len(sizes)), sizes)[there], minlength=len(sizes)))
        self.new = []

    def of(self, texts: Iterable[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Each text's distinct slots, ascending, one text after another, and the text of each. Full of words, all are forgotten before the next texts."""
        if len(self) > 4 * CACHE:
            self.forget()
        found, counts = [], []
        for t in texts:
            own = set(words(t))
            found += map(self.__getitem__, own)
            counts.append(len(own))
        self.learn()
        found = np.array(found, dtype=np.int64)
        sizes, starts = self.held[found], (np.cumsum(self.held) - self.held)[found]
        ends = np.cumsum(sizes)
        at = np.repeat(starts - (ends - sizes), sizes) + np.arange(sizes.sum())
        who = np.repeat(np.repeat(np.arange(len(counts)), counts), sizes)
        both = np.unique(who * SLOTS + self.slots[at])
        return both % SLOTS, both // SLOTS


def told(n: int, n1: int, held: np.ndarray, held1: np.ndarray) -> np.ndarray:
    """The root of 1 and the chi-square of each slot against the label, at most MOST: n documents, n1 of label 1, held and held1 of these have the slot."""
    a, b, c, d = (x.astype(float) for x in (held1, held - held1, n1 - held1, n - n1 - held + held1))
    chi = n * (a * d - b * c) ** 2 / np.maximum(1, (a + b) * (c + d) * (a + c) * (b + d))
    return np.minimum(MOST, np.sqrt(1 + chi)).astype(np.float32)


def train(rows: list[np.ndarray], labels: np.ndarray, odds: float, rank: int = 6, epochs: int = 40, seed: int = 1) -> Machine:
    """Fits a machine to documents given as sorted distinct slots.

    Slots in at least 4 documents are kept, whatever they tell alone: a term may count only together with another.
    `odds`: of label 1 among all labelled rows; the sample's own odds may differ and are corrected in the bias.
    """
    rng, y, n = np.random.default_rng(seed), labels.astype(float), len(labels)
    prior = float(np.log(max(odds, 1e-6)))
    if n == 0 or y.min() == y.max():
        return Machine(np.zeros(0, np.int64), prior, np.zeros(0), np.zeros((0, rank)))
    held = np.bincount(np.concatenate(rows), minlength=SLOTS)
    held1 = np.bincount(np.concatenate([r for r, one in zip(rows, labels, strict=True) if one]), minlength=SLOTS)
    slots = np.flatnonzero(held >= LEAST)
    values = told(n, int(y.sum()), held[slots], held1[slots])
    place = np.full(SLOTS, -1, dtype=np.int32)
    place[slots] = np.arange(len(slots))
    rows = [x[x >= 0] for x in (place[r] for r in rows)]
    sizes = np.array([len(r) for r in rows])
    lengths = np.array([np.sqrt((values[r].astype(float) ** 2).sum()) for r in rows])
    p = {"b": np.zeros(1), "w": np.zeros(len(slots), np.float32), "v": rng.normal(0, 0.05, (rank, len(slots))).astype(np.float32)}
    opt = Adam(p, 0.02)
    for _ in range(epochs):
        order = rng.permutation(n)
        for lo in range(0, n, 256):
            batch = order[lo : lo + 256]
            ids, who = np.concatenate([rows[i] for i in batch]), np.repeat(np.arange(len(batch)), sizes[batch])
            x = values[ids] / lengths[batch][who]
            add = lambda v: np.bincount(who, v, len(batch))  # noqa: B023, E731
            back = lambda v: np.bincount(ids, v, len(slots))  # noqa: B023, E731
            total = np.stack([add(v[ids] * x) for v in p["v"]])
            z = p["b"][0] + add(p["w"][ids] * x) + 0.5 * ((total**2).sum(axis=0) - add((p["v"] ** 2).sum(axis=0)[ids] * x * x))
            g = (sigmoid(z) - y[batch]) / len(batch)
            own = g[who] * x
            v = np.stack([back(own * t[who]) for t in total]) - back(own * x) * p["v"]
            opt.update({"b": np.array([g.sum()]), "w": back(own) + 1e-5 * p["w"], "v": v + 1e-4 * p["v"]})
    n1 = y.sum()
    bias = float(p["b"][0]) + prior - float(np.log(n1 / (n - n1)))
    return Machine(slots, bias, p["w"], np.ascontiguousarray(p["v"].T), values)


def sample_rows(sample: DataFrame) -> tuple[list[np.ndarray], np.ndarray]:
    """The sample's slots, packed, and labels, on the driver (the sample is bounded)."""

    def make():
        cache = Cache(terms)

        def each(b: pa.RecordBatch) -> list:
            return [pa.array([np.array(sorted({s for w in set(words(t.as_py())) for s in cache[w]}), np.int32).tobytes() for t in b.column("text")], pa.binary())]

        return each

    found = append_columns(sample, {"slots": T.BinaryType()}, make, drop=("text",)).toArrow().to_pandas().sort_values("doc_id", kind="stable")
    return [np.frombuffer(x, np.int32) for x in found["slots"]], found["label"].to_numpy()


def fold(doc_id: Column) -> Column:
    """True for the documents whose labels are not learnt from: crc32(doc_id as text) modulo 3 is 1."""
    return bucket(doc_id, 3) == 1


def score(docs: DataFrame, labels: DataFrame, per_class: int = 5000) -> DataFrame:
    """`docs` with held_out boolean, score double (0 to 1), predicted int.

    Labels are learnt from at most `per_class` documents of each class. Null and empty texts score the bias
    alone; rows are scored one by one, so repeated rows score alike; a null doc_id is not held out. Without labels of both
    classes all scores are one prior. Input columns named like the added ones are replaced; an empty table gives no rows.
    """
    sample, sizes = labelled_sample(docs, labels, "toxic", fold(F.col("doc_id")), per_class)
    model = train(*sample_rows(sample), odds=(sizes.get(1, 0) + 0.5) / (sizes.get(0, 0) + 0.5))
    shipped = docs.sparkSession.sparkContext.broadcast(model)

    def make():
        m = shipped.value
        place = np.full(SLOTS, -1, dtype=np.int32)
        place[m.slots] = np.arange(len(m.slots))
        known = Known(place)

        def each(b: pa.RecordBatch) -> list:
            ids, who = known.of(t.as_py() for t in b.column("text"))
            return [pa.array(m.all_scores(ids, who, b.num_rows))]

        return each

    scored = append_columns(docs, {"score": T.DoubleType()}, make)
    return scored.withColumns({"held_out": F.coalesce(fold(F.col("doc_id")), F.lit(False)), "predicted": (F.col("score") >= CUT).cast("int")})
