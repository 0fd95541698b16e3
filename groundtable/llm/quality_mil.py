"""Quality by attention over passages (multiple-instance learning).

A text is cut into passages of a fixed number of words; every one is described by what its characters and
repetitions are, and encoded by a small layer. Gated attention, learnt from labels of whole documents,
weights the passages; the weighted representation is scored. So a document may fail for one stretch of junk
without labels on passages. The model is fitted on a bounded sample of labelled rows; texts are read whole.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from groundtable.llm.common import Adam, Cache, append_columns, bucket, hash_cache, hashes, labelled_sample, sigmoid, words
from groundtable.session import cut

#: Words in a passage; documents with a score of at least CUT are predicted good.
PASSAGE, CUT = 48, 0.7
#: Words described at once.
WORDS_AT_ONCE = 150_000
#: Character classes: upper case, lower case, digits, signs, marks of exclamation, other ASCII, beyond ASCII.
CLASSES = np.full(256, 6, dtype=np.uint8)
CLASSES[:128] = 5
CLASSES[65:91], CLASSES[97:123], CLASSES[48:58] = 0, 1, 2
CLASSES[[*b"#*$%&|<>@^~=_{}[]\\"]] = 3
CLASSES[[*b"!?"]] = 4
N_CLASSES = 7
FEATURES = N_CLASSES + 6


def describe(texts: list[str | None], cache: Cache) -> tuple[np.ndarray, np.ndarray]:
    """A row of features for each passage, and how many passages each text has (at least one: an empty one)."""
    rows, sizes, group, held = [], [], [], 0
    for t in texts:
        group.append(words(t))
        held += len(group[-1])
        if held > WORDS_AT_ONCE:
            _describe(group, cache, rows, sizes)
            group, held = [], 0
    _describe(group, cache, rows, sizes)
    return np.concatenate(rows) if rows else np.zeros((0, FEATURES)), np.concatenate(sizes) if sizes else np.zeros(0, np.int64)


def _describe(group: list[list[bytes]], cache: Cache, rows: list, sizes: list) -> None:
    if not group:
        return
    n = np.array([len(g) for g in group])
    passages = np.maximum(1, -(-n // PASSAGE))
    flat = [w for g in group for w in g]
    out = np.zeros((int(passages.sum()), FEATURES))
    out[:, -1] = np.repeat(np.log1p(n), passages)
    rows.append(out)
    sizes.append(passages)
    if not flat:
        return
    length = np.fromiter(map(len, flat), np.int64, len(flat))
    owner = np.repeat(np.arange(len(group)), n)
    inside = np.arange(len(flat)) - np.repeat(np.cumsum(n) - n, n)
    of = (np.cumsum(passages) - passages)[owner] + inside // PASSAGE
    chars = CLASSES[np.frombuffer(b"".join(flat), np.uint8)]
    by_class = np.bincount(np.repeat(of, length) * N_CLASSES + chars, minlength=len(out) * N_CLASSES).reshape(-1, N_CLASSES)
    total, count = np.maximum(1, by_class.sum(axis=1)), np.maximum(1, np.bincount(of, minlength=len(out)))
    out[:, :N_CLASSES] = by_class / total[:, None]
    out[:, N_CLASSES] = total / count / 10
    h = hashes(flat, cache)
    order = np.lexsort((h, of))
    again = np.zeros(len(flat))
    again[1:] = (h[order][1:] == h[order][:-1]) & (of[order][1:] == of[order][:-1])
    out[:, N_CLASSES + 1] = np.bincount(of[order], again, len(out)) / count
    twice = np.zeros(len(flat))
    twice[1:] = (h[1:] == h[:-1]) & (owner[1:] == owner[:-1])
    out[:, N_CLASSES + 2] = np.bincount(of, twice, len(out)) / count
    out[:, N_CLASSES + 3] = np.bincount(of, length > 25, len(out)) / count
    out[:, N_CLASSES + 4] = np.log1p(count) / np.log1p(PASSAGE)


@dataclass
class Network:
    """Encoder, gated attention and classifier; features are centred and scaled first."""

    centre: np.ndarray
    scale: np.ndarray
    p: dict[str, np.ndarray]
    shift: float

    def forward(self, x: np.ndarray, sizes: np.ndarray) -> dict[str, np.ndarray]:
        p = self.p
        starts = np.cumsum(sizes) - sizes
        owner = np.repeat(np.arange(len(sizes)), sizes)
        x = (x - self.centre) / self.scale
        h = np.tanh(x @ p["w"] + p["b"])
        t, g = np.tanh(h @ p["v"]), sigmoid(h @ p["u"])
        e = (t * g) @ p["a"]
        e = np.exp(e - np.maximum.reduceat(e, starts)[owner])
        alpha = e / np.add.reduceat(e, starts)[owner]
        bag = np.add.reduceat(alpha[:, None] * h, starts)
        return {"x": x, "h": h, "t": t, "g": g, "alpha": alpha, "bag": bag, "owner": owner, "starts": starts, "z": bag @ p["c"] + p["d"][0]}

    def scores(self, x: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        if not len(sizes):
            return np.zeros(0)
        return sigmoid(self.forward(x, sizes)["z"] + self.shift)

    def gradients(self, x: np.ndarray, sizes: np.ndarray, y: np.ndarray) -> dict[str, np.ndarray]:
        f, p = self.forward(x, sizes), self.p
        dz = (sigmoid(f["z"]) - y) / len(y)
        dbag = dz[:, None] * p["c"]
        dalpha = (dbag[f["owner"]] * f["h"]).sum(axis=1)
        mean = np.add.reduceat(f["alpha"] * dalpha, f["starts"])[f["owner"]]
        de = f["alpha"] * (dalpha - mean)
        dtg = de[:, None] * p["a"]
        dt, dg = dtg * f["g"] * (1 - f["t"] ** 2), dtg * f["t"] * f["g"] * (1 - f["g"])
        dh = f["alpha"][:, None] * dbag[f["owner"]] + dt @ p["v"].T + dg @ p["u"].T
        da = dh * (1 - f["h"] ** 2)
        out = {"w": f["x"].T @ da, "b": da.sum(axis=0), "v": f["h"].T @ dt, "u": f["h"].T @ dg, "a": (f["t"] * f["g"]).T @ de, "c": f["bag"].T @ dz, "d": np.array([dz.sum()])}
        return {k: g + 1e-4 * p[k] for k, g in out.items()}


def train(x: np.ndarray, sizes: np.ndarray, labels: np.ndarray, odds: float, hidden: int = 16, epochs: int = 60, seed: int = 3) -> Network:
    """Fits the network; `odds` of label 1 among all labelled rows correct the sample's own."""
    rng, y = np.random.default_rng(seed), labels.astype(float)
    p = {"w": rng.normal(0, 0.4, (FEATURES, hidden)), "b": np.zeros(hidden), "v": rng.normal(0, 0.3, (hidden, 8)), "u": rng.normal(0, 0.3, (hidden, 8)), "a": rng.normal(0, 0.3, 8), "c": np.zeros(hidden), "d": np.zeros(1)}
    prior = float(np.log(odds))
    if not len(y) or y.min() == y.max():
        return Network(np.zeros(FEATURES), np.ones(FEATURES), p, prior)
    net = Network(x.mean(axis=0), x.std(axis=0) + 1e-6, p, 0.0)
    starts, opt = np.cumsum(sizes) - sizes, Adam(p, 0.01)
    for epoch in range(epochs):
        opt.rate = 0.01 * (1 - epoch / epochs) + 0.0005
        order = rng.permutation(len(y))
        for lo in range(0, len(y), 64):
            batch = order[lo : lo + 64]
            rows = np.concatenate([np.arange(starts[i], starts[i] + sizes[i]) for i in batch])
            opt.update(net.gradients(x[rows], sizes[batch], y[batch]))
    net.shift = prior - float(np.log(y.sum() / (len(y) - y.sum())))
    return net


def sample_passages(sample: DataFrame, most: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Features, passages and labels of the sample, on the driver: all passages of a text, of as many texts as have `most` together, half of them of each label."""

    def make():
        cache = hash_cache()

        def each(b: pa.RecordBatch) -> list:
            x, sizes = describe(b.column("text").to_pylist(), cache)
            out = [x[end - n : end].astype(np.float32).tobytes() for end, n in zip(np.cumsum(sizes), sizes, strict=True)]
            return [pa.array(out, pa.binary()), pa.array(sizes, pa.int64())]

        return each

    rows = cut(append_columns(sample, {"passages": T.BinaryType(), "n": T.LongType()}, make, drop=("text",)))
    sizes = rows.select("doc_id", "label", "n").toPandas().sort_values(["label", "n", "doc_id"], kind="stable")
    # where the bound is met, the longest texts are left out
    few = sizes[sizes.groupby("label")["n"].cumsum() <= most // 2][["doc_id"]]
    if len(few) < len(sizes):
        rows = rows.join(F.broadcast(sample.sparkSession.createDataFrame(few, sample.select("doc_id").schema)), "doc_id", "left_semi")
    found = rows.select("doc_id", "label", "passages").toPandas().sort_values("doc_id", kind="stable")
    rows = [np.frombuffer(b, np.float32).reshape(-1, FEATURES) for b in found["passages"]]
    x = np.concatenate(rows).astype(float) if rows else np.zeros((0, FEATURES))
    return x, np.array([len(r) for r in rows], dtype=np.int64), found["label"].to_numpy()


def fold(doc_id: Column) -> Column:
    """True for the documents whose labels are not learnt from: crc32(doc_id as text) modulo 4 is 2."""
    return bucket(doc_id, 4) == 2


def score(docs: DataFrame, labels: DataFrame, per_class: int = 3000, most_passages: int = 400_000) -> DataFrame:
    """`docs` with held_out boolean, score double (0 to 1, higher is better), predicted int.

    Labels are learnt from at most `per_class` documents of each class, all their passages, `most_passages` together; every
    passage of every text is encoded for scoring. Null and empty texts are one empty passage. Rows are scored one by one, so repeated rows score
    alike; a null doc_id is not held out. Without labels of both classes all scores are one prior. Input columns named like
    the added ones are replaced; an empty table gives no rows.
    """
    sample, sizes = labelled_sample(docs, labels, "quality", fold(F.col("doc_id")), per_class)
    model = train(*sample_passages(sample, most_passages), odds=(sizes.get(1, 0) + 0.5) / (sizes.get(0, 0) + 0.5))
    shipped = docs.sparkSession.sparkContext.broadcast(model)

    def make():
        net, cache = shipped.value, hash_cache()
        return lambda b: [pa.array(net.scores(*describe(b.column("text").to_pylist(), cache)))]

    scored = append_columns(docs, {"score": T.DoubleType()}, make)
    return scored.withColumns({"held_out": F.coalesce(fold(F.col("doc_id")), F.lit(False)), "predicted": (F.col("score") >= CUT).cast("int")})
