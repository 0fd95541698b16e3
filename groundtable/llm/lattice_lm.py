"""Probability of a text under a unigram model over subwords, summed over all segmentations.

The pieces are those of an existing subword vocabulary; its scores (an order of pieces) give first
probabilities, which rounds of expectation maximisation over the training words refine. A word is the
vocabulary's word mark and its characters; a lattice holds every piece that fits anywhere, characters may
always be spelled in byte pieces, and a forward recursion in log space adds up all paths. Since the mark
begins every word and nothing else, a text's lattice falls apart at its words, so each distinct word is
scored once for the whole corpus. Words of one length are taken together, a place of all at a time; a long
word is taken alone, arc by arc and in spans of places, so its time and memory grow with its length only.

Words seen in training have one more arc, from their start to their end, of their discounted count; what the
discounts set free is spread over the subword paths. The probabilities of all words and the end add up to 1.

Words are counted over all documents. Those that make up at least one in `one_in` of the corpus (so at most
`one_in` of them) are looked up where documents are read; the others are joined.
"""

from __future__ import annotations

from array import array
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import repeat
from math import exp, inf, log1p

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from groundtable.llm.common import FLUSH, bucket, mix, small_batches
from groundtable.session import cut

#: The mark that begins a word in the vocabulary; a mark inside a word is spelled in bytes.
MARK, HIDDEN = 0x2581, 0x110000
#: Cells of a lattice that are held at once.
CELLS = 2_000_000
#: Bytes of words, with their counts, that a task takes together.
TOGETHER = 4_000_000
#: Characters from which a word is taken alone, and places of it whose arcs are held at once.
LONG, SPAN = 1_024, 65_536
#: Weight of the vocabulary's own order against the corpus, in pieces.
PRIOR = 50.0
BASE = np.uint64(0x9E3779B97F4A7C55)


@dataclass
class Pieces:
    """A vocabulary and its log probabilities; bytes are the last 256 pieces."""

    texts: list[str]
    prior: np.ndarray
    logs: np.ndarray

    @staticmethod
    def load(path: str) -> Pieces:
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        n = sp.get_piece_size()
        plain = [i for i in range(n) if not (sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i))]
        # the mark may begin a piece and stand nowhere else
        plain = [i for i in plain if chr(MARK) not in sp.id_to_piece(i)[1:]]
        # scores order the pieces; by Zipf's law a piece's share falls with its place
        place = np.empty(len(plain))
        place[np.argsort([-sp.get_score(i) for i in plain], kind="stable")] = np.arange(len(plain))
        share = 1 / (place + 3)
        prior = np.concatenate([0.99 * share / share.sum(), np.full(256, 0.01 / 256)])
        return Pieces([sp.id_to_piece(i) for i in plain], prior, np.log(prior))

    def refined(self, counts: np.ndarray) -> Pieces:
        p = counts + PRIOR * self.prior
        return Pieces(self.texts, self.prior, np.log(p / p.sum()))


def char_hash(codes: np.ndarray) -> np.ndarray:
    return mix(mix(codes.astype(np.uint64) + np.uint64(0x51ED27)))


class Lattice:
    """Forward and backward sums over batches of words of one length."""

    def __init__(self, pieces: Pieces):
        self.logs, self.n_plain = pieces.logs, len(pieces.texts)
        self.longest = max(map(len, pieces.texts), default=1)
        sizes = np.fromiter(map(len, pieces.texts), np.int64, self.n_plain)
        keys = np.zeros(self.n_plain, dtype=np.uint64)
        for k in np.unique(sizes):
            at = np.flatnonzero(sizes == k)
            codes = np.frombuffer("".join(pieces.texts[i] for i in at).encode("utf-32-le"), np.uint32).reshape(len(at), k)
            keys[at] = self.prefixes(codes)[-1] * np.uint64(64) + np.uint64(min(k, 63))
        self.ids = np.argsort(keys)
        self.keys = keys[self.ids]
        self.maybe = np.zeros(1 << 20, dtype=bool)  # most strings are no piece, which their upper bits tell
        slots = (self.keys >> np.uint64(44)).astype(np.int64)
        self.maybe[slots] = True
        self.first = np.zeros(1 << 20, dtype=np.int32)  # pieces of equal upper bits are neighbours: the first of them, and how many at most
        self.first[slots[::-1]] = np.arange(len(slots))[::-1]
        self.most = int(np.bincount(slots).max())

    @staticmethod
    def prefixes(codes: np.ndarray) -> np.ndarray:
        """Rolling hashes of all prefixes, with wrap-around: a row for each place, a column for each word."""
        h = np.zeros((codes.shape[1] + 1, codes.shape[0]), dtype=np.uint64)
        c = char_hash(codes.T)
        for i in range(codes.shape[1]):
            h[i + 1] = h[i] * BASE + c[i]
        return h

    def arcs(self, codes: np.ndarray) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """For each length from 1: start, word and piece of every arc, by start."""
        h, n = self.prefixes(codes), codes.shape[1]
        out, power = [], 1
        for k in range(1, min(self.longest, n) + 1):
            power = power * int(BASE) & 0xFFFFFFFFFFFFFFFF
            key = (h[k:] - h[:-k] * np.uint64(power)) * np.uint64(64) + np.uint64(min(k, 63))
            slot = (key >> np.uint64(44)).view(np.int64)
            start, word = np.nonzero(self.maybe[slot])
            key, at = key[start, word], self.first[slot[start, word]]
            for _ in range(self.most - 1):
                at += (self.keys[at] < key) & (at + 1 < len(self.keys))
            same = self.keys[at] == key
            out.append((start[same], word[same], self.ids[at[same]]))
        return out

    def spelled(self, codes: np.ndarray, start: bool = True) -> np.ndarray:
        """Log probability of each character spelled in bytes; the word mark at the start is no character."""
        there = np.flatnonzero(np.bincount(codes.ravel()))
        each = np.zeros(there[-1] + 1)
        each[there] = [self.logs[self.n_plain + np.array([*spell(int(c))])].sum() for c in there]
        out = each[codes]
        if start:
            out[:, 0] = -np.inf
        return out

    def steps(self, arcs: list[tuple[np.ndarray, np.ndarray, np.ndarray]], n: int) -> list[list[tuple[int, np.ndarray, np.ndarray]]]:
        """For each start: the lengths of its arcs, with the words that have one and its log probability."""
        out: list[list[tuple[int, np.ndarray, np.ndarray]]] = [[] for _ in range(n)]
        for k, (start, word, piece) in enumerate(arcs, 1):
            logs, ends = self.logs[piece], np.searchsorted(start, np.arange(n + 1))
            for i in np.flatnonzero(np.diff(ends)).tolist():
                part = slice(ends[i], ends[i + 1])
                out[i].append((k, word[part], logs[part]))
        return out

    @staticmethod
    def forward(steps: list[list[tuple[int, np.ndarray, np.ndarray]]], spelled: np.ndarray) -> np.ndarray:
        """A row for each place, a column for each word; no place is left before all that lead to it are added up."""
        rows, n = spelled.shape
        f = np.full((n + 1, rows), -np.inf)
        f[0] = 0
        for i in range(n):
            f[i + 1] = np.logaddexp(f[i + 1], f[i] + spelled[:, i])
            for k, word, log in steps[i]:
                f[i + k, word] = np.logaddexp(f[i + k, word], f[i, word] + log)
        return f

    def score(self, codes: np.ndarray) -> np.ndarray:
        """Natural log of each word's marginal probability."""
        if codes.shape[1] > LONG:
            return np.array([self.forward_long(c)[-1] for c in codes])
        return self.forward(self.steps(self.arcs(codes), codes.shape[1]), self.spelled(codes))[-1]

    def expect(self, codes: np.ndarray, times: np.ndarray, into: np.ndarray) -> None:
        """Adds the expected number of each piece in words that come `times` times."""
        rows, n = codes.shape
        if n > LONG:
            for c, x in zip(codes, times.tolist(), strict=True):
                self.expect_long(c, x, into)
            return
        arcs, spelled = self.arcs(codes), self.spelled(codes)
        steps = self.steps(arcs, n)
        f = self.forward(steps, spelled)
        b = np.full((n + 1, rows), -np.inf)
        b[n] = 0
        for i in range(n - 1, -1, -1):
            b[i] = b[i + 1] + spelled[:, i]
            for k, word, log in steps[i]:
                b[i, word] = np.logaddexp(b[i, word], b[i + k, word] + log)
        for k, (start, word, piece) in enumerate(arcs, 1):
            share = np.exp(f[start, word] + self.logs[piece] + b[start + k, word] - f[n, word]) * times[word]
            into += np.bincount(piece, share, len(into))
        share = np.exp(f[:-1] + spelled.T + b[1:] - f[n]) * times
        self.add_spelled(codes.T.ravel(), share.ravel(), into)

    def add_spelled(self, codes: np.ndarray, share: np.ndarray, into: np.ndarray) -> None:
        sums = np.bincount(codes, share)
        for c in np.flatnonzero(sums > 0).tolist():
            np.add.at(into, self.n_plain + np.array([*spell(c)]), sums[c])

    def span(self, codes: np.ndarray, lo: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """start, size, piece (-1: spelled in bytes) and log probability of the arcs that start in the span of places from `lo`, by start."""
        part = codes[None, lo : lo + SPAN + self.longest - 1]
        rows = min(SPAN, len(codes) - lo)
        spelled = self.spelled(part[:, :rows], lo == 0)[0]
        at = np.flatnonzero(spelled > -np.inf)
        starts, sizes, pieces, logs = [at], [np.ones_like(at)], [np.full_like(at, -1)], [spelled[at]]
        for k, (start, _, piece) in enumerate(self.arcs(part), 1):
            some = start < rows
            starts.append(start[some])
            sizes.append(np.full(np.count_nonzero(some), k))
            pieces.append(piece[some])
            logs.append(self.logs[piece[some]])
        start, size, piece, log = map(np.concatenate, (starts, sizes, pieces, logs))
        order = np.argsort(start, kind="stable")
        return start[order] + lo, size[order], piece[order], log[order]

    def forward_long(self, codes: np.ndarray) -> array:
        """forward() of one word, arc by arc."""
        f = array("d", repeat(-inf, len(codes) + 1))
        f[0] = 0.0
        for lo in range(0, len(codes), SPAN):
            start, size, _, log = self.span(codes, lo)
            for i, j, w in zip(start.tolist(), (start + size).tolist(), log.tolist(), strict=True):
                if (x := f[i] + w) > -inf:
                    y = f[j]
                    f[j] = x + log1p(exp(y - x)) if x > y else y + log1p(exp(x - y))
        return f

    def expect_long(self, codes: np.ndarray, times: float, into: np.ndarray) -> None:
        """expect() of one word; the arcs are found again on the way back."""
        f = np.frombuffer(self.forward_long(codes))
        b = array("d", repeat(-inf, len(codes) + 1))
        b[-1] = 0.0
        for lo in reversed(range(0, len(codes), SPAN)):
            start, size, piece, log = self.span(codes, lo)
            end = start + size
            for i, j, w in zip(start[::-1].tolist(), end[::-1].tolist(), log[::-1].tolist(), strict=True):
                if (x := b[j] + w) > -inf:
                    y = b[i]
                    b[i] = x + log1p(exp(y - x)) if x > y else y + log1p(exp(x - y))
            share = np.exp(f[start] + log + np.frombuffer(b)[end] - f[-1]) * times
            some = piece >= 0
            into += np.bincount(piece[some], share[some], len(into))
            self.add_spelled(codes[start[~some]], share[~some], into)


def spell(code: int) -> bytes:
    """A code point in UTF-8; the mark inside a word has a code of its own."""
    return chr(MARK if code == HIDDEN else code).encode()


def by_length(words: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places of words of one length, and their characters after the mark, in parts of bounded size."""
    texts = [w.decode() for w in words]
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    order = np.argsort(sizes, kind="stable")
    at = 0
    while at < len(order):
        n = int(sizes[order[at]]) + 1
        end = int(np.searchsorted(sizes[order], n - 1, "right"))
        part = order[at : min(end, at + max(1, CELLS // (n * 16)))]
        codes = np.frombuffer("".join(texts[i] for i in part).encode("utf-32-le"), np.uint32).reshape(len(part), n - 1).astype(np.int64)
        codes[codes == MARK] = HIDDEN
        yield part, np.column_stack([np.full(len(part), MARK), codes])
        at += len(part)


def gathered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches put together until they hold `TOGETHER` bytes: a lattice's steps cost the same for one word as for thousands."""
    held: list[pa.RecordBatch] = []
    size = 0
    for b in batches:
        held.append(b)
        size += b.nbytes
        if size >= TOGETHER:
            yield pa.concat_batches(held)
            held, size = [], 0
    if held:
        yield pa.concat_batches(held)


def text_words(text: str | None) -> list[bytes]:
    """The words of a text with A-Z in lower case: bytes.lower() changes these letters only."""
    return text.encode().lower().split() if text else []


def count_words(docs: DataFrame) -> DataFrame:
    """word, c (in training documents), c_all, from rows of text and train."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept, rest = Counter(), Counter()

        def flush() -> pa.RecordBatch:
            found = [*(kept.keys() | rest.keys())]
            c = [kept[w] for w in found]
            out = pa.RecordBatch.from_arrays([pa.array(found, pa.binary()), pa.array(c, pa.int64()), pa.array([n + rest[w] for w, n in zip(found, c, strict=True)], pa.int64())], names=["word", "c", "c_all"])
            kept.clear()
            rest.clear()
            return out

        for b in batches:
            for text, train in zip(b.column("text"), b.column("train").to_pylist(), strict=True):
                (kept if train else rest).update(text_words(text.as_py()))
                if len(kept) + len(rest) > FLUSH:
                    yield flush()
        yield flush()

    found = docs.select("text", "train").mapInArrow(work, "word binary, c long, c_all long")
    return found.groupBy("word").agg(F.sum("c").alias("c"), F.sum("c_all").alias("c_all"))


def fit(counts: DataFrame, pieces: Pieces, rounds: int = 2) -> Pieces:
    """Rounds of expectation maximisation: each task adds up expected counts of its words, one row for each piece reaches the driver.

    Each distinct training word counts once: the subword paths stand for words that are rare or new.
    """
    spark, n = counts.sparkSession, len(pieces.logs)
    for _ in range(rounds):
        now = spark.sparkContext.broadcast(pieces)  # as large as the vocabulary

        def expect(batches: Iterator[pa.RecordBatch], now=now) -> Iterator[pa.RecordBatch]:
            lattice, into = Lattice(now.value), np.zeros(n)
            for b in gathered(batches):
                for part, codes in by_length(b.column("word").to_pylist()):
                    lattice.expect(codes, np.ones(len(part)), into)
            some = np.flatnonzero(into)
            yield pa.RecordBatch.from_arrays([pa.array(some, pa.int64()), pa.array(into[some])], names=["piece", "n"])

        found = counts.filter("c > 0").select("word").mapInArrow(expect, "piece long, n double").groupBy("piece").agg(F.sum("n").alias("n")).toPandas()
        into = np.zeros(n)
        into[found["piece"].to_numpy(dtype=np.int64)] = found["n"].to_numpy()
        pieces = pieces.refined(into)
        now.unpersist()
    return pieces


def score(docs: DataFrame, vocabulary: str, held_out: Column, rounds: int = 2, one_in: int = 250_000, whole_words: bool = True) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score: log10 probabilities of every whole text.

    Tokens are words in lower case and one end for each text. base_score is the add-one unigram score from
    training counts; score is the lattice model's. Null texts are empty ones: only their end is scored.
    Without `whole_words` only the subword paths count. Every row is scored for itself, repeated rows and null ids too (a null id counts as training).
    An empty table gives no rows; without training documents the vocabulary's own order scores alone.
    """
    spark = docs.sparkSession
    small_batches(spark)
    rows = docs.select("doc_id", "text", F.coalesce(held_out, F.lit(False)).alias("held_out")).withColumn("train", ~F.col("held_out"))
    counts = cut(count_words(rows))
    ends = rows.agg(F.count_if("train")).first()[0]
    c, v, once, twice, c_all = counts.agg(
        F.coalesce(F.sum("c"), F.lit(0)), F.count_if(F.col("c") > 0), F.count_if(F.col("c") == 1), F.count_if(F.col("c") == 2), F.coalesce(F.sum("c_all"), F.lit(0))
    ).first()
    n = c + ends
    below = n + 1 * (v + (ends > 0) + 1)
    discount = min(0.9, max(0.1, once / (once + 2 * twice))) if once else 0.5
    model = fit(counts, Pieces.load(vocabulary), rounds)
    now = spark.sparkContext.broadcast(model)

    def by_word(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lattice = Lattice(now.value)
        for b in gathered(batches):
            paths, seen = np.zeros(b.num_rows), b.column("c").to_numpy()
            for part, codes in by_length(b.column("word").to_pylist()):
                paths[part] = lattice.score(codes)
            if whole_words:
                whole = np.full(b.num_rows, -np.inf)
                np.log((seen - discount) / (n + 1), out=whole, where=seen > 0)
                out = np.logaddexp(whole, paths + np.log((discount * v + 1) / (n + 1))) / np.log(10)
            else:
                out = (paths + np.log((c + 1) / (n + 1))) / np.log(10)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(out)], names=["word", "c", "c_all", "log_p"])

    scored = cut(counts.mapInArrow(by_word, "word binary, c long, c_all long, log_p double"))
    table = scored.select("word", (F.col("c") > 0).cast("long").alias("known"), F.log10((F.col("c") + 1) / F.lit(float(below))).alias("base"), "log_p")
    head = scored.filter(F.col("c_all") * one_in >= c_all).select("word").join(table, "word").toPandas()
    shipped = spark.sparkContext.broadcast((b"".join(head["word"]), head["word"].map(len).to_numpy(np.int32), head[["known", "base", "log_p"]].to_numpy()))

    def per_text(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        joined, sizes, values = shipped.value
        ends_at = np.cumsum(sizes).tolist()
        index = {joined[e - k : e]: i for i, (e, k) in enumerate(zip(ends_at, sizes.tolist(), strict=True))}
        values = np.vstack([values, np.zeros((1, 3))]).astype(float)
        for b in batches:
            key, row, times, tokens, sums, own, at_row = [], [], [], [], [], [], 0
            for r, text in zip(b.column("row").to_pylist(), b.column("text"), strict=True):
                found = text_words(text.as_py())
                at = np.fromiter(map(index.get, found, repeat(-1)), np.int64, len(found))
                rare = Counter(found[i] for i in np.flatnonzero(at < 0).tolist())
                key += [b" %d" % r, *rare]  # no word holds a space; the row's own columns go with this one
                own += [at_row, *repeat(None, len(rare))]
                at_row += 1
                row += [r] * (1 + len(rare))
                times += [0, *rare.values()]
                tokens += [len(found) + 1, *repeat(0, len(rare))]
                sums.append(values[at].sum(axis=0))
                sums += [np.zeros(3)] * len(rare)
            s = np.array(sums).reshape(-1, 3)
            own = pa.array(own, pa.int64())
            columns = [pa.array(key, pa.binary()), pa.array(row, pa.int64()), pa.array(times, pa.int64()), pa.array(tokens, pa.int64()), *(pa.array(s[:, i]) for i in range(3)), *(b.column(c).take(own) for c in ("doc_id", "held_out"))]
            yield pa.RecordBatch.from_arrays(columns, names=["word", "row", "times", "tokens", "known_sum", "base_sum", "log_sum", "doc_id", "held_out"])

    kind = rows.schema["doc_id"].dataType.simpleString()
    numbered = rows.select(F.monotonically_increasing_id().alias("row"), "text", "doc_id", "held_out")
    looked = numbered.mapInArrow(per_text, f"word binary, row long, times long, tokens long, known_sum double, base_sum double, log_sum double, doc_id {kind}, held_out boolean")
    zero = F.lit(0.0)
    summed = looked.join(table, "word", "left").groupBy("row").agg(
        F.max("doc_id").alias("doc_id"), F.max("held_out").alias("held_out"), F.sum("tokens").alias("n_tokens"),
        F.sum(F.col("known_sum") + F.coalesce(F.col("known") * F.col("times"), zero)).alias("known"),
        F.sum(F.col("base_sum") + F.coalesce(F.col("base") * F.col("times"), zero)).alias("base"),
        F.sum(F.col("log_sum") + F.coalesce(F.col("log_p") * F.col("times"), zero)).alias("log_p"),
    )
    end_base, end_score = float(np.log10((ends + 1) / below)), float(np.log10(max(ends, 0.01) / (n + 1)))
    return summed.select(
        "doc_id", "held_out", "n_tokens", (F.round("known").cast("long") + F.lit(int(ends > 0))).alias("n_known"), F.lit(n).cast("long").alias("train_tokens"),
        (F.col("base") + F.lit(end_base)).alias("base_score"), (F.col("log_p") + F.lit(end_score)).alias("score"),
    )


def fold(doc_id: Column) -> Column:
    """True for the documents that the model does not learn from: crc32(doc_id as text) modulo 7 is 2."""
    return bucket(doc_id, 7) == 2
