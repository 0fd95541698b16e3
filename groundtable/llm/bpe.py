"""Byte-level BPE through a lexicon: encoding and decoding of whole texts.

Frequent words are found over the whole corpus, merged once on the driver and compiled into a minimal
acyclic transducer: words that end alike share states, the numbers on the transitions passed add up to
the word's place in a table of id sequences. The file is shipped to the executors and memory-mapped
there. Words that it lacks are merged exactly, so the ids are those of the vocabulary's own tokenizer
whatever the lexicon holds.

Every word that makes up at least one in `one_in` of all words is in the lexicon, none that makes up less
than one in twice `one_in`, so there are at most twice `one_in` of them however large the corpus. All texts
are counted, a share at a time: a share passes on the words that make up one in twice `one_in` of its own, so
of a word's count less than one in twice `one_in` of all words is missing, and what is shuffled stays small.
"""

from __future__ import annotations

import heapq
import json
import mmap
import os
import struct
import tempfile
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark import SparkFiles
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from groundtable.llm.common import FLUSH, Cache, append_columns, small_batches, tidy
from groundtable.session import cut

#: White space of the pre-tokenizer: Unicode's White_Space (fixed values).
SPACES = "\u0009-\u000d \u0085   -     　"
#: The pre-tokenizer's pattern (fixed value), with its white space spelled out.
PATTERN = regex.compile(
    rf"'s|'t|'re|'ve|'m|'ll|'d| ?\p{{L}}+| ?\p{{N}}+| ?[^{SPACES}\p{{L}}\p{{N}}]+|[{SPACES}]+(?![^{SPACES}])|[{SPACES}]+"
)
SPACE_CHARS = frozenset(c for c in map(chr, range(0x3001)) if regex.match(f"[{SPACES}]", c))
#: Marks that end a pre-token of letters and are one themselves.
STOPS = frozenset(".,;:!?")
#: The first character after the Latin letters of old.
LATIN_END = "\u0250"
#: Bytes of words that are merged together; parts of texts whose ids are held, twice over.
TOGETHER, HELD = 40, 50_000
TWO = struct.Struct("<2I")
BYTES = [bytes((b,)) for b in range(256)]


def byte_letters() -> dict[str, int]:
    """The printable letter that stands for each byte in the vocabulary file, by letter."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    other = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(other)}


class Vocabulary:
    """Pieces, merges and special tokens of a byte-level BPE file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        letters = byte_letters()
        raw = {piece: bytes(letters[c] for c in piece) for piece in spec["model"]["vocab"]}
        ids = {raw[piece]: i for piece, i in spec["model"]["vocab"].items()}
        self.byte_ids = [ids[bytes([b])] for b in range(256)]
        self.merges = {}
        for rank, (a, b) in enumerate(spec["model"]["merges"]):
            self.merges[ids[raw[a]], ids[raw[b]]] = (rank, ids[raw[a] + raw[b]])
        self.none = (len(self.merges), -1)
        self.pairs = None
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.pieces = [b""] * (1 + max([*ids.values(), *self.special.values()]))
        for piece, i in ids.items():
            self.pieces[i] = piece
        for piece, i in self.special.items():
            self.pieces[i] = piece.encode()

    def merge(self, word: bytes) -> list[int]:
        """Ids of one pre-token by the merge rules."""
        ids = [self.byte_ids[b] for b in word]
        return self._merge_long(ids) if len(ids) > 40 else self._merge_short(ids)

    def _merge_short(self, ids: list[int]) -> list[int]:
        """The least of the adjacent pairs' ranks is merged, the leftmost of equal ones first, until no pair has a rank."""
        get, none = self.merges.get, self.none
        ranks = [get(p, none)[0] for p in zip(ids, ids[1:], strict=False)]
        while ranks and (best := min(ranks)) < none[0]:
            at = ranks.index(best)
            ids[at] = get((ids[at], ids[at + 1]))[1]
            del ids[at + 1], ranks[at]
            if at < len(ranks):
                ranks[at] = get((ids[at], ids[at + 1]), none)[0]
            if at:
                ranks[at - 1] = get((ids[at - 1], ids[at]), none)[0]
        return ids

    def _merge_long(self, ids: list[int]) -> list[int]:
        """The same by a heap of adjacent pairs over a linked list: n log n for words of any length."""
        n, merges = len(ids), self.merges
        after, before, alive = [*range(1, n), -1], [*range(-1, n - 1)], [True] * n
        heap = [(merges[p][0], i, *p) for i, p in enumerate(zip(ids, ids[1:], strict=False)) if p in merges]
        heapq.heapify(heap)
        while heap:
            _, i, a, b = heapq.heappop(heap)
            j = after[i] if alive[i] else -1
            if j < 0 or ids[i] != a or ids[j] != b:
                continue
            ids[i], alive[j], after[i] = merges[a, b][1], False, after[j]
            if after[j] >= 0:
                before[after[j]] = i
            for left in (before[i], i):
                right = after[left] if left >= 0 else -1
                if right >= 0 and (p := (ids[left], ids[right])) in merges:
                    heapq.heappush(heap, (merges[p][0], left, *p))
        return [x for x, on in zip(ids, alive, strict=True) if on]

    def decode(self, ids: list[int]) -> str:
        return b"".join(map(self.pieces.__getitem__, ids)).decode("utf-8", "replace")

    def pair_table(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The pairs that merge as sorted numbers, their ranks and their ids."""
        key = np.array([a << 32 | b for a, b in self.merges], dtype=np.int64)
        rank, to = np.array(list(self.merges.values()), dtype=np.int64).reshape(-1, 2).T
        order = np.argsort(key)
        return key[order], rank[order], to[order]

    def merge_all(self, words: list[bytes]) -> list[bytes]:
        """merge() of many words, packed: words of about one length are merged in step, each by its own least pair."""
        if self.pairs is None:
            self.pairs = self.pair_table()
        out: list[bytes] = [b""] * len(words)
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        for i in np.flatnonzero(sizes > TOGETHER):
            out[i] = np.array(self.merge(words[i]), dtype="<u4").tobytes()
        order = np.argsort(sizes, kind="stable")
        order = order[(sizes[order] > 0) & (sizes[order] <= TOGETHER)]
        for lo in range(0, len(order), 4096):
            part = order[lo : lo + 4096]
            for i, ids in zip(part.tolist(), self._in_step([words[i] for i in part], sizes[part]), strict=True):
                out[i] = ids
        return out

    def _ranks(self, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ranks of pairs (a number above all for none) and the ids they merge into."""
        keys, rank, to = self.pairs
        key = a << 32 | b
        at = np.minimum(np.searchsorted(keys, key), len(keys) - 1)
        none = keys[at] != key
        return np.where(none, self.none[0], rank[at]), to[at]

    def _in_step(self, words: list[bytes], sizes: np.ndarray) -> Iterator[bytes]:
        width = int(sizes.max())
        raw = np.frombuffer(b"".join(w.ljust(width, b"\0") for w in words), np.uint8).reshape(-1, width)
        ids = np.array(self.byte_ids, dtype=np.int64)[raw]
        ids[np.arange(width) >= sizes[:, None]] = -1
        ranks, into = self._ranks(ids[:, :-1], ids[:, 1:]) if width > 1 else (np.zeros((len(words), 0), np.int64),) * 2
        done, live = ids.astype("<u4"), np.arange(len(words))
        left = sizes.copy()
        while len(live) and ranks.shape[1]:
            at = ranks.argmin(axis=1)  # the leftmost of equal ones
            row = np.arange(len(live))
            on = ranks[row, at] < self.none[0]
            if not on.all():
                stop = ~on
                done[live[stop], : ids.shape[1]] = ids[stop]
                live, ids, ranks, into, at = live[on], ids[on], ranks[on], into[on], at[on]
                row = np.arange(len(live))
                if not len(live):
                    break
            ids[row, at] = into[row, at]
            left[live] -= 1
            width = ids.shape[1] - 1
            ids = np.take_along_axis(ids, np.arange(width) + (np.arange(width) > at[:, None]), axis=1)
            shift = np.arange(width - 1) + (np.arange(width - 1) >= at[:, None])
            ranks, into = np.take_along_axis(ranks, shift, axis=1), np.take_along_axis(into, shift, axis=1)
            for first in (at - 1, at):  # the two pairs that the new piece is in
                some = np.flatnonzero((first >= 0) & (first < width - 1))
                ranks[some, first[some]], into[some, first[some]] = self._ranks(ids[some, first[some]], ids[some, first[some] + 1])
        if len(live):
            done[live, : ids.shape[1]] = ids
        return (r[:n].tobytes() for r, n in zip(done, left.tolist(), strict=True))


class Transducer:
    """A minimal acyclic automaton over bytes whose paths add up to the number of a word.

    File: five counts; the id table's offsets and ids; for each state the place of its first transition,
    whether a word ends there; for each transition its target and the number it adds; the labels.
    """

    @staticmethod
    def build(entries: dict[bytes, list[int]]) -> bytes:
        """Words are added in order; the states that the next word no longer shares are replaced by an equal one, if there is one."""
        states: dict[tuple, int] = {}
        reached: list[int] = []  # words from a state on
        content: list[tuple] = []

        def settle(node: list) -> int:
            key = (node[0], tuple(node[1]))
            if key not in states:
                states[key] = len(content)
                content.append(key)
                reached.append(node[0] + sum(reached[t] for _, t in node[1]))
            return states[key]

        open_nodes: list[list] = [[0, []]]  # ends here, settled transitions
        letters: list[int] = []
        order = sorted(entries)
        for w in order:
            k = next((i for i, (a, b) in enumerate(zip(w, letters, strict=False)) if a != b), min(len(w), len(letters)))
            while len(letters) > k:
                done = open_nodes.pop()
                open_nodes[-1][1].append((letters.pop(), settle(done)))
            for b in w[k:]:
                letters.append(b)
                open_nodes.append([0, []])
            open_nodes[-1][0] = 1
        while letters:
            done = open_nodes.pop()
            open_nodes[-1][1].append((letters.pop(), settle(done)))
        root = settle(open_nodes[0])
        first, final, arcs, labels = [0], [], [], bytearray()
        for ends, out in content:
            at = ends
            for b, t in out:
                labels.append(b)
                arcs += [t, at]
                at += reached[t]
            first.append(len(labels))
            final.append(ends)
        offsets = np.cumsum([0, *(len(entries[w]) for w in order)])
        ids = [i for w in order for i in entries[w]]
        parts = [offsets, ids, first, final, arcs]
        head = struct.pack("<5I", len(order), len(ids), len(content), len(labels), root)
        return head + b"".join(np.asarray(p, dtype="<u4").tobytes() for p in parts) + bytes(labels)

    def __init__(self, path: str):
        with open(path, "rb") as f:
            self.map = mmap.mmap(f.fileno(), 0, access=mmap.ACCESS_READ)
        words, ids, states, arcs, self.root = struct.unpack_from("<5I", self.map, 0)
        self.offsets = 20
        self.ids = self.offsets + 4 * (words + 1)
        self.first = self.ids + 4 * ids
        self.final = self.first + 4 * (states + 1)
        self.arcs = self.final + 4 * states
        self.labels = self.arcs + 8 * arcs
        self.keys = None

    def find(self, word: bytes) -> bytes | None:
        """The ids of a word, packed, or None."""
        m, state, number, two = self.map, self.root, 0, TWO.unpack_from
        first, arcs, labels = self.first, self.arcs, self.labels
        for b in word:
            lo, hi = two(m, first + 4 * state)
            at = m.find(BYTES[b], labels + lo, labels + hi)
            if at < 0:
                return None
            state, add = two(m, arcs + 8 * (at - labels))
            number += add
        if m[self.final + 4 * state] == 0:
            return None
        lo, hi = two(m, self.offsets + 4 * number)
        return m[self.ids + 4 * lo : self.ids + 4 * hi]

    def find_all(self, words: list[bytes]) -> list[bytes | None]:
        """find() of many words, a byte of each at a time."""
        if self.keys is None:
            first = np.frombuffer(self.map, "<u4", (self.final - self.first) // 4, self.first).astype(np.int64)
            labels = np.frombuffer(self.map, np.uint8, int(first[-1]), self.labels)
            self.keys = np.repeat(np.arange(len(first) - 1), np.diff(first)) << 8 | labels
        arcs = np.frombuffer(self.map, "<u4", 2 * len(self.keys), self.arcs).reshape(-1, 2)
        final = np.frombuffer(self.map, "<u4", (self.arcs - self.final) // 4, self.final)
        size = np.fromiter(map(len, words), np.int64, len(words))
        start, data = np.cumsum(size) - size, np.frombuffer(b"".join(words), np.uint8)
        state, number = np.full(len(words), self.root, dtype=np.int64), np.zeros(len(words), dtype=np.int64)
        on, step = np.flatnonzero(size > 0), 0
        while len(on) and len(self.keys):
            key = state[on] << 8 | data[start[on] + step]
            at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            there = self.keys[at] == key
            state[on[~there]] = -1
            on, at = on[there], at[there]
            state[on], number[on] = arcs[at, 0], number[on] + arcs[at, 1]
            step += 1
            on = on[size[on] > step]
        if not len(self.keys):
            state[size > 0] = -1
        state[state >= 0] = np.where(final[state[state >= 0]] > 0, state[state >= 0], -1)
        offsets = np.frombuffer(self.map, "<u4", (self.ids - self.offsets) // 4, self.offsets)
        return [None if s < 0 else self.map[self.ids + 4 * int(offsets[n]) : self.ids + 4 * int(offsets[n + 1])] for s, n in zip(state.tolist(), number.tolist(), strict=True)]


def cut_up(text: str) -> list[str] | None:
    """A text's parts, each of which is encoded alone: what follows a space, and what follows a newline, with the newline. None if white space meets
    white space in a way that pre-tokens would tell. The first part stands for itself."""
    if "\n\n\n" in text or "\n\n " in text or text.endswith("\n\n"):
        return None
    return text.replace("\n", " \n").split(" ")


def pre_tokens(part: str) -> list[str] | None:
    """Pre-tokens of a part that is not the first; None if it begins or ends with other white space, or is empty.

    They are PATTERN's, which need no search for plain letters (ASCII or Latin) with a stop at most.
    """
    if part.isalpha() and (part.isascii() or max(part) < LATIN_END):
        return [" " + part]
    if part == "\n":
        return ["\n"]
    first, space, head = (part[1:], "", ["\n"]) if part[:1] == "\n" else (part, " ", [])
    if not first or first[0] in SPACE_CHARS or first[-1] in SPACE_CHARS:
        return None
    if first.isascii() or max(first) < LATIN_END:
        if first.isalpha():
            return [*head, space + first]
        if first[-1] in STOPS and first[:-1].isalpha():
            return [*head, space + first[:-1], first[-1]]
    return head + PATTERN.findall(space + first)


class Encoder:
    """Texts to packed ids (little-endian unsigned 32-bit).

    A text is cut at its spaces and newlines. The parts are encoded once for a batch, the unknown ones together, and
    held for later batches in bounded memory.
    """

    def __init__(self, vocabulary: Vocabulary, lexicon: Transducer | None = None):
        self.v, self.lexicon = vocabulary, lexicon
        self.tokens = Cache(self.word)
        self.now, self.old = {}, {}
        self.special = regex.compile("|".join(map(regex.escape, sorted(vocabulary.special, key=len, reverse=True)))) if vocabulary.special else None

    def forget(self) -> None:
        """Drops what is held of texts; the vocabulary stays."""
        self.now, self.old, self.tokens = {}, {}, Cache(self.word)

    def word(self, token: str) -> bytes:
        raw = token.encode()
        found = self.lexicon.find(raw) if self.lexicon else None
        return np.array(self.v.merge(raw), dtype="<u4").tobytes() if found is None else found

    def words(self, tokens: list[str]) -> list[bytes]:
        """word() of many: the lexicon's ids, and merges for those it lacks."""
        raw = [t.encode() for t in tokens]
        out = self.lexicon.find_all(raw) if self.lexicon else [None] * len(raw)
        rest = [i for i, x in enumerate(out) if x is None]
        for i, ids in zip(rest, self.v.merge_all([raw[i] for i in rest]), strict=True):
            out[i] = ids
        return out

    def split(self, text: str) -> bytes:
        return b"".join(map(self.tokens.__getitem__, PATTERN.findall(text)))

    def know(self, parts: set[str]) -> dict[str, bytes | None]:
        """The ids of parts; None for those without pre-tokens of their own."""
        if len(self.now) > HELD:
            self.now, self.old = {}, self.now
        parts = parts - self.now.keys()
        for p in parts & self.old.keys():
            self.now[p] = self.old[p]
        found = {p: pre_tokens(p) for p in parts - self.old.keys()}
        tokens = list({t for x in found.values() if x for t in x})
        ids = dict(zip(tokens, self.words(tokens), strict=True))
        for p, x in found.items():
            self.now[p] = None if x is None else ids[x[0]] if len(x) == 1 else b"".join(map(ids.__getitem__, x))
        return self.now

    def encode_all(self, texts: list[str | None]) -> list[bytes]:
        plain, parts = {}, set()
        for i, t in enumerate(texts):
            if t and not any(s in t for s in self.v.special) and (found := cut_up(t)):
                first = found[0]
                if not first or not (first[0] in SPACE_CHARS or first[-1] in SPACE_CHARS):
                    plain[i] = (first, found[1:])
                    parts.update(plain[i][1])
        known = self.know(parts)
        out = [b""] * len(texts)
        for i, t in enumerate(texts):
            if i in plain:
                first, rest = plain[i]
                found = list(map(known.__getitem__, rest))
                out[i] = self.split(t) if None in found else self.split(first) + b"".join(found)
            elif t:
                out[i] = self.encode(t)
        return out

    def encode(self, text: str | None) -> bytes:
        """One text, special tokens recognised."""
        if not text:
            return b""
        if not self.special or not self.special.search(text):
            return self.split(text)
        out, at = [], 0
        for m in self.special.finditer(text):
            out += [self.encode(text[at : m.start()]), struct.pack("<I", self.v.special[m[0]])]
            at = m.end()
        return b"".join([*out, self.encode(text[at:])])


@lru_cache(maxsize=1)
def kept_encoder(vocabulary: str, lexicon: str | None) -> Encoder:
    """The encoder of a worker process: the vocabulary is read once, not for each task."""
    return Encoder(Vocabulary(vocabulary), Transducer(lexicon) if lexicon else None)


def word_counts(docs: DataFrame, one_in: int) -> DataFrame:
    """word binary, n long: how often pre-tokens come in the shares of all whole texts in which they are one in `one_in` or more; the null word has the number of all.

    A text's first word counts as if a space came before it. A word's n falls short of its true count by less than one in `one_in` of all words.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts: Counter = Counter()

        def flush() -> pa.RecordBatch:
            found: Counter = Counter()
            for part, n in parts.items():
                for token in pre_tokens(part) or PATTERN.findall(part):
                    found[token] += n
            parts.clear()
            total = found.total()
            some = [(w.encode(), n) for w, n in found.items() if n * one_in >= total]
            return pa.RecordBatch.from_arrays([pa.array([None, *(w for w, _ in some)], pa.binary()), pa.array([total, *(n for _, n in some)], pa.int64())], names=["word", "n"])

        for b in batches:
            for text in b.column(0):
                if text := text.as_py():
                    parts.update(text.replace("\n", " \n").split(" "))
                    if len(parts) > FLUSH:
                        yield flush()
        yield flush()

    return docs.select("text").mapInArrow(tidy(work), "word binary, n long").groupBy("word").agg(F.sum("n").alias("n"))


def frequent_words(docs: DataFrame, one_in: int) -> list[bytes]:
    """The words that come more than once and make up one in `one_in` of all, and some more, none below half that."""
    counts = cut(word_counts(docs, 2 * one_in))
    total = counts.filter("word IS NULL").agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    return [bytes(r.word) for r in counts.filter(F.col("word").isNotNull() & (F.col("n") * 2 * one_in >= total) & (F.col("n") > 1)).select("word").collect()]


def build_lexicon(docs: DataFrame, tokenizer: str, one_in: int = 100_000) -> str:
    """Compiles the corpus's frequent words and ships file and vocabulary to the executors; returns the file's name there."""
    small_batches(docs.sparkSession)
    frequent = frequent_words(docs, one_in)
    v = Vocabulary(tokenizer)
    f, path = tempfile.mkstemp(prefix="lexicon-", suffix=".bin")
    with os.fdopen(f, "wb") as out:
        out.write(Transducer.build({w: v.merge(w) for w in frequent}))
    docs.sparkSession.sparkContext.addFile(path)
    return os.path.basename(path)


def encode(docs: DataFrame, tokenizer: str, lexicon: str | None = None, decode: bool = False, length_only: bool = False) -> DataFrame:
    """`docs` with n_tokens long, ids binary (packed little-endian unsigned 32-bit) and, if asked, decoded string.

    Null and empty texts give no ids and decode to an empty text. Special tokens in a text are recognised.
    Every other column is kept; one named like an added column is replaced. Rows are neither merged nor
    reordered, so repeated rows give repeated results. An empty table gives an empty table.
    """
    docs.sparkSession.sparkContext.addFile(tokenizer)
    name = os.path.basename(tokenizer)
    added = {"n_tokens": T.LongType()} | ({} if length_only else {"ids": T.BinaryType()}) | ({"decoded": T.StringType()} if decode else {})

    def make():
        encoder = kept_encoder(SparkFiles.get(name), SparkFiles.get(lexicon) if lexicon else None)

        def each(b: pa.RecordBatch) -> list:
            packed = encoder.encode_all(b.column("text").to_pylist())
            out = [pa.array([len(x) // 4 for x in packed], pa.int64())]
            if not length_only:
                out.append(pa.array(packed, pa.binary()))
            if decode:
                out.append(pa.array([encoder.v.decode(np.frombuffer(x, "<u4").tolist()) for x in packed], pa.string()))
            return out

        each.forget = encoder.forget
        return each

    return append_columns(docs, added, make)
