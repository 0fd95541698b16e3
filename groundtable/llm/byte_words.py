"""Words and lines of a batch of texts, found in the texts' own bytes: no Python object for each word."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash

from groundtable.llm.common import mix

#: Bytes of a word that are hashed at once; words longer than LONG bytes are hashed by another function.
LANE, LONG = 8, 4096
MASKS = np.array([(1 << (8 * k)) - 1 for k in range(LANE + 1)], dtype=np.uint64)
ODD = np.uint64(0xD6E8FEB86659FD93)


@dataclass
class Words:
    """`data`: the texts' bytes and LANE more. `offsets`: where each text starts, and the end. `start`, `end`: of each word."""

    data: np.ndarray
    offsets: np.ndarray
    start: np.ndarray
    end: np.ndarray

    def first(self) -> np.ndarray:
        """Each text's first word, and the number of words."""
        return np.searchsorted(self.start, self.offsets)

    def hashes(self, lo: int = 0, hi: int | None = None) -> np.ndarray:
        """64-bit hashes of the words from lo to hi; they depend on a word's bytes alone."""
        start, size = self.start[lo:hi], self.end[lo:hi] - self.start[lo:hi]
        lanes = np.ndarray((len(self.data) - LANE + 1,), dtype="<u8", buffer=self.data, strides=(1,))
        h = (lanes[start] & MASKS[np.minimum(size, LANE)]) ^ size.astype(np.uint64) * ODD
        longer, at = np.flatnonzero((size > LANE) & (size <= LONG)), LANE
        while len(longer):
            h[longer] = mix(h[longer]) * ODD + (lanes[start[longer] + at] & MASKS[np.minimum(size[longer] - at, LANE)])
            at += LANE
            longer = longer[size[longer] > at]
        for i in np.flatnonzero(size > LONG):
            h[i] = xxhash.xxh3_64_intdigest(self.data[start[i] : start[i] + size[i]].tobytes())
        return mix(mix(h))

    def lines(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Of each line (texts are cut at \\n): its text, its number there from 0, its first word; the last has one more entry."""
        at = np.flatnonzero(self.data[: self.offsets[-1]] == 10)
        texts = len(self.offsets) - 1
        held = np.bincount(np.searchsorted(self.offsets, at, "right") - 1, minlength=texts) + 1
        firsts = np.cumsum(held) - held
        begins = np.empty(int(held.sum()), dtype=np.int64)
        rest = np.ones(len(begins), dtype=bool)
        rest[firsts] = False
        begins[firsts], begins[rest] = self.offsets[:-1], at + 1
        text = np.repeat(np.arange(texts), held)
        return text, np.arange(len(begins)) - firsts[text], np.append(np.searchsorted(self.start, begins), len(self.start))


def find_words(texts: pa.Array, lower: bool = False) -> Words:
    """The words `[^\\x20\\x09-\\x0D]+` of each text; a null text has none. `lower` puts A-Z in lower case."""
    if texts.null_count:
        texts = texts.fill_null("")
    n = len(texts)
    if not n:
        return Words(np.zeros(LANE, np.uint8), np.zeros(1, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64))
    _, places, held = texts.buffers()
    kind = np.int64 if pa.types.is_large_string(texts.type) else np.int32
    offsets = np.frombuffer(places, kind)[texts.offset : texts.offset + n + 1].astype(np.int64)
    size = int(offsets[-1] - offsets[0])
    data = np.zeros(size + LANE, dtype=np.uint8)
    if size:
        data[:size] = np.frombuffer(held, np.uint8)[offsets[0] : offsets[-1]]
    offsets -= offsets[0]
    if lower:
        data += ((data - np.uint8(65)) < 26).view(np.uint8) << np.uint8(5)
    inside = (data != 32) & ((data - np.uint8(9)) > 4)
    inside[size:] = False
    begins, ends = inside.copy(), inside.copy()
    begins[1:] &= ~inside[:-1]
    ends[:-1] &= ~inside[1:]
    some = np.flatnonzero(offsets[1:] > offsets[:-1])  # words do not cross from one text into the next
    begins[offsets[some]] |= inside[offsets[some]]
    ends[offsets[some + 1] - 1] |= inside[offsets[some + 1] - 1]
    return Words(data, offsets, np.flatnonzero(begins), np.flatnonzero(ends) + 1)
