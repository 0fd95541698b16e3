"""The lattice by brute force, the base by counting, and sums of probabilities."""

import math
import time
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa

from groundtable.llm import lattice_lm as lm

PATH = public_tokenizers.path("piece_bpe_32k.model")


def test_lattice():
    p = lm.Pieces.load(PATH)
    places = {t: i for i, t in enumerate(p.texts)}
    words = ["the", "x", "日本", "a▁b", "hello,", "!!!###", "😀zz", "internationalization"]

    def brute(word):
        codes = [lm.MARK] + [lm.HIDDEN if ord(c) == lm.MARK else ord(c) for c in word]
        sums = [0.0] + [-math.inf] * len(codes)
        for j in range(1, len(codes) + 1):
            for i in range(max(0, j - 20), j):
                piece = "".join("\0" if c == lm.HIDDEN else chr(c) for c in codes[i:j])
                if piece in places:
                    sums[j] = np.logaddexp(sums[j], sums[i] + p.logs[places[piece]])
                if j - i == 1 and i:
                    sums[j] = np.logaddexp(sums[j], sums[i] + sum(p.logs[len(places) + b] for b in lm.spell(codes[i])))
        return sums[-1]

    lattice = lm.Lattice(p)
    for part, codes in lm.by_length([w.encode() for w in words]):
        for i, s in zip(part, lattice.score(codes), strict=True):
            assert abs(s - brute(words[i])) < 1e-9
    # expected pieces of a word spell it as often as it comes
    into = np.zeros(len(p.logs))
    for _, codes in lm.by_length([b"hello"]):
        lattice.expect(codes, np.ones(1) * 3, into)
    spelled = sum(x * (len(p.texts[i]) if i < len(p.texts) else 1) for i, x in enumerate(into))
    assert abs(spelled - 3 * 6) < 1e-6


def test_long_words(monkeypatch):
    """A long word has the same probability and the same expected pieces however it is taken, and costs what its length says."""
    rng = np.random.default_rng(3)
    lattice = lm.Lattice(lm.Pieces.load(PATH))
    alphabet = np.array([*map(ord, "internatioalz"), 0x65E5, 0x1F600, lm.HIDDEN])
    codes = np.concatenate([[lm.MARK], rng.choice(alphabet, 899)])[None]
    monkeypatch.setattr(lm, "LONG", 10**9)
    whole, into = lattice.score(codes), np.zeros(len(lattice.logs))
    lattice.expect(codes, np.ones(1) * 2, into)
    for span in (1, 7, 100, 899, 900, 5000):
        monkeypatch.setattr(lm, "LONG", 1)
        monkeypatch.setattr(lm, "SPAN", span)
        assert abs(lattice.score(codes)[0] - whole[0]) < 1e-6
        if span > 7:
            again = np.zeros(len(lattice.logs))
            lattice.expect(codes, np.ones(1) * 2, again)
            assert np.allclose(into, again, atol=1e-6)
    monkeypatch.undo()
    begun = time.process_time()
    (_, codes), *_ = lm.by_length([("internationalization" * 10_000).encode()])
    assert codes.shape == (1, 200_001)
    assert np.isfinite(lattice.score(codes)).all()
    assert time.process_time() - begun < 30


def test_gathered(monkeypatch):
    """Every row comes once and in order, however batches are put together, empty ones too."""
    batches = [pa.RecordBatch.from_pydict({"word": pa.array(w, pa.binary())}) for w in ([b"a", b"bb"], [], [b"c" * 50], [b"d"], [b"e", b"f"])]
    for together in (1, 20, 60, 10**9):
        monkeypatch.setattr(lm, "TOGETHER", together)
        found = [*lm.gathered(iter(batches))]
        assert [w for b in found for w in b.column("word").to_pylist()] == [b"a", b"bb", b"c" * 50, b"d", b"e", b"f"]
        assert len(found) == 1 or together < 10**9
    assert not [*lm.gathered(iter([]))]


def test_score(spark, stored, odd_rows):
    docs = stored(odd_rows)
    from pyspark.sql import functions as F

    rows = lm.score(docs, PATH, lm.fold(F.col("doc_id"))).collect()
    assert len(rows) == len(odd_rows)
    counts, parts = Counter(), []
    for i, text, *_ in odd_rows:
        words = (text or "").encode().lower().split() + [None]
        held = i is not None and zlib.crc32(str(i).encode()) % 7 == 2
        parts.append((i, held, words))
        if not held:
            counts.update(words)
    n, v = sum(counts.values()), len(counts)
    expected = sorted((str(i), h, len(w), sum(counts[x] > 0 for x in w), round(sum(math.log10((counts[x] + 1) / (n + v + 1)) for x in w), 4)) for i, h, w in parts)
    assert sorted((str(r.doc_id), r.held_out, r.n_tokens, r.n_known, round(r.base_score, 4)) for r in rows) == expected
    assert {r.train_tokens for r in rows} == {n}
    assert all(r.score < 0 and math.isfinite(r.score) for r in rows)
    seen = sum(10**r.score for r in rows if r.n_tokens == 1) / 3  # the empty text alone
    assert 0 < seen < 1
    assert lm.score(docs.limit(0), PATH, lm.fold(F.col("doc_id"))).count() == 0


def test_score_of_texts(spark, stored):
    """Every text's score from its words by sums over all segmentations, and the same with numbers of rows that no second scan has to repeat."""
    from pyspark.sql import functions as F

    texts = ["the cat sat", "the dog sat down", "zebra zebra the", "", "cats and the dogs", "the cat sat"]
    rows = [(i, t) for i, t in enumerate(texts)]
    docs = stored(rows)
    for whole in (True, False):
        got = {r.doc_id: r for r in lm.score(docs, PATH, F.col("doc_id") == 4, whole_words=whole).collect()}
        counts = Counter(w for i, t in rows if i != 4 for w in t.encode().split())
        c, v, ends = sum(counts.values()), len(counts), len(rows) - 1
        n = c + ends
        ones, twos = (sum(x == k for x in counts.values()) for k in (1, 2))
        discount = min(0.9, max(0.1, ones / (ones + 2 * twos)))
        pieces = lm.fit(spark.createDataFrame([(bytearray(w), k) for w, k in counts.items()], "word binary, c long"), lm.Pieces.load(PATH))
        place = {t: i for i, t in enumerate(pieces.texts)}

        def segmentations(word, pieces=pieces, place=place):
            spelled = chr(lm.MARK) + word

            def paths(i):
                if i == len(spelled):
                    return 1.0
                total = sum(math.exp(pieces.logs[place[spelled[i:j]]]) * paths(j) for j in range(i + 1, len(spelled) + 1) if spelled[i:j] in place)
                return total + (math.exp(sum(pieces.logs[len(place) + b] for b in spelled[i].encode())) * paths(i + 1) if i else 0.0)

            return paths(0)

        for i, t in rows:
            want = math.log10(ends / (n + 1))
            for w in t.split():
                k = counts[w.encode()]
                p = segmentations(w) * (discount * v + 1) / (n + 1) + max(0, k - discount) / (n + 1) * (k > 0) if whole else segmentations(w) * (c + 1) / (n + 1)
                want += math.log10(p)
            assert abs(got[i].score - want) < 1e-6
            assert got[i].held_out == (i == 4)
