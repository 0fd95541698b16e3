"""Encoding against the tokenizers library, and the length histogram."""

import hashlib
import random
import struct

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from groundtable.llm import bpe, token_lengths

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def reference():
    return Tokenizer.from_file(PATH)


def ids(packed):
    return np.frombuffer(packed, "<u4").tolist()


def test_encoder_equals_library(reference):
    rng, e = random.Random(1), bpe.Encoder(bpe.Vocabulary(PATH))
    letters = " \n\t\r\x0b\x1c\x85\xa0　ab'stre 12٣é中😀<|endoftext|>.,"
    for k in range(4000):
        x = "".join(rng.choice(letters) for _ in range(rng.randint(0, 14)))
        x = "a" * rng.randint(30, 120) + x if k % 7 == 0 else x + "<|endoftext|>" + x if k % 5 == 0 else x
        found = ids(e.encode(x))
        assert found == reference.encode(x, add_special_tokens=False).ids
        assert e.v.decode(found) == reference.decode(found, skip_special_tokens=False)


def test_transducer(tmp_path):
    entries = {w.encode(): [i, i + 1][: 1 + i % 2] for i, w in enumerate(["", "a", "ab", "abc", "b", "bc", "xabc", "xbc", "é"])}
    data = bpe.Transducer.build(entries)
    path = tmp_path / "lexicon.bin"
    path.write_bytes(data)
    t = bpe.Transducer(str(path))
    for w, i in entries.items():
        assert t.find(w) == struct.pack(f"<{len(i)}I", *i)
    assert [t.find(w) for w in (b"x", b"abcd", b"zz", b"xa")] == [None] * 4
    # shared suffixes: far fewer states than letters
    words = {f"{a}{b}ing".encode(): [1] for a in "abcdefgh" for b in "klmnop"}
    states = struct.unpack_from("<5I", bpe.Transducer.build(words))[2]
    assert states <= 6


def test_frequent_words(spark, monkeypatch):
    monkeypatch.setattr(bpe, "FLUSH", 40)
    rng = random.Random(4)
    texts = [" ".join(rng.choice("abcdefgh") if rng.random() < 0.4 else f"w{int(rng.expovariate(0.01))}," for _ in range(rng.randint(0, 60))) + " \n\n" * (k % 2) for k in range(300)]
    docs = spark.createDataFrame([(t,) for t in [*texts, None, ""]], "text string").repartition(5)
    true = {}
    for t in texts:
        for part in t.replace("\n", " \n").split(" "):
            for w in bpe.pre_tokens(part) or bpe.PATTERN.findall(part):
                true[w.encode()] = true.get(w.encode(), 0) + 1
    total = sum(true.values())
    for one_in in (20, 100, 10**6):
        found = bpe.frequent_words(docs, one_in)
        assert len(found) == len(set(found)) <= 2 * one_in
        assert {w for w, n in true.items() if n * one_in >= total and n > 1} <= set(found) <= {w for w, n in true.items() if 2 * n * one_in >= total}
    assert bpe.word_counts(docs, 20).filter("word IS NULL").first()["n"] == total
    assert bpe.frequent_words(docs.limit(0), 20) == []


def test_operator(spark, stored, odd_rows, reference):
    docs = stored(odd_rows)
    lexicon = bpe.build_lexicon(docs, PATH)
    coded = bpe.encode(docs.withColumn("ids", F.lit("clash")), PATH, lexicon, decode=True)
    assert coded.columns == [*docs.columns, "n_tokens", "ids", "decoded"]
    rows = coded.collect()
    assert len(rows) == len(odd_rows)
    for r in rows:
        expected = reference.encode(r.text or "", add_special_tokens=False).ids
        assert (ids(r.ids), r.n_tokens, r.decoded) == (expected, len(expected), r.text or "")
    one = next(r for r in coded.select("doc_id", F.sha2("ids", 256).alias("h")).collect() if r.doc_id == 4)
    assert one.h == hashlib.sha256(struct.pack("<1I", *reference.encode("one").ids)).hexdigest()
    assert bpe.encode(docs.limit(0), PATH, bpe.build_lexicon(docs.limit(0), PATH)).count() == 0


def test_histogram(spark, stored, odd_rows, reference):
    docs = stored(odd_rows)
    sums = token_lengths.suffix_sums(token_lengths.histogram(bpe.encode(docs, PATH, length_only=True)))
    lengths = [len(reference.encode(t or "", add_special_tokens=False).ids) for t in (r[1] for r in odd_rows)]
    for r in sums.collect():
        longer = [x for x in lengths if x >= r.n_tokens]
        assert (r.n_docs, r.docs_at_least, r.tokens_at_least) == (lengths.count(r.n_tokens), len(longer), sum(longer))
        assert (r.total_docs, r.total_tokens, r.truncated_tokens) == (len(lengths), sum(lengths), sum(min(x, r.n_tokens) for x in lengths))
    asked = [0, 1, 50, 77, 10**6]
    assert {r.context_limit: r.truncated_tokens for r in token_lengths.truncated_totals(sums, asked).collect()} == {a: sum(min(x, a) for x in lengths) for a in asked}
    found = {r.share: r.n_tokens for r in token_lengths.quantiles(sums, [0.1, 0.5, 1.0]).collect()}
    ranked = sorted(lengths)
    assert found == {q: ranked[-(-int(q * 100) * len(ranked) // 100) - 1] for q in (0.1, 0.5, 1.0)}
    assert token_lengths.suffix_sums(spark.createDataFrame([], "n_tokens long, n_docs long")).count() == 0
