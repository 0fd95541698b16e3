import random

import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long, score string, size string, row string, id string"


def as_docs(spark, rows, schema=DOCS):
    """Rows of (doc_id, text[, source]) with the columns of documents and some that clash with added ones."""
    out = [(r[0], r[1], "en", r[2] if len(r) > 2 else "s", len(r[1] or ""), "x", "x", "x", "x") for r in rows]
    return spark.createDataFrame(out, schema)


@pytest.fixture(scope="session")
def stored(spark, tmp_path_factory):
    """Writes rows and reads them back: operators take tables."""

    def store(rows):
        path = str(tmp_path_factory.mktemp("docs") / "documents.parquet")
        as_docs(spark, rows).coalesce(2).write.parquet(path)
        return spark.read.parquet(path)

    return store


@pytest.fixture(scope="session")
def odd_rows():
    """Nulls in every place, empty and blank texts, repeated rows, a very long text, a long word, odd spaces and letters."""
    rng = random.Random(4)
    vocabulary = ["".join(rng.choice("abcdefgh") for _ in range(rng.randint(1, 7))) for _ in range(400)]
    prose = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n))
    long = prose(30_000)
    return [
        (1, None), (2, ""), (3, " \t\n "), (4, "one"), (4, "one"), (5, "same text here again now"), (6, "same text here again now"), (7, long), (8, "x" * 30_000), (9, "tab\tand\x0bfeed\x0cand\r\nline\x1cend\x85stop　wide"),
        (10, "日本語 ▁ 😀 <|endoftext|> é"), (None, prose(80)), (None, None), *((i, prose(60 + i) + "\n" + prose(12), "s%d" % (i % 3)) for i in range(11, 40)), (40, long + " tail"),
        (41, "A B C d"), (42, prose(70), None), (43, prose(9), ""),
    ]
