"""From raw documents to a mixed, encoded corpus: five stages over the table `documents`.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; run() writes it as Parquet to the folder that
the cluster shares and reads it again for the next. All stages but the last return the columns of documents, each
with the caller's values, also where a stage has a column of that name for itself.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from groundtable.llm import bpe, line_dedup, mixing, ngram_join, quality_mil
from groundtable.llm.common import fresh, quoted, set_aside
from groundtable.llm.queries import TOKENIZER
from groundtable.session import shared_dir, table


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier predicts good."""
    rows, back = set_aside(docs, ("score", "held_out", "predicted"))
    return back(quality_mil.score(rows, table(spark, sf_dir, "labels")).filter("predicted = 1").select(*quoted(rows.columns)))


def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the lines that an earlier line is alike to; every document stays."""
    return line_dedup.deduplicate(docs, least=1)


def keep_one(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near copies."""
    return ngram_join.keep_one(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them."""
    rows, back = set_aside(docs, mixing.ADDED)
    mixed, (copy,) = mixing.mix(rows).filter("taken > 0"), fresh(rows, "copy")
    return back(mixed.withColumn(copy, F.explode(F.sequence(F.lit(1).cast("long"), F.expr("taken div size")))).select(*quoted(rows.columns)))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, lang, source, n_tokens and ids (packed little-endian unsigned 32-bit) of every document of the mix."""
    return bpe.encode(docs, TOKENIZER, bpe.build_lexicon(docs, TOKENIZER)).select("doc_id", "lang", "source", "n_tokens", "ids")


STAGES = [
    ("quality_classifier", keep_good),
    ("line_dedup", drop_lines),
    ("ngram_jaccard_join", keep_one),
    ("mixing", mix),
    ("bpe", encode),
]
#: SQL can express neither a trained network nor the encoder.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages one after another over sf_dir's documents."""
    docs, folder = table(spark, sf_dir, "documents"), f"{shared_dir(spark)}/pipeline-{uuid.uuid4()}"
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return docs
