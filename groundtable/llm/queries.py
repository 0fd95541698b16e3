"""One query for each operator, over its whole table, and the SQL that gives the same rows where SQL can."""

from __future__ import annotations

from zlib import crc32

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from groundtable.llm import ann, bpe, dual_tree, lattice_lm, line_dedup, mixing, ngram_join, periodic_runs, quality_mil, quality_rules, sharding, token_lengths, toxicity_fm
from groundtable.session import cut, table

#: The vocabulary file of the encoding queries.
TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
#: The subword vocabulary of the language model.
PIECES = public_tokenizers.path("piece_bpe_32k.model")


def op1_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest found for every twentieth vector."""
    return ann.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0).select("query_id", "rank", "vec_id", "score")


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts, base and the learnt list's verdict for every document."""
    kept = quality_rules.apply(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "labels"))
    return kept.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op3_lattice_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log10 probability of every text, beside the add-one unigram's."""
    return lattice_lm.score(table(spark, sf_dir, "documents"), PIECES, lattice_lm.fold(F.col("doc_id")))


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The lines that go from every document."""
    return line_dedup.report(table(spark, sf_dir, "documents").select("doc_id", "text"), least=1)


def op5_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Encodes and decodes every text; digests of ids and of the decoded text."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    coded = bpe.encode(docs, TOKENIZER, bpe.build_lexicon(docs, TOKENIZER), decode=True)
    return coded.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))


def op6_toxicity_fm(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every text."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return toxicity_fm.score(docs, table(spark, sf_dir, "labels")).select("doc_id", "held_out", "score", "predicted")


def op7_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Copies, class and number of links of every document."""
    return ngram_join.join(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Totals, quantile ranks and truncated totals for every length that occurs."""
    docs = table(spark, sf_dir, "documents").select("text")
    coded = bpe.encode(docs, TOKENIZER, length_only=True)
    return token_lengths.suffix_sums(cut(token_lengths.histogram(coded)))


def op9_quality_mil(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of every text."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return quality_mil.score(docs, table(spark, sf_dir, "labels")).select("doc_id", "held_out", "score", "predicted")


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the mix takes of every document."""
    sized = table(spark, sf_dir, "documents").select("doc_id", "source", mixing.size_in_words(F.col("text")).alias("size"), F.xxhash64("text").alias("tie"))
    return mixing.mix_sizes(cut(sized), tie=F.col("tie")).select("doc_id", "size", "source_size", "target", "taken")


def with_tail(key: int | None, words: list[bytes]) -> list[bytes]:
    """The words of a tenth of the documents, by crc32 of the id, with a tail that repeats; others, and those without an id, as they are."""
    h = crc32(b"%d" % key) if key is not None else 1
    if h % 10 or not words:
        return words
    n, g = len(words), h // 10
    a = g % n
    period = words[a : a + 1 + (n - a) // (3 + g % 8)]
    return words[:a] + (period * (1 + (n - a) // len(period)))[: n - a]


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs of every document: how many, the longest, and digests of all of them and of the text without their repeats."""
    found = periodic_runs.detect(table(spark, sf_dir, "documents").select("doc_id", "text"), drop=("text",), change=with_tail)
    longest = F.array_max(F.transform("runs", lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("start"), (-r["period"]).alias("period"))))
    listed = F.array_join(F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"])), "\n")
    return found.withColumn("longest", longest).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), (-F.col("longest.start")).alias("start"), F.col("longest.length").alias("length"), (-F.col("longest.period")).alias("period"),
        F.expr("1000 * longest.length div -longest.period").alias("exponent_milli"), F.sha2(F.when(F.size("runs") > 0, F.concat(listed, F.lit("\n"))).otherwise("").cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )


def op12_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shard and place of every document; shards of nearly equal bytes."""
    placed = sharding.assign(table(spark, sf_dir, "documents"), 24)
    return placed.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op13_dual_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cluster of every vector after three rounds."""
    return dual_tree.report(table(spark, sf_dir, "embeddings"))


QUERIES = {"op1_ann": op1_ann, "op2_quality_rules": op2_quality_rules, "op3_lattice_lm": op3_lattice_lm, "op4_line_dedup": op4_line_dedup, "op5_bpe": op5_bpe, "op6_toxicity_fm": op6_toxicity_fm, "op7_ngram_join": op7_ngram_join, "op8_token_counts": op8_token_counts, "op9_quality_mil": op9_quality_mil, "op10_mixing": op10_mixing, "op11_periodic_runs": op11_periodic_runs, "op12_sharding": op12_sharding, "op13_dual_tree": op13_dual_tree}
#: Steps of crc32 by table, as text has no such function there; sums of sizes in the order of digest and id.
SHARDS_SQL = """
WITH RECURSIVE bits(n, k, v) AS (SELECT n, 0, n FROM range(256) t(n) UNION ALL SELECT n, k + 1, CASE WHEN v % 2 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END FROM bits WHERE k < 8),
steps AS (SELECT list(v ORDER BY n) AS step FROM bits WHERE k = 8),
d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS code, md5(coalesce(text, '')) AS digest FROM documents),
sums AS (SELECT digest, xor(4294967295, list_reduce(list_prepend(4294967295, list_transform(range(len(code) // 2), lambda i: CAST('0x' || substr(code, CAST(2 * i + 1 AS BIGINT), 2) AS BIGINT))),
  lambda a, b: xor(a >> 8, step[1 + (xor(a, b) & 255)]))) AS text_crc32 FROM (SELECT DISTINCT digest, code FROM d), steps),
sized AS (SELECT doc_id, digest, len(code) // 2 + 8 AS size FROM d),
summed AS (SELECT *, sum(size) OVER (ORDER BY digest, doc_id NULLS FIRST ROWS UNBOUNDED PRECEDING) AS upto, sum(size) OVER () AS total, row_number() OVER (ORDER BY digest, doc_id NULLS FIRST) AS nth FROM sized),
cut AS (SELECT *, CAST((2 * upto - size) * 24 // (2 * total) AS INTEGER) AS shard FROM summed)
SELECT doc_id, CAST(size AS BIGINT) AS size, CAST(text_crc32 AS BIGINT) AS text_crc32, 'bytes' AS law, shard, nth - min(nth) OVER (PARTITION BY shard) AS slot, CAST(NULL AS INTEGER) AS grown_shard
FROM cut JOIN sums USING (digest)"""


def clusters_sql(rounds: int = 3) -> str:
    """Lloyd's rounds as one common table each: c<n> the centroids, a<n> what is nearest to them."""
    parts = [
        """kept AS (SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: floor(64 * CAST(x AS DOUBLE))) AS v FROM embeddings
  WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0)""",
        "c0 AS (SELECT row_number() OVER (ORDER BY sha256('1:' || vec_id), v) - 1 AS c, v FROM kept QUALIFY c < 16)",
    ]
    for n in range(rounds + 1):
        distance = "CAST(list_inner_product(k.v, k.v) - 2 * list_inner_product(k.v, m.v) + list_inner_product(m.v, m.v) AS BIGINT)"
        parts.append(f"a{n} AS (SELECT r, any_value(vec_id) AS vec_id, any_value(v) AS v, min(near) AS near FROM (SELECT k.r, k.vec_id, k.v, {{'d': {distance}, 'c': m.c}} AS near FROM kept k, c{n} m) GROUP BY r)")
        if n < rounds:
            parts.append(f"""c{n + 1} AS (SELECT m.c, coalesce(f.v, m.v) AS v FROM c{n} m LEFT JOIN (SELECT c, list(x ORDER BY k) AS v FROM (
  SELECT c, k, floor(sum(x) / count(*)) AS x FROM (SELECT near.c AS c, unnest(v) AS x, generate_subscripts(v, 1) AS k FROM a{n}) GROUP BY c, k) GROUP BY c) f USING (c))""")
    return f"""
WITH {", ".join(parts)}
SELECT vec_id, CAST(near.c AS INTEGER) AS cluster, near.d AS distance, CAST(sum(near.d) OVER (PARTITION BY near.c) AS BIGINT) AS cluster_inertia, CAST(sum(near.d) OVER () AS BIGINT) AS inertia,
  sha256(array_to_string(list_transform(m.v, lambda x: CAST(x AS BIGINT)), ',')) AS centroid_sha256 FROM a{rounds} a JOIN c{rounds} m ON m.c = a.near.c"""


ORACLE_SQL: dict[str, str] = {"op12_sharding": SHARDS_SQL, "op13_dual_tree": clusters_sql()}
