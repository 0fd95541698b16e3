"""Quality rules learnt from labels: an ordered list of threshold conjunctions.

Sequential covering: a rule for rejecting grows one condition at a time by the information it gains on the
labelled rows not yet covered, loses its last conditions where held-back rows do better without them, and is
kept while it is right more often than not. The list becomes one conditional expression of Spark. Everything
runs on DataFrame functions: what a condition would cover is read from counts by feature and threshold bin,
one small aggregation for each step; rows never leave Spark.
"""

from __future__ import annotations

from dataclasses import dataclass
from math import log2

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from groundtable.llm.common import SPACE
from groundtable.session import cut

#: Signs that the base counts (fixed values).
SIGNS = "#*$%&|<>"
UPPER, DIGITS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789"
#: Thresholds a feature, rules, conditions a rule.
BINS, RULES, CONDITIONS = 24, 8, 3

#: What rules may test, from the counts of describe().
FEATURES = {
    "sign_share": "n_symbols / word_chars",
    "upper_share": "n_upper / word_chars",
    "digit_share": "n_digits / word_chars",
    "bang_share": "n_bangs / word_chars",
    "word_length": "word_chars / n_words",
    "repeat_line_share": "n_dup_lines / n_lines",
    "repeat_word_share": "n_repeat_words / n_words",
    "distinct_share": "n_distinct / n_words",
    "words": "cast(n_words as double)",
}


def count_of(text: Column, letters: str) -> Column:
    """How many characters of a text are among `letters`."""
    return (F.length(text) - F.length(F.translate(text, letters, ""))).cast("long")


def describe(docs: DataFrame) -> DataFrame:
    """doc_id and the counts that base and rules use, of every whole text.

    Repeated word windows are found by sorting each text's window hashes (64 bits): equal neighbours are
    repeats, and the words that their places cover are added up. Null texts count as empty.
    """
    zero = F.lit(0).cast("long")
    one = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("t"))
    split = one.select(
        "*",
        F.filter(F.split("t", SPACE + "+"), lambda x: x != "").alias("w"),
        F.filter(F.split("t", "\n"), lambda x: x.rlike(SPACE.replace("[", "[^", 1))).alias("l"),
    )
    sized = split.select("*", F.size("w").alias("n"))
    window = F.transform(
        F.sequence(F.lit(1), F.col("n") - 2), lambda i: F.struct(F.xxhash64(F.element_at("w", i), F.element_at("w", i + 1), F.element_at("w", i + 2)).alias("h"), i.alias("i"))
    )
    sorted_ = sized.select("*", F.when(F.col("n") >= 4, F.sort_array(window)).alias("s"))
    pairs = F.zip_with(F.slice("s", 1, F.col("n") - 3), F.slice("s", 2, F.col("n") - 3), lambda a, b: F.when(a["h"] == b["h"], F.array(a["i"], b["i"])))
    places = F.sort_array(F.array_distinct(F.flatten(F.filter(pairs, lambda x: x.isNotNull()))))
    state = F.struct(F.lit(0).alias("end"), zero.alias("covered"))
    step = lambda a, i: F.struct((i + 3).alias("end"), (a["covered"] + (i + 3 - F.greatest(a["end"], i)).cast("long")).alias("covered"))
    return sorted_.select(
        "doc_id",
        F.col("n").cast("long").alias("n_words"),
        F.length(F.array_join("w", "")).cast("long").alias("word_chars"),
        count_of(F.col("t"), SIGNS).alias("n_symbols"),
        (F.size("l") - F.size(F.array_distinct("l"))).cast("long").alias("n_dup_lines"),
        F.when(F.col("n") >= 4, F.aggregate(places, state, step, lambda a: a["covered"])).otherwise(zero).alias("n_repeat_words"),
        F.size("l").cast("long").alias("n_lines"),
        F.size(F.array_distinct("w")).cast("long").alias("n_distinct"),
        count_of(F.col("t"), UPPER).alias("n_upper"),
        count_of(F.col("t"), DIGITS).alias("n_digits"),
        count_of(F.col("t"), "!").alias("n_bangs"),
    )


def base_failed() -> Column:
    """Fewer than 50 words, or repeated windows cover more than half of them."""
    return F.expr("n_words < 50 or 100 * n_repeat_words > 50 * n_words")


@dataclass(frozen=True)
class Condition:
    feature: str
    above: bool
    threshold: float

    def column(self) -> Column:
        value = F.expr(FEATURES[self.feature])
        return value > self.threshold if self.above else value <= self.threshold

    def __str__(self) -> str:
        return f"{self.feature} {'>' if self.above else '<='} {self.threshold:.4g}"


def verdict(rules: list[list[Condition]]) -> Column:
    """The decision list as one conditional: the first rule that holds rejects, without one a document is kept."""
    out = None
    for rule in rules:
        holds = rule[0].column()
        for c in rule[1:]:
            holds = holds & c.column()
        holds = F.coalesce(holds, F.lit(False))
        out = F.when(holds, F.lit(False)) if out is None else out.when(holds, F.lit(False))
    return F.lit(True) if out is None else out.otherwise(F.lit(True))


def gain(p: int, n: int, of_p: int, of_n: int) -> float:
    """Information gained on the rows to reject by going from (of_p, of_n) to (p, n)."""
    return p * (log2(p / (p + n)) - log2(of_p / (of_p + of_n))) if p and of_p else 0.0


def learn(counts: DataFrame, labels: DataFrame, per_class: int = 10_000) -> list[list[Condition]]:
    """Grows the list from labelled rows; at most `per_class` of each label are learnt from, chosen by their ids' hashes."""
    known = labels.filter(F.col("quality").isin(0, 1)).groupBy("doc_id").agg(F.max("quality").alias("good"))
    picked = [known.filter(F.col("good") == c).orderBy(F.xxhash64("doc_id"), "doc_id").limit(per_class) for c in (0, 1)]
    rows = counts.filter(~base_failed()).join(F.broadcast(picked[0].union(picked[1])), "doc_id")
    rows = rows.select("doc_id", (F.col("good") == 0).alias("bad"), (F.pmod(F.xxhash64("doc_id", F.lit(5)), F.lit(3)) == 0).alias("back"), *(F.expr(e).alias(f) for f, e in FEATURES.items()))
    rows = cut(rows)
    shares = [i / BINS for i in range(1, BINS)]
    found = rows.agg(*(F.percentile_approx(F.when(F.col("bad") == b, F.col(f)), F.array(*map(F.lit, shares)), F.lit(10000)).alias(f"{f}_{b}") for f in FEATURES for b in (True, False))).first()
    cuts = {f: sorted({*(found[f"{f}_True"] or []), *(found[f"{f}_False"] or [])}) for f in FEATURES}
    names = [f for f in FEATURES if cuts[f]]
    if not names:
        return []
    # a row's bin of a feature: how many thresholds lie below its value
    below = lambda f: F.size(F.filter(F.array(*map(F.lit, cuts[f])), lambda t: F.col(f) > t))
    bins = F.array(*map(below, names))
    rows = cut(rows.select("bad", "back", *names, bins.alias("bins")))
    holds = lambda c: F.col(c.feature) > c.threshold if c.above else F.col(c.feature) <= c.threshold
    rules: list[list[Condition]] = []
    left = rows
    while len(rules) < RULES:
        rule: list[Condition] = []
        here = left.filter(~F.col("back"))
        while len(rule) < CONDITIONS:
            table = {(r["f"], r["bin"], r["bad"]): r["count"] for r in here.select("bad", F.posexplode("bins").alias("f", "bin")).groupBy("f", "bin", "bad").count().collect()}
            of_p, of_n = (sum(n for (f, _, bad), n in table.items() if f == 0 and bad == b) for b in (True, False))
            if of_p < 3 or not of_n:
                break
            best = (0.0, None)
            for i, f in enumerate(names):
                at = [(table.get((i, b, True), 0), table.get((i, b, False), 0)) for b in range(len(cuts[f]) + 1)]
                p = n = 0
                for b, t in enumerate(cuts[f]):
                    p, n = p + at[b][0], n + at[b][1]
                    best = max(best, (gain(p, n, of_p, of_n), Condition(f, False, t)), (gain(of_p - p, of_n - n, of_p, of_n), Condition(f, True, t)), key=lambda x: x[0])
            if best[1] is None or best[0] < 0.5:
                break
            rule.append(best[1])
            here = here.filter(holds(best[1]))
        if not rule:
            break
        # prune: the shortest start of the rule that does best on the rows held back
        starts, so_far = [], F.lit(True)
        for c in rule:
            so_far = so_far & holds(c)
            starts.append(so_far)
        seen = left.filter("back").agg(*(F.coalesce(F.sum((s & (F.col("bad") == b)).cast("int")), F.lit(0)).alias(f"{b}{i}") for i, s in enumerate(starts) for b in (True, False))).first()
        worth = lambda i: (seen[f"True{i}"] - seen[f"False{i}"]) / (seen[f"True{i}"] + seen[f"False{i}"] + 1)
        keep = max(range(len(rule)), key=lambda i: (worth(i), -i))
        if worth(keep) <= 0.3:
            break
        rules.append(rule[: keep + 1])
        left = left.filter(~starts[keep])
    return rules


def apply(docs: DataFrame, labels: DataFrame, per_class: int = 10_000) -> DataFrame:
    """doc_id, the counts, base_failed, kept (false if the base fails, else the list's verdict) for every document.

    Null and empty texts have no words and fail the base. Repeated rows are judged alike. Without labels of both
    kinds the list is empty and the base decides. An empty table gives no rows; other columns are ignored.
    """
    counts = cut(describe(docs))
    rules = learn(counts, labels, per_class)
    return counts.withColumn("base_failed", base_failed()).withColumn("kept", ~F.col("base_failed") & verdict(rules))
