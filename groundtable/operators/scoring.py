"""Predictions against labels, field by field."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from groundtable import schemas
from groundtable.functions.matching import blank_as_null, jaccard_match, numeric_match, split_list, text_match
from groundtable.functions.text import nfkc, nfkc_all


def tally(pairs: DataFrame, correct: Column) -> DataFrame:
    """From rows of field, gold, pred (strings, null for none): counts and rates for each field."""
    g, p = F.col("gold").isNotNull(), F.col("pred").isNotNull()
    counted = pairs.groupBy("field").agg(
        F.count_if(g).alias("gold_nonnull"), F.count_if(p).alias("pred_nonnull"), F.count_if(g & p & correct).alias("correct"),
        F.count_if(~g).alias("gold_null"), F.count_if(~g & p).alias("hallucinated"),
    )
    return with_rates(counted)


def with_rates(counted: DataFrame) -> DataFrame:
    rate = lambda n, of: F.when(F.col(of) > 0, F.col(n) / F.col(of))
    return counted.withColumns({"accuracy": rate("correct", "gold_nonnull"), "hallucination_rate": rate("hallucinated", "gold_null")})


def as_text(df: DataFrame, c: str) -> Column:
    """A column as text; blanks and NaN are null, lists are joined by ;"""
    kind = dict(df.dtypes)[c]
    if kind.startswith("array"):
        return F.nullif(F.array_join(c, ";"), F.lit(""))
    if kind in ("double", "float"):
        return F.when(~F.isnan(c), F.col(c)).cast("string")
    return blank_as_null(F.col(c).cast("string"))


def long_form(df: DataFrame, key: str, fields: list[str], name: str) -> DataFrame:
    """key, field and the value as text."""
    return df.select(key, F.explode(F.map_from_arrays(F.array(*map(F.lit, fields)), F.array(*(as_text(df, c) for c in fields)))).alias("field", name))


def score_fields(gold: DataFrame, records: DataFrame, fields: list[str] | None = None, key: str = "listing_id", numeric: tuple[str, ...] = schemas.NUMERIC, lists: tuple[str, ...] = ("amenities",)) -> DataFrame:
    """Counts and rates of every labelled field over listings that both sides have.

    Both sides are joined by key as they are, one wide row a listing; one aggregation gives all counts in one row, which then becomes
    a row a field. Texts of a row are composed together, in one call. Fields count 0 where nothing was joined.
    """
    fields = fields or schemas.names(schemas.GROUP_B)
    sides = [df.select(F.col(key).alias("k"), *(as_text(df, c).alias(f"{side}{i}") for i, c in enumerate(fields))) for df, side in ((gold, "g"), (records, "p"))]
    both = sides[0].join(sides[1], "k")
    texts = [i for i, c in enumerate(fields) if c not in numeric]
    if texts:
        names = [f"{side}{i}" for side in "gp" for i in texts]
        both = both.withColumns({f"c{n}": x for n, x in zip(names, nfkc_all([F.lower(F.trim(F.col(n))) for n in names]), strict=True)})

    def counts(i: int, field: str) -> Column:
        g, p = F.col(f"g{i}"), F.col(f"p{i}")
        right = numeric_match(g, p) if field in numeric else jaccard_match(split_list(F.col(f"cg{i}")), split_list(F.col(f"cp{i}"))) if field in lists else text_match(F.col(f"cg{i}"), F.col(f"cp{i}"), composed=True)
        there, said = g.isNotNull(), p.isNotNull()
        return F.struct(
            F.lit(field).alias("field"), F.count_if(there).alias("gold_nonnull"), F.count_if(said).alias("pred_nonnull"), F.count_if(there & said & right).alias("correct"),
            F.count_if(~there).alias("gold_null"), F.count_if(~there & said).alias("hallucinated"),
        )

    one = both.agg(*(counts(i, c).alias(f"f{i}") for i, c in enumerate(fields)))
    return with_rates(one.select(F.inline(F.array(*(f"f{i}" for i in range(len(fields)))))))


def matches(field: Column, numeric: tuple[str, ...] = schemas.NUMERIC, lists: tuple[str, ...] = ("amenities",)) -> Column:
    """Whether pred is right for gold, in long form: by number, as lists or as text, as the field is."""
    gold, pred = F.col("gold"), F.col("pred")
    both = [split_list(nfkc(F.lower(F.trim(x)))) for x in (gold, pred)]
    return F.when(field.isin(*numeric), numeric_match(gold, pred)).when(field.isin(*lists), jaccard_match(*both)).otherwise(text_match(gold, pred))


def unmatched(gold: DataFrame, records: DataFrame) -> DataFrame:
    """Labelled listings that no record has."""
    return gold.join(records.select("listing_id"), "listing_id", "left_anti").select("listing_id")


def to_markdown(scores: DataFrame) -> str:
    """The scores as a table of Markdown (a row for each of a few fields); n/a where there is no rate."""
    rate = lambda x: "n/a" if x is None else f"{x:.0%}"
    rows = [f"| {r.field} | {r.gold_nonnull} | {r.pred_nonnull} | {rate(r.accuracy)} | {rate(r.hallucination_rate)} |" for r in scores.orderBy("field").collect()]
    return "\n".join(["| field | gold non-null | pred non-null | accuracy | hallucination |", "|---|---|---|---|---|", *rows])
