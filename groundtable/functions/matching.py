"""How predictions are held against labels."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from groundtable.functions.text import clean_arabic, fold_letters

TOLERANCE, JACCARD = 0.05, 0.5


def blank_as_null(text: Column) -> Column:
    return F.nullif(F.trim(text), F.lit(""))


def numeric_match(gold: Column, pred: Column) -> Column:
    """Within 5 per cent of the label, the bound included; a label of 0 takes 0 only; what is no number matches nothing."""
    g, p = gold.try_cast("double"), pred.try_cast("double")
    return F.coalesce(F.when(g == 0, p == 0).otherwise(F.abs(g - p) / F.abs(g) <= TOLERANCE), F.lit(False))


def text_match(gold: Column, pred: Column, composed: bool = False) -> Column:
    """Equal once trimmed, lower-cased, composed (unless they are `composed` already) and folded."""
    clean = fold_letters if composed else lambda x: clean_arabic(F.lower(F.trim(x)))
    return F.coalesce(clean(gold) == clean(pred), F.lit(False))


def split_list(text: Column) -> Column:
    """Items between semicolons and commas, trimmed, without empty ones."""
    return F.filter(F.transform(F.split(text, "[;,]"), lambda x: F.trim(x)), lambda x: x != "")


def jaccard(a: Column, b: Column) -> Column:
    """Similarity of two arrays as sets; 1 if both are empty."""
    either = F.size(F.array_union(a, b))
    return F.when(either == 0, F.lit(1.0)).otherwise(F.size(F.array_intersect(a, b)) / F.nullif(either, F.lit(0)))


def jaccard_match(a: Column, b: Column) -> Column:
    fold = lambda items: F.transform(items, lambda x: fold_letters(F.lower(x)))
    return F.coalesce(jaccard(fold(a), fold(b)) >= JACCARD, F.lit(False))
