"""Are extracted values in the text they were extracted from?"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from groundtable import schemas
from groundtable.functions.enums import canon_enum
from groundtable.functions.numbers import parse_delivery_date, parse_number, parse_percentage
from groundtable.functions.text import ARABIC_BLOCK, fold_letters


def canonicalize(df: DataFrame, faithful: bool = True) -> DataFrame:
    """Numbers parsed, enums snapped to their vocabularies; a date that does not parse stays as it is."""
    done = {c: (parse_percentage if c in schemas.PERCENTAGES else parse_number)(F.col(c).cast("string"), faithful) for c in schemas.NUMERIC if c in df.columns}
    done |= {c: canon_enum(c, F.nullif(F.col(c), F.lit(""))) for c in schemas.ENUMS if c in df.columns}
    if "delivery_date" in df.columns:
        done["delivery_date"] = F.coalesce(parse_delivery_date(F.col("delivery_date"), faithful), F.col("delivery_date"))
    return df.withColumns(done)


def number_forms(value: Column) -> list[Column]:
    """A number as it may be written: whole numbers bare and with .0, others to ten places without trailing zeros."""
    whole = value == F.floor(value)
    bare = F.replace(F.call_function("format_number", value, F.lit("0.##########")), F.lit(","), F.lit(""))
    return [bare, F.when(whole, F.concat(bare, F.lit(".0")))]


def number_grounded(value: Column, text: Column) -> Column:
    """One of the number's forms stands in the text, be it inside a longer number; nothing to ground is grounded."""
    hit = F.lit(False)
    for form in number_forms(value):
        hit = hit | F.coalesce(text.contains(form), F.lit(False))
    return value.isNull() | hit


def text_grounded(value: Column, text: Column) -> Column:
    """The folded value stands in the folded text, or is in a script that the text has nothing of and so can't be checked."""
    v = fold_letters(F.lower(value))
    latin, text_latin, text_arabic = v.rlike("[a-z]"), text.rlike("[a-z]"), text.rlike(ARABIC_BLOCK)
    other_script = (latin & text_arabic & ~text_latin) | (~latin & text_latin & ~text_arabic)
    return value.isNull() | F.coalesce((v != "") & (text.contains(v) | other_script), F.lit(False))


def ground(df: DataFrame, description: Column) -> DataFrame:
    """`df` with ungrounded numbers and names nulled, and rejected: their columns' names."""
    df = df.withColumn("_text", fold_letters(F.lower(description)))
    fits = {c: number_grounded(F.col(c), F.col("_text")) for c in schemas.NUMERIC if c in df.columns}
    fits |= {c: text_grounded(F.nullif(F.col(c), F.lit("")), F.col("_text")) for c in schemas.TEXTS if c in df.columns}
    marked = df.withColumns({f"_ok_{c}": ok for c, ok in fits.items()})
    rejected = F.array_compact(F.array(*(F.when(~F.col(f"_ok_{c}"), F.lit(c)) for c in fits)))
    return marked.withColumn("rejected", rejected).withColumns({c: F.when(F.col(f"_ok_{c}"), F.col(c)) for c in fits}).drop("_text", *(f"_ok_{c}" for c in fits))
