"""Numbers, percentages and delivery dates as people write them. Nothing found is null, never 0."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from groundtable.functions.text import ascii_digits, clean_constant, fold_letters, let

# Multipliers and spelled-out numbers, in the order in which they are tried.
MULTIPLIERS = {"مليون": 1e6, "مليار": 1e9, "الف": 1e3, "ألف": 1e3, "m": 1e6, "mn": 1e6, "million": 1e6, "k": 1e3, "thousand": 1e3}
SPELLED = {
    "نص": 0.5, "نصف": 0.5, "ربع": 0.25, "واحد": 1, "اثنين": 2, "اتنين": 2, "تلاتة": 3, "ثلاثة": 3, "اربعة": 4, "أربعة": 4,
    "خمسة": 5, "ستة": 6, "سبعة": 7, "تمانية": 8, "ثمانية": 8, "تسعة": 9, "عشرة": 10,
}
WORD_MULTIPLIER = r"(\d+(?:\.\d+)?)?\s*(مليون|الف|ألف)\s*(?:و)?\s*(نص|نصف|ربع)?"
SUFFIXED = r"(?i)(\d+(?:[.,]\d+)?)\s*(مليون|مليار|الف|ألف|m|mn|million|k|thousand)?"
SUFFIXED_WHOLE_WORD = r"(?i)(\d+(?:[.,]\d+)?)(?:\s*(مليون|مليار|الف|ألف|million|thousand|mn|m|k)(?![\p{L}\d]))?"
PERCENT = r"(\d+(?:\.\d+)?)\s*%"
YEAR = r"(20\d{2})"
QUARTER = r"[Qq]\s*([1-4])|(?:ربع|الربع)\D{0,10}(الاول|الأول|الثاني|الثالث|الرابع|١|٢|٣|٤|[1-4])"
QUARTER_WORDS = {"الاول": "1", "الأول": "1", "الثاني": "2", "الثالث": "3", "الرابع": "4"}


def found(text: Column, pattern: str, group: int) -> Column:
    """A group of the first match, null where there is none."""
    return F.nullif(F.regexp_extract(text, pattern, group), F.lit(""))


def lookup(key: Column, values: dict) -> Column:
    """The value of a key among a few, else null; the key is evaluated once."""
    pairs = [x for k, v in values.items() for x in (F.lit(k), F.lit(v))]
    return F.try_element_at(F.create_map(*pairs), key)


def parse_number(text: Column, faithful: bool = True) -> Column:
    """A number from text that is composed already: a word multiplier, with a half or quarter; a spelled-out number with one;
    digits with a suffix.

    `faithful` keeps three habits that results may depend on: a suffix counts without a word end ("5 months" is
    five million), thousands separators break a word multiplier ("1,500 الف" is 500,000), and spelled-out words ending in
    a closed ta never match. Without it they are put right.
    """
    return let(F.trim(ascii_digits(text)), lambda t: F.coalesce(_in_words(t, faithful), _suffixed(F.replace(t, F.lit(","), F.lit("")), faithful)))


def _in_words(t: Column, faithful: bool) -> Column:
    def with_multiplier(words: Column) -> Column:
        base, unit, part = (found(words, WORD_MULTIPLIER, i) for i in (1, 2, 3))
        value = (F.coalesce(base.try_cast("double"), F.lit(1.0)) + F.coalesce(lookup(part, {k: float(v) for k, v in SPELLED.items()}), F.lit(0.0))) * lookup(unit, MULTIPLIERS)
        return F.when(base.isNotNull() | part.isNotNull(), value)

    def spelled(words: Column) -> Column:
        unit = lambda w: found(words, f"{w if faithful else clean_constant(w)}\\s*(مليون|الف|ألف)", 1)
        return F.coalesce(*(lookup(unit(w), {k: m * v for k, m in MULTIPLIERS.items()}) for w, v in SPELLED.items()))

    return let(fold_letters(t if faithful else F.replace(t, F.lit(","), F.lit(""))), lambda w: F.coalesce(with_multiplier(w), spelled(w)))


def _suffixed(plain: Column, faithful: bool) -> Column:
    pattern = SUFFIXED if faithful else SUFFIXED_WHOLE_WORD
    return found(plain, pattern, 1).try_cast("double") * F.coalesce(lookup(F.lower(found(plain, pattern, 2)), MULTIPLIERS), F.lit(1.0))


def parse_percentage(text: Column, faithful: bool = True) -> Column:
    """The number before a per cent sign, else any number."""
    return F.coalesce(found(ascii_digits(text), PERCENT, 1).try_cast("double"), parse_number(text, faithful))


def parse_delivery_date(text: Column, faithful: bool = True) -> Column:
    """A year from 2000, with its quarter if stated: 2027 or 2027-Q1.

    `faithful` keeps two habits: a year counts inside a longer number, and after the word for quarter a digit within
    ten characters, such as the year's own first one, counts before a quarter's name.
    """
    pattern = QUARTER if faithful else QUARTER.replace("{0,10}", "{0,10}?")
    t = ascii_digits(text)
    year = found(t, YEAR if faithful else r"(?<!\d)(20\d{2})(?!\d)", 1)
    named = found(t, pattern, 2)
    quarter = F.coalesce(found(t, pattern, 1), lookup(named, QUARTER_WORDS), F.when(named.rlike("^[0-9]+$"), named))
    return F.coalesce(F.concat(year, F.lit("-Q"), quarter), year)
