"""Arabic and Latin text: digits, letters, language, mark-up.

The letter rules are for matching; stored descriptions stay as they were written. `nfkc` is the one function
here that Spark lacks: it runs in Arrow batches, once a row, and the rest works on its result with built-ins.
"""

from __future__ import annotations

import json
import unicodedata
from collections.abc import Callable
from html.entities import html5

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

# Digits, letters and marks that matching treats alike.
ARABIC_DIGITS = "٠١٢٣٤٥٦٧٨٩"
PERSIAN_DIGITS = "۰۱۲۳۴۵۶۷۸۹"
ASCII_DIGITS = "0123456789"
TATWEEL = "ـ"
DIACRITICS = "[ً-ٰٟۖ-ۭ]"
LETTERS, PLAIN_LETTERS = "إأآةى", "اااهي"
ARABIC_BLOCK = "[؀-ۿ]"
#: Words that wrap a compound's name (fixed values).
COMPOUND_WORDS = r"(?iU)\b(?:compound|project)\b|كومباوند|كمبوند|كمباوند|مشروع"
#: The character references that pages are full of; a reference; one that is not among them; the names that also count without a semicolon.
COMMON = {"&#39;": "'"} | {f"&{k};": html5[f"{k};"] for k in ("lt", "gt", "quot", "apos", "nbsp", "middot", "copy", "amp")}
REFERENCE = r"&(?:#[0-9]+;?|#[xX][0-9a-fA-F]+;?|[^\t\n\f <&#;]{1,32};?)"
RARE = "&(?!" + "|".join(k[1:] for k in COMMON) + r")[^\t\n\f <&;]"
BARE = "^&(" + "|".join(sorted((k for k in html5 if not k.endswith(";")), key=len, reverse=True)) + ")"
#: A share of the rarer script above this makes a text mixed.
MIXED_ABOVE = 0.15


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body(value) with the value evaluated once, however often the body uses it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


@F.pandas_udf(StringType())
def nfkc(text: pd.Series) -> pd.Series:
    """Unicode compatibility composition; null stays null."""
    return text.map(lambda x: None if x is None else unicodedata.normalize("NFKC", x))


def nfkc_all(values: list[Column]) -> list[Column]:
    """nfkc() of several texts by one call a row: they are joined by a character that composes with nothing, and cut again."""
    joined = nfkc(F.concat_ws("\0", *(F.coalesce(v, F.lit("")) for v in values)))
    return [F.when(v.isNotNull(), F.get(F.split(joined, "\0", -1), F.lit(i))) for i, v in enumerate(values)]


def ascii_digits(text: Column) -> Column:
    """Arabic and Persian digits as ASCII ones."""
    return F.translate(text, ARABIC_DIGITS + PERSIAN_DIGITS, ASCII_DIGITS * 2)


def to_ascii_digits(text: Column) -> Column:
    """ascii_digits() after compatibility composition."""
    return ascii_digits(nfkc(text))


def fold_letters(text: Column) -> Column:
    """Digits, tatweel, diacritics and letter variants folded, ends trimmed; expects composed text."""
    bare = F.regexp_replace(F.replace(ascii_digits(text), F.lit(TATWEEL), F.lit("")), DIACRITICS, "")
    return F.regexp_replace(F.translate(bare, LETTERS, PLAIN_LETTERS), r"(?U)^\s+|\s+$", "")


def clean_arabic(text: Column) -> Column:
    """The form in which texts are compared: composed, then folded."""
    return fold_letters(nfkc(text))


def clean_constant(text: str) -> str:
    """clean_arabic() of a constant in lower case, so that glossaries need no work at run time."""
    t = unicodedata.normalize("NFKC", text.lower())
    t = t.translate(str.maketrans(ARABIC_DIGITS + PERSIAN_DIGITS + LETTERS, ASCII_DIGITS * 2 + PLAIN_LETTERS))
    return "".join(c for c in t if c != TATWEEL and not ("ً" <= c <= "ٟ" or c == "ٰ" or "ۖ" <= c <= "ۭ")).strip()


def detect_language(text: Column) -> Column:
    """ar, en or mixed by letters; a tie is ar; null without letters.

    The whole Arabic block counts, its digits and marks too. A minority of exactly the limit is not mixed.
    """
    # plain expressions: generated code works out each count once, which it does not inside a higher-order function
    arabic, latin = (F.length(F.regexp_replace(text, f"[^{kind}]+", "")) for kind in (ARABIC_BLOCK.strip("[]"), "A-Za-z"))
    few, total = F.least(arabic, latin), arabic + latin
    return F.when(total == 0, F.lit(None).cast("string")).when((few > 0) & (few / total > MIXED_ABOVE), "mixed").when(arabic >= latin, "ar").otherwise(F.when(latin > arabic, "en"))


def clean_compound(name: Column) -> Column:
    """A compound's name without words like "compound"; the trimmed name if nothing else is left, null for an empty one."""
    short = F.btrim(F.regexp_replace(F.regexp_replace(name, COMPOUND_WORDS, " "), r"(?U)\s+", " "), F.lit(" -،,"))
    return F.when(name == "", F.lit(None)).otherwise(F.coalesce(F.nullif(short, F.lit("")), F.trim(name)))


def char(code: Column) -> Column:
    """The character of a code point, by its bytes after a byte order mark."""
    return F.decode(F.unhex(F.concat(F.lit("0000FEFF"), F.lpad(F.hex(code), 8, "0"))), "UTF-32")


def numbered_char(code: Column) -> Column:
    """What a numbered reference stands for: some numbers mean the characters that an old code page has there, some nothing, some are no characters."""
    old = {n: bytes([n]).decode("cp1252", errors="ignore") or chr(n) for n in range(0x80, 0xA0)}
    nothing = (code.between(1, 8) | (code == 11) | code.between(14, 31) | (code == 127) | code.between(0xFDD0, 0xFDEF) | (code.bitwiseAND(0xFFFE) == 0xFFFE))
    bad = code.isNull() | (code == 0) | code.between(0xD800, 0xDFFF) | (code > 0x10FFFF)
    return F.when(bad, "\ufffd").when(code.between(0x80, 0x9F), F.element_at(F.array(*map(F.lit, old.values())), (code - 0x7F).cast("int"))).when(nothing, "").otherwise(char(code))


def dereference(ref: Column) -> Column:
    """The text of one character reference; what is none stays, what begins with a name that needs no semicolon is that and the rest."""
    digits = F.concat(F.lit("0"), F.regexp_extract(ref, "^&#[xX]?0*([0-9a-fA-F]*)", 1))
    code = F.when(F.length(digits) <= 9, F.when(ref.rlike("^&#[xX]"), F.conv(digits, 16, 10)).otherwise(digits).try_cast("long"))
    named = F.from_json(F.lit(json.dumps({f"&{k}": v for k, v in html5.items()})), "map<string,string>")  # folded to one constant; as a map of literals it would be thousands
    bare = F.nullif(F.regexp_extract(ref, BARE, 1), F.lit(""))
    begun = F.concat(F.try_element_at(named, F.concat(F.lit("&"), bare)), F.substr(ref, F.length(bare) + 2))
    return F.coalesce(F.when(ref.startswith("&#"), numbered_char(code)), F.try_element_at(named, ref), begun, ref)


def unescape(text: Column, all_: bool = True) -> Column:
    """Character references as their characters, once.

    Texts with none but COMMON ones have these replaced, the ampersand's own last. Others are cut at references, each is looked up, and the
    pieces are joined; without `all_`, what is not common stays.
    """

    def common(t: Column) -> Column:
        for ref, c in COMMON.items():
            t = F.replace(t, F.lit(ref), F.lit(c))
        return t

    def any_kind(t: Column) -> Column:
        pieces, refs = F.split(t, REFERENCE, -1), F.regexp_extract_all(t, F.lit(REFERENCE), F.lit(0))
        return F.array_join(F.zip_with(pieces, refs, lambda piece, ref: F.concat(piece, F.coalesce(dereference(ref), F.lit("")))), "")

    return let(text, lambda t: F.when(t.rlike(RARE), any_kind(t)).otherwise(common(t))) if all_ else common(text)


def strip_markup(markup: Column, all_entities: bool = True, space: str = r"\s") -> Column:
    """Line breaks as newlines, then tags dropped, character references of every kind (or the common ones) resolved, ends trimmed of `space`."""
    plain = F.regexp_replace(F.regexp_replace(markup, rf"<br{space}*/?>", "\n"), "<[^>]+>", "")
    return F.regexp_replace(unescape(plain, all_entities), rf"^{space}+|{space}+\z", "")


def canonical_governorate(name: Column) -> Column:
    """One label for each governorate in either language; others as they are, blank or null as Unknown."""
    # Fixed values.
    labels = {"القاهرة": "Cairo", "الجيزة": "Giza", "الاسكندرية": "Alexandria", "الإسكندرية": "Alexandria"}
    bare = F.trim(name)
    out = F.coalesce(F.nullif(bare, F.lit("")), F.lit("Unknown"))
    for local, label in labels.items():
        out = F.when(bare == local, F.lit(label)).otherwise(out)
    return out
