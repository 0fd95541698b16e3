"""Landed pages: are they real, and what do they say."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from groundtable.functions.text import strip_markup
from groundtable.sources.hits import filled

# What shows a challenge, what shows a listing, and where a description stands.
CHALLENGES = ('"routeName":"captchaChallenge"', "كلمة التحقق")
LISTING_MARKS = ("browserInitialState", '"@type":"RealEstateListing"')
LEAST_CHARS, HEAD_CHARS = 1000, 3000
STATE_SCRIPT = r'(?s)<script id="browserInitialState"[^>]*>(.*?)</script>'
JSON_LD_SCRIPT = r'(?s)<script type="application/ld\+json"[^>]*>(.*?)</script>'
DOM_DESCRIPTION = r'(?s)aria-label="وصف العقار"[^>]*>\s*<div[^>]*>\s*<span[^>]*>(.*?)</span>'
STATE_VALUE = '"value":'
JSON_LD = "struct<`@graph`: array<struct<mainEntity: struct<description: string>>>>"


def is_blocked(html: Column, marks: tuple[str, ...] = LISTING_MARKS) -> Column:
    """Null, short, a challenge, or without any mark of a listing."""
    challenge = html.contains(CHALLENGES[0]) | F.substring(html, 1, HEAD_CHARS).contains(CHALLENGES[1])
    real = F.lit(False)
    for mark in marks:
        real = real | html.contains(mark)
    return F.coalesce((F.length(html) < LEAST_CHARS) | challenge | ~real, F.lit(True))


def page_rows(landed: DataFrame, *more: str, marks: tuple[str, ...] = LISTING_MARKS) -> DataFrame:
    """listing_id, url, html with bytes (characters, as ever), content_hash and blocked, and `more` columns."""
    return landed.select("listing_id", "url", "html", F.length("html").cast("long").alias("bytes"), F.sha2("html", 256).alias("content_hash"), is_blocked(F.col("html"), marks).alias("blocked"), *more)


def state_json(html: Column) -> Column:
    """What follows the value mark in the state script; text after the JSON value is left in."""
    script = F.nullif(F.regexp_extract(html, STATE_SCRIPT, 1), F.lit(""))
    at = F.locate(STATE_VALUE, script)
    return F.when(at > 0, F.substr(script, at + len(STATE_VALUE)))


def state_description(html: Column) -> Column:
    """The description in the page's state, its mark-up as text."""
    data = state_json(html)
    raw = filled(F.get_json_object(data, "$.property.data.mainDescription"), F.get_json_object(data, "$.property.data.description"))
    return strip_markup(raw)


def json_ld_description(html: Column) -> Column:
    """The first description in the page's JSON-LD graphs; blocks that do not parse are passed over."""
    blocks = F.regexp_extract_all(html, F.lit(JSON_LD_SCRIPT), F.lit(1))
    nodes = F.flatten(F.filter(F.transform(blocks, lambda b: F.from_json(b, JSON_LD)["@graph"]), lambda g: g.isNotNull()))
    said = F.filter(F.transform(nodes, lambda n: n["mainEntity"]["description"]), lambda d: d != "")
    return F.try_element_at(said, F.lit(1))


def dom_description(html: Column) -> Column:
    """The description in the document itself."""
    return strip_markup(F.nullif(F.regexp_extract(html, DOM_DESCRIPTION, 1), F.lit("")))


def description(html: Column) -> Column:
    """From the state, else JSON-LD, else the document."""
    return filled(state_description(html), json_ld_description(html), dom_description(html))
