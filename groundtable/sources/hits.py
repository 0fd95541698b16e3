"""Landed search hits to the columns that a listing states itself."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from groundtable import schemas
from groundtable.functions.enums import property_type
from groundtable.functions.text import clean_compound


def parse_hits(listings: DataFrame) -> DataFrame:
    """`listings` with hit, its JSON as a struct; malformed JSON gives a struct of nulls."""
    return listings.withColumn("hit", F.from_json("hit_json", schemas.HIT))


def filled(*values: Column) -> Column:
    """The first value that is neither null nor empty."""
    return F.coalesce(*(F.nullif(v, F.lit("")) for v in values))


def at_level(places: Column, level: int) -> Column:
    """The last place of a level: a later duplicate wins."""
    return F.try_element_at(F.filter(places, lambda p: p["level"] == level), F.lit(-1))


def location_path(places: Column) -> Column:
    """Names below the country in the order given; null without any."""
    named = F.filter(places, lambda p: (p["level"] > 0) & (p["name"] != ""))
    return F.nullif(F.array_join(F.transform(named, lambda p: p["name"]), " > "), F.lit(""))


def deepest(categories: Column) -> Column:
    """The category of the highest level, the first of equal ones; a null level counts 0."""
    level = lambda c: F.coalesce(c["level"], F.lit(0))
    top = F.array_max(F.transform(categories, level))
    return F.try_element_at(F.filter(categories, lambda c: level(c) == top), F.lit(1))


def compound_of(places: Column) -> Column:
    """The first place of level 4, in English if it has that name, without wrapper words."""
    place = F.try_element_at(F.filter(places, lambda p: p["level"] == 4), F.lit(1))
    return clean_compound(filled(place["name_l1"], place["name"]))


def epoch_date(seconds: Column) -> Column:
    """A UTC date; null for null, 0 and what is out of range."""
    sane = F.when((seconds != 0) & F.abs(seconds).between(0, 253402300799), seconds)
    return F.to_date(F.timestamp_seconds(sane))


def read_hits(spark: SparkSession, path: str) -> DataFrame:
    """Landed hits as listings: lines of JSON with externalID, purpose, governorate and category (in the line, or as folders k=v), the line itself as hit_json.

    Lines without an id are left out. A hit lands when its file does.
    """
    keys = ["purpose", "governorate", "category"]
    rows = spark.read.text(path).select("*", F.col("_metadata.file_modification_time").alias("discovered_at"))
    there = [c for c in keys if c in rows.columns]
    said = lambda k: F.col(k) if k in there else F.get_json_object("value", f"$.{k}")
    id_ = F.nullif(F.trim(F.get_json_object("value", "$.externalID")), F.lit(""))
    return rows.select(
        id_.alias("listing_id"), F.coalesce(F.get_json_object("value", "$.url"), id_).alias("url"), said("purpose").alias("purpose"), said("governorate").alias("governorate"),
        (F.col("category") if "category" in there else F.get_json_object("value", "$.slice")).alias("category"), F.col("value").alias("hit_json"), "discovered_at",
    ).filter("listing_id is not null")


def stated_columns(hits: DataFrame, *more: Column | str) -> DataFrame:
    """listing_id, url, `more`, and the columns a hit states: 15 fields and 8 hints, from `hit`."""
    h = F.col("hit")
    category = deepest(h["category"])
    kind = property_type(filled(category["nameSingular_l1"], category["name_l1"]))
    purpose = F.when(h["purpose"] == "for-sale", "sale").when(h["purpose"] == "for-rent", "rent").otherwise(h["purpose"])
    extra = h["extraFields"]
    return hits.select(
        "listing_id",
        "url",
        *more,
        purpose.alias("purpose"),
        kind.alias("property_type"),
        h["price"].alias("price"),
        F.when(purpose == "rent", h["rentFrequency"]).alias("price_period"),
        F.lit("EGP").alias("currency"),
        F.when(kind == "studio", F.lit(0)).otherwise(h["rooms"].try_cast("int")).alias("bedrooms"),
        h["baths"].try_cast("int").alias("bathrooms"),
        h["area"].alias("area_sqm"),
        location_path(h["location"]).alias("location_raw"),
        filled(h["agency"]["name_l1"], h["agency"]["name"]).alias("agency_name"),
        F.coalesce(h["isVerified"], F.lit(False)).alias("is_verified"),
        epoch_date(h["createdAt"]).alias("date_listed"),
        at_level(h["location"], 1)["name_l1"].alias("governorate"),
        at_level(h["location"], 2)["name_l1"].alias("city"),
        at_level(h["location"], 3)["name_l1"].alias("district"),
        h["completionStatus"].alias("hint_completion_status"),
        extra["ownership"].alias("hint_ownership"),
        h["downPayment"].alias("hint_down_payment"),
        h["furnishingStatus"].alias("hint_furnishing_status"),
        F.coalesce(h["amenities_l1"], F.array().cast("array<string>")).alias("hint_amenities"),
        compound_of(h["location"]).alias("hint_compound_name"),
        extra["monthly_installment"].alias("hint_monthly_installment"),
        extra["installments_payment_duration_years"].alias("hint_installment_years"),
    )
