"""The tables of the store, what arrives in them, and what leaves."""

from __future__ import annotations

GROUP_A = (
    "listing_id string, url string, purpose string, property_type string, price double, price_period string, currency string, bedrooms int, bathrooms int, "
    "area_sqm double, location_raw string, agency_name string, is_verified boolean, date_listed date, description_raw string, language string"
)
GROUP_B = (
    "compound_name string, developer_name string, governorate string, city string, district string, finishing_level string, delivery_status string, delivery_date string, "
    "sale_type string, payment_type string, down_payment_amount double, down_payment_pct double, installment_years double, installment_amount double, "
    "installment_frequency string, cash_discount_pct double, amenities array<string>, floor_number string, garden_area_sqm double, roof_area_sqm double, is_negotiable boolean"
)
DERIVED = "price_per_sqm double, total_installment_cost double"
HINTS = (
    "hint_completion_status string, hint_ownership string, hint_down_payment double, hint_furnishing_status string, hint_amenities array<string>, hint_compound_name string, "
    "hint_monthly_installment double, hint_installment_years double"
)
PROVENANCE = "parsed_at timestamp, content_hash string, extracted_at timestamp, prompt_version string, model string, normalized_at timestamp, taxonomy_version string"

LISTINGS = "listing_id string, url string, purpose string, governorate string, category string, hit_json string, discovered_at timestamp"
PAGES = "listing_id string, url string, html string, bytes long, content_hash string, fetched_at timestamp"
RECORDS = ", ".join((GROUP_A, GROUP_B, DERIVED, HINTS, PROVENANCE))
EXTRACTIONS = "listing_id string, prompt_version string, model string, raw_json string, tokens_in long, tokens_out long, cost_usd double, grounded int, error string, ts timestamp"
FAILURES = "id long, listing_id string, stage string, error_class string, message string, ts timestamp"

#: One search hit as it lands.
HIT = (
    "externalID string, purpose string, category array<struct<level: int, nameSingular_l1: string, name_l1: string>>, location array<struct<level: int, name: string, name_l1: string>>, "
    "price double, rooms double, baths double, area double, rentFrequency string, agency struct<name: string, name_l1: string>, isVerified boolean, createdAt double, "
    "completionStatus string, furnishingStatus string, downPayment double, amenities_l1 array<string>, "
    "extraFields struct<ownership: string, monthly_installment: double, installments_payment_duration_years: double>"
)
#: Landed model output; numbers come as strings and are parsed.
EXTRACTED = (
    "compound_name string, developer_name string, finishing_level string, delivery_status string, delivery_date string, sale_type string, payment_type string, "
    "down_payment_amount string, down_payment_pct string, installment_years string, installment_amount string, installment_frequency string, cash_discount_pct string, "
    "amenities array<string>, floor_number string, garden_area_sqm string, roof_area_sqm string, is_negotiable boolean"
)
NUMERIC = ("down_payment_amount", "down_payment_pct", "installment_years", "installment_amount", "cash_discount_pct", "garden_area_sqm", "roof_area_sqm")
PERCENTAGES = ("down_payment_pct", "cash_discount_pct")
ENUMS = ("finishing_level", "delivery_status", "sale_type", "payment_type", "installment_frequency")
TEXTS = ("compound_name", "developer_name", "floor_number")


def names(ddl: str) -> list[str]:
    """Column names of a flat schema."""
    depth, start, parts = 0, 0, []
    for i, c in enumerate(ddl):
        depth += (c == "<") - (c == ">")
        if c == "," and not depth:
            parts.append(ddl[start:i])
            start = i + 1
    return [p.split()[0] for p in [*parts, ddl[start:]]]
