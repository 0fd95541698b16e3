"""Structured facts laid over extracted ones, in a fixed order of precedence."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from groundtable import schemas
from groundtable.functions.enums import GLOSSARIES, canon_enum, match_enum
from groundtable.functions.money import plan_total

#: What only a sale has; a rental's deposit stays (fixed values).
SALE_ONLY = ("sale_type", "installment_amount", "installment_frequency", "installment_years", "cash_discount_pct", "total_installment_cost")
#: What a backfill may change (fixed values).
TOUCHED = (
    "compound_name", "sale_type", "installment_amount", "installment_frequency", "installment_years", "down_payment_amount", "down_payment_pct", "cash_discount_pct",
    "total_installment_cost", "finishing_level", "delivery_status", "payment_type",
)
#: Hints that a backfill brings up to date (fixed values).
PLAN_HINTS = ("hint_monthly_installment", "hint_installment_years")


def nonzero(value: Column) -> Column:
    return F.nullif(value, F.lit(0.0))


def rent_guard(df: DataFrame, purpose: Column) -> DataFrame:
    """The fields of a sale nulled on rentals."""
    sale = F.coalesce(F.lower(purpose) != "rent", F.lit(True))
    return df.withColumns({c: F.when(sale, F.col(c)) for c in SALE_ONLY if c in df.columns})


def overlay(df: DataFrame) -> DataFrame:
    """Compound, sale type and instalments: the hint wins if there is one. Down payment: the value there wins, a hint fills null or 0.
    Its share is derived where missing, the plan's total always, and rentals lose what only sales have."""
    monthly, years = nonzero(F.col("hint_monthly_installment")), nonzero(F.col("hint_installment_years"))
    df = df.withColumns({
        "compound_name": F.coalesce(F.nullif("hint_compound_name", F.lit("")), "compound_name"),
        "sale_type": F.coalesce(match_enum(F.col("hint_ownership"), GLOSSARIES["sale_type"]), "sale_type"),
        "installment_frequency": F.when(monthly.isNotNull(), F.lit("monthly")).otherwise(F.col("installment_frequency")),
        "installment_amount": F.coalesce(monthly, "installment_amount"),
        "installment_years": F.coalesce(years, "installment_years"),
        "down_payment_amount": F.coalesce(nonzero(F.col("down_payment_amount")), nonzero(F.col("hint_down_payment"))),
    })
    share = F.round(F.col("down_payment_amount") / nonzero(F.col("price")) * 100, 2)
    df = df.withColumn("down_payment_pct", F.coalesce(nonzero(F.col("down_payment_pct")), share, F.col("down_payment_pct")))
    total = F.round(plan_total(F.col("down_payment_amount"), F.col("installment_amount"), F.col("installment_frequency"), F.col("installment_years")), 2)
    return rent_guard(df.withColumn("total_installment_cost", total), F.col("purpose"))


def backfill(records: DataFrame, listings: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Extracted records laid over again, with `changed` (names of the columns of TOUCHED that differ) and `refreshed` (whether a hint
    of the plan does), and one row of change counts.

    Running it on its own result changes nothing.
    """
    extra = F.from_json("hit_json", schemas.HIT)["extraFields"]
    hits = listings.select("listing_id", extra.alias("_extra"))
    rows = records.filter("extracted_at is not null").join(hits, "listing_id")
    before = rows.withColumns({f"_old_{c}": F.col(c) for c in (*TOUCHED, *PLAN_HINTS, "hint_ownership")})
    hinted = before.withColumns({
        "hint_ownership": F.coalesce(F.nullif("hint_ownership", F.lit("")), F.col("_extra.ownership")),
        "hint_monthly_installment": F.col("_extra.monthly_installment"),
        "hint_installment_years": F.col("_extra.installments_payment_duration_years"),
    })
    after = overlay(hinted).withColumns({c: canon_enum(c, F.nullif(F.col(c), F.lit(""))) for c in schemas.ENUMS})
    differs = lambda c: ~F.col(c).eqNullSafe(F.col(f"_old_{c}"))
    after = after.withColumns({
        "changed": F.array_compact(F.array(*(F.when(differs(c), F.lit(c)) for c in TOUCHED))), "refreshed": differs(PLAN_HINTS[0]) | differs(PLAN_HINTS[1]), "hint_ownership": F.col("_old_hint_ownership"),
    })
    after = after.drop("_extra", *(f"_old_{c}" for c in (*TOUCHED, *PLAN_HINTS, "hint_ownership")))
    after = after.withColumn("normalized_at", F.when(F.size("changed") > 0, F.current_timestamp()).otherwise(F.col("normalized_at")))
    return after, changes(after)


def change_set(after: DataFrame) -> DataFrame:
    """What a backfill has to write: of the rows with any difference, the columns that it may change."""
    return after.filter((F.size("changed") > 0) | F.col("refreshed")).select("listing_id", *TOUCHED, *PLAN_HINTS, "normalized_at")


def changes(after: DataFrame, fields: tuple[str, ...] = TOUCHED) -> DataFrame:
    """One row: in how many rows each field is among `changed`."""
    return after.agg(*(F.count_if(F.array_contains("changed", c)).alias(c) for c in fields))
