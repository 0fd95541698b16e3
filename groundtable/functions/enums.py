"""Closed vocabularies: what a text says, in the vocabulary's words."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from groundtable.functions.text import clean_constant, fold_letters, let

# For each field its values, in the order in which they are tried, with the phrases that mean them.
GLOSSARIES = {
    "finishing_level": {
        "core & shell": ["core & shell", "core and shell", "على المحارة", "محارة", "كور اند شل"],
        "semi-finished": ["semi finished", "semi-finished", "نص تشطيب", "نصف تشطيب"],
        "fully finished": ["fully finished", "متشطب بالكامل", "تشطيب كامل", "فوق التشطيب", "تشطيب كامل بالكامل"],
        "super lux": ["super lux", "سوبر لوكس", "سوبرلوكس"],
        "furnished": ["furnished", "مفروش", "مفروشة"],
    },
    "delivery_status": {
        "ready": ["ready", "استلام فوري", "جاهز للاستلام", "تم التسليم", "جاهزة للاستلام", "فوري"],
        "off-plan": ["off plan", "off-plan", "تحت الانشاء", "تحت الإنشاء", "تسليم 20", "على الخريطة"],
    },
    "sale_type": {
        "primary": ["primary", "من المطور", "developer", "مباشر من الشركة"],
        "resale": ["resale", "إعادة بيع", "اعادة بيع", "من المالك"],
    },
    "payment_type": {
        "cash": ["cash", "كاش", "نقدا", "نقداً"],
        "installments": ["installment", "installments", "قسط", "أقساط", "اقساط", "تقسيط"],
    },
    "installment_frequency": {
        "monthly": ["monthly", "شهري", "شهريا", "شهرياً"],
        "quarterly": ["quarterly", "ربع سنوي", "كل 3 شهور", "كل ثلاث شهور"],
        "annual": ["annual", "yearly", "سنوي", "سنويا", "سنوياً"],
    },
}
#: Values that a field may hold though no phrase means them.
ALSO_VALID = {"payment_type": ["both"]}
PROPERTY_TYPES = {
    "apartment": "apartment", "villa": "villa", "chalet": "chalet", "townhouse": "townhouse", "town house": "townhouse", "duplex": "duplex",
    "penthouse": "penthouse", "studio": "studio", "land": "land", "twin house": "villa", "twinhouse": "villa",
}


def match_enum(text: Column, glossary: dict[str, list[str]]) -> Column:
    """The first value, in the glossary's order, of which a phrase stands anywhere in the text; expects composed text."""

    def first(t: Column) -> Column:
        out = None
        for value, phrases in glossary.items():
            hit = F.lit(False)
            for p in dict.fromkeys(clean_constant(p) for p in phrases):
                hit = hit | t.contains(p)
            out = F.when(hit, F.lit(value)) if out is None else out.when(hit, F.lit(value))
        return out

    return let(fold_letters(F.lower(text)), first)


def canon_enum(field: str, text: Column) -> Column:
    """match_enum() of a field, else the text if it is a valid value already, else null."""
    valid = [*GLOSSARIES[field], *ALSO_VALID.get(field, [])]
    return F.coalesce(match_enum(text, GLOSSARIES[field]), F.when(text.isin(valid), text))


def property_type(name: Column) -> Column:
    """A category's name as a property type; unknown or null ones are other."""
    key, out = F.trim(F.lower(name)), F.lit("other")
    for k, v in PROPERTY_TYPES.items():
        out = F.when(key == k, F.lit(v)).otherwise(out)
    return out
