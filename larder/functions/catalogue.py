"""Attributes of a product: SKU base, display name, prices, flags."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Storage types that spoil, seasonal keywords, sentinel text.
PERISHABLE_STORAGE = ["Refrigerated", "Frozen"]
SEASONAL_WORDS = ["mango", "strawberry", "winter", "summer", "monsoon"]
NOT_APPLICABLE = "Not Applicable"


def _filled(text: Column) -> Column:
    return text.isNotNull() & (text != "")


def size_text(size: Column) -> Column:
    """A size with at least one decimal: 90 is shown as 90.0."""
    return size.cast("double").cast("string")


def sku_base(brand: Column, item: Column, variant: Column, size: Column) -> Column:
    """Three letters each of brand, item and variant, and the digits of the size."""

    def code(text: Column) -> Column:
        return F.substring(F.regexp_replace(F.upper(text), "[^A-Z0-9]", ""), 1, 3)

    kind = F.when(_filled(variant), code(variant)).otherwise("REG")
    return F.concat_ws("-", code(brand), code(item), kind, F.replace(size_text(size), F.lit("."), F.lit("")))


def display_name(
    brand: Column, item: Column, kind: Column, variant: Column, flavour: Column, size: Column, unit: Column
) -> Column:
    """Words of a product without repetition, then size and unit.

    The item is left out when its type already says it; a word that appeared
    before, in any case, is not repeated.
    """
    said_by_type = _filled(kind) & F.contains(F.lower(kind), F.lower(item))
    parts = F.filter(F.array(brand, F.when(said_by_type, F.lit(None)).otherwise(item), kind, variant, flavour), _filled)
    lowered = F.transform(parts, F.lower)
    fresh = F.filter(parts, lambda word, i: F.array_position(lowered, F.lower(word)) == i + 1)
    return F.concat_ws(" ", F.array_join(fresh, " "), size_text(size), unit)


def retail_price(base: Column) -> Column:
    """A whole price; above 30 it is moved to an ending in 5 or 9."""
    price = F.bround(base, 0).cast("bigint")
    last = F.pmod(price, F.lit(10))
    tens = price - last
    ending = F.when(last < 4, tens - 1).when(last < 8, tens + 5).otherwise(tens + 9)
    return F.when(price > 30, ending).otherwise(price).cast("decimal(14,2)")


def selling_price(mrp: Column, discount_pct: Column) -> Column:
    reduced = F.bround(mrp * (100 - discount_pct.cast("decimal(9,4)")) / 100, 2).cast("decimal(14,2)")
    return F.when(reduced >= mrp, mrp).otherwise(reduced)


def effective_discount(mrp: Column, discount_pct: Column) -> Column:
    """The discount in percent to one decimal; zero if rounding left no discount."""
    reduced = F.bround(mrp * (100 - discount_pct.cast("decimal(9,4)")) / 100, 2)
    shown = F.bround(discount_pct.cast("decimal(9,4)"), 1).cast("decimal(4,1)")
    return F.when(reduced >= mrp, F.lit(0).cast("decimal(4,1)")).otherwise(shown)


def cost_price(price: Column, margin: Column) -> Column:
    cost = F.bround(price * (1 - margin.cast("decimal(9,4)")), 2).cast("decimal(14,2)")
    return F.when(cost >= price, F.bround(price * F.lit("0.90").cast("decimal(3,2)"), 2).cast("decimal(14,2)")).otherwise(
        cost
    )


def is_perishable(storage: Column, category: Column) -> Column:
    fresh = F.contains(category, F.lit("Fruits")) | F.contains(category, F.lit("Vegetables"))
    return storage.isin(PERISHABLE_STORAGE) | fresh


def launch_status(name: Column, given: Column) -> Column:
    return F.when(F.lower(name).rlike("|".join(SEASONAL_WORDS)), "Seasonal").otherwise(given)


def blank_to_sentinel(text: Column) -> Column:
    return F.when(text.isNull() | text.rlike(r"^\s*$"), NOT_APPLICABLE).otherwise(text)
