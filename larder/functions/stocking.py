"""Attributes of a stock record: velocity, reorder level, status, batch, expiry."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from larder.functions.catalogue import NOT_APPLICABLE
from larder.functions.ordering import exact, lookup

# Turnover class and highest stock of each category, reorder share of each class.
VELOCITY = {
    "Dairy, Bread & Eggs": "Fast",
    "Fruits & Vegetables": "Fast",
    "Snacks": "Fast",
    "Beverages": "Fast",
    "Pharmacy": "Fast",
    "Meat & Fish": "Medium",
    "Staples & Grocery": "Medium",
    "Frozen Foods": "Medium",
    "Household Essentials": "Medium",
    "Baby Care": "Medium",
    "Pet Care": "Medium",
    "Beauty & Personal Care": "Slow",
    "Fashion & Lifestyle": "Slow",
}
MAX_STOCK = {
    "Dairy, Bread & Eggs": 120,
    "Fruits & Vegetables": 150,
    "Snacks": 250,
    "Beverages": 200,
    "Pharmacy": 150,
    "Meat & Fish": 60,
    "Staples & Grocery": 100,
    "Frozen Foods": 80,
    "Household Essentials": 80,
    "Baby Care": 60,
    "Pet Care": 60,
    "Beauty & Personal Care": 50,
    "Fashion & Lifestyle": 40,
}
REORDER_SHARE = {"Fast": "0.30", "Medium": "0.25", "Slow": "0.20"}
DEFAULT_VELOCITY, DEFAULT_MAX_STOCK, DEFAULT_SHARE = "Medium", 50, "0.25"


def velocity(category: Column, table: dict = VELOCITY) -> Column:
    return lookup(category, table, DEFAULT_VELOCITY, "string")


def reorder_level(category: Column, velocities: dict = VELOCITY, stocks: dict = MAX_STOCK) -> Column:
    """Whole part of the class's share of the category's highest stock."""
    share = lookup(velocity(category, velocities), REORDER_SHARE, DEFAULT_SHARE, "decimal(3,2)")
    return F.floor(lookup(category, stocks, DEFAULT_MAX_STOCK, "int") * share).cast("int")


def stock_status(current: Column, level: Column) -> Column:
    return F.when(current == 0, "Out of Stock").when(current <= level, "Low Stock").otherwise("In Stock")


def zero_padded(number: Column, width: int) -> Column:
    """A number with leading zeros; longer numbers keep all their digits."""
    text = number.cast("string")
    return F.when(F.length(text) >= width, text).otherwise(F.lpad(text, width, "0"))


def batch_id(restocked: Column, sequence: Column) -> Column:
    return F.concat(F.lit("B"), F.date_format(restocked, "yyMMdd"), zero_padded(sequence, 4))


def expiry_date(perishable: Column, restocked: Column, shelf_life_days: Column, remaining: Column) -> Column:
    """Restock date plus the remaining part of the shelf life, as text; a sentinel for goods that keep."""
    days = F.floor(shelf_life_days * remaining.cast("decimal(6,4)")).cast("int")
    return F.when(perishable, F.date_format(F.date_add(restocked, days), "yyyy-MM-dd")).otherwise(NOT_APPLICABLE)


def percent_range(text: Column) -> tuple[Column, Column]:
    """The two bounds of the first 'n-m%' in a text, as fractions; 0 without one."""

    def bound(i: int) -> Column:
        found = F.regexp_extract(text, r"(\d+)-(\d+)%", i)
        return F.coalesce(F.nullif(found, F.lit("")).cast("decimal(9,2)") / 100, exact("0")).cast("decimal(9,4)")

    return bound(1), bound(2)


def percent_value(text: Column) -> Column:
    """The first 'n%' in a text as a fraction; 0 without one."""
    found = F.nullif(F.regexp_extract(text, r"(\d+)%", 1), F.lit(""))
    return F.coalesce(found.cast("decimal(9,2)") / 100, exact("0")).cast("decimal(9,4)")
