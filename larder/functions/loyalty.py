"""Attributes of a customer: age bounds, tenure, lifetime value, loyalty score."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from larder.functions.dates import days_between

# Lifetime value bounds of each persona, and the caps and scales of the score.
LIFETIME_BOUNDS = {
    "Student": (5000, 40000),
    "Working Professional": (20000, 120000),
    "Parent": (40000, 200000),
    "Grocery Planner": (50000, 250000),
    "Fitness Enthusiast": (30000, 100000),
    "Sick Day Customer": (2000, 15000),
    "Host / Party Buyer": (10000, 60000),
}
DEFAULT_LIFETIME_MAX = 250000
OPEN_AGE = 60


def age_bounds(text: Column) -> tuple[Column, Column]:
    """Bounds of an age group such as '18-22' or '31-51+'; 60 where the upper one is open."""
    low = F.regexp_extract(text, r"^(\d+)", 1).cast("int")
    high = F.coalesce(F.nullif(F.regexp_extract(text, r"-(\d+)", 1), F.lit("")).cast("int"), F.lit(OPEN_AGE))
    return low, high


def tenure_months(registered: Column, last_order: Column) -> Column:
    return F.greatest(F.lit(1.0), days_between(last_order, registered) / F.lit(30.0))


def lifetime_value(tenure: Column, monthly_orders: Column, basket: Column, persona: Column) -> Column:
    """Spend over the tenure, grown with tenure by up to one half, within the persona's bounds."""
    spent = F.floor(tenure * monthly_orders * basket)
    grown = F.floor(spent * F.least(F.lit(1.5), F.lit(1.0) + tenure / 24))
    low, high = basket.cast("bigint"), F.lit(DEFAULT_LIFETIME_MAX).cast("bigint")
    for name, (least, most) in LIFETIME_BOUNDS.items():
        low = F.when(persona == name, F.lit(least).cast("bigint")).otherwise(low)
        high = F.when(persona == name, F.lit(most).cast("bigint")).otherwise(high)
    return F.least(F.greatest(grown, low, basket.cast("bigint")), high)


def loyalty_score(monthly_orders: Column, basket: Column, tenure: Column, membership: Column, status: Column) -> Column:
    """0 to 100: frequency 30, basket 20, tenure 20, membership 15, activity 15."""
    frequency = F.least(F.lit(30.0), monthly_orders / F.lit(20.0) * 30)
    spending = F.least(F.lit(20.0), basket / F.lit(3000.0) * 20)
    loyalty = F.least(F.lit(20.0), tenure / 18 * 20)
    member = F.when(membership == "Quick Pass", 15).otherwise(0)
    active = F.when(status == "Active", 15).otherwise(0)
    return F.floor(frequency + spending + loyalty + member + active).cast("int")
