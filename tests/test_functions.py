"""Scalar derivations on hand-made values."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from larder.functions import catalogue, dates, loyalty, money, ordering, stocking
from larder.operators import derive, profile


def values(spark, column):
    return spark.range(1).select(column.alias("v")).first().v


def lit(value, kind="decimal(14,2)"):
    return F.lit(value).cast(kind)


@pytest.mark.parametrize("hour,label", [(0, "12:00 AM - 01:00 AM"), (11, "11:00 AM - 12:00 PM"), (12, "12:00 PM - 01:00 PM"),
                                        (18, "06:00 PM - 07:00 PM"), (23, "11:00 PM - 12:00 AM")])
def test_delivery_slot(spark, hour, label):
    assert values(spark, ordering.delivery_slot(F.lit(f"2025-04-01 {hour:02d}:59:59").cast("timestamp_ntz"))) == label


@pytest.mark.parametrize("km,weather,peak,festival,minutes", [
    ("0.50", "Clear", "No", "No", 11), ("3.00", "Clear", "No", "No", 18), ("3.00", "Rain", "No", "No", 21),
    ("8.00", "Heavy Rain", "Yes", "Yes", 30), ("1.00", "Clear", "Yes", "Yes", 22), ("0.20", "Clear", "No", "No", 10)])
def test_estimated_minutes_round_half_to_even(spark, km, weather, peak, festival, minutes):
    out = ordering.estimated_minutes(lit(km, "decimal(4,2)"), F.lit(weather), F.lit(peak), F.lit(festival))
    assert values(spark, out) == minutes


@pytest.mark.parametrize("km,weather,peak,fee", [("4.00", "Clear", "No", "0.00"), ("4.25", "Rain", "No", "12.50"),
                                                 ("8.00", "Heavy Rain", "Yes", "75.00")])
def test_delivery_fee(spark, km, weather, peak, fee):
    assert values(spark, ordering.delivery_fee(lit(km, "decimal(4,2)"), F.lit(weather), F.lit(peak))) == D(fee)


def test_coupon_is_capped_and_dropped(spark):
    assert values(spark, ordering.applied_coupon(lit("100"), lit("0"), lit("50"))) == D("40")
    assert values(spark, ordering.applied_coupon(lit("100"), lit("0"), lit("30"))) == D("30")
    assert values(spark, ordering.applied_coupon(lit("0"), lit("0"), lit("30"))) == D("0")


@pytest.mark.parametrize("status,method,expected", [
    ("Delivered", "Cash on Delivery", "Paid"), ("Cancelled", "Cash on Delivery", "Pending"),
    ("Cancelled", "UPI", "Refunded or Pending"), ("Failed", "UPI", "Refunded"), ("Failed", "Cash on Delivery", "Pending")])
def test_payment_status(spark, status, method, expected):
    assert values(spark, ordering.payment_status(F.lit(status), F.lit(method))) == expected


@pytest.mark.parametrize("base,status,weather,estimated,actual,expected", [
    (5, "Delivered", "Clear", 20, 36, 3), (5, "Delivered", "Clear", 20, 35, 5), (1, "Delivered", "Heavy Rain", 20, 20, 4),
    (2, "Delivered", "Clear", 20, 36, 2), (5, "Cancelled", "Clear", 20, 20, None), (5, "Failed", "Heavy Rain", 20, 20, None)])
def test_rating(spark, base, status, weather, estimated, actual, expected):
    out = ordering.adjusted_rating(F.lit(base), F.lit(status), F.lit(weather), F.lit(estimated), F.lit(actual))
    assert values(spark, out) == expected


def test_default_reorder_levels(spark):
    df = spark.createDataFrame([("Snacks",), ("Pet Care",), ("Fashion & Lifestyle",), ("Toys",)], "c string")
    out = df.select("c", stocking.velocity(F.col("c")).alias("v"), stocking.reorder_level(F.col("c")).alias("r"))
    assert {r.c: (r.v, r.r) for r in out.collect()} == {
        "Snacks": ("Fast", 75), "Pet Care": ("Medium", 15), "Fashion & Lifestyle": ("Slow", 8), "Toys": ("Medium", 12)}


def test_batch_numbers_grow_beyond_four_digits(spark):
    day = F.lit("2025-04-01").cast("date")
    assert values(spark, stocking.batch_id(day, F.lit(7))) == "B2504010007"
    assert values(spark, stocking.batch_id(day, F.lit(12345))) == "B25040112345"


def test_expiry_truncates_remaining_life(spark):
    day = F.lit("2025-03-20").cast("date")
    assert values(spark, stocking.expiry_date(F.lit(True), day, F.lit(5), lit("0.75"))) == "2025-03-23"
    assert values(spark, stocking.expiry_date(F.lit(False), day, F.lit(5), lit("0.75"))) == "Not Applicable"


def test_percent_texts(spark):
    low, high = stocking.percent_range(F.lit("Micro stores stock 55-65% of all, Large 85-95%"))
    assert (values(spark, low), values(spark, high)) == (D("0.5500"), D("0.6500"))
    assert values(spark, stocking.percent_range(F.lit("none"))[1]) == D("0.0000")
    assert values(spark, stocking.percent_value(F.lit("Calculate as 30% of it"))) == D("0.3000")


@pytest.mark.parametrize("text,bounds", [("18-22", (18, 22)), ("31-51+", (31, 51)), ("60+", (60, 60)), ("45", (45, 60))])
def test_age_bounds(spark, text, bounds):
    low, high = loyalty.age_bounds(F.lit(text))
    assert (values(spark, low), values(spark, high)) == bounds


def test_lifetime_value_stays_within_persona(spark):
    def worth(tenure, orders, basket, persona):
        return values(spark, loyalty.lifetime_value(F.lit(float(tenure)), F.lit(orders), F.lit(basket), F.lit(persona)))

    assert worth(1, 1, 100, "Student") == 5000
    assert worth(12, 10, 1000, "Student") == 40000
    assert worth(12, 2, 500, "Student") == 18000
    assert worth(1, 1, 700, "Unlisted") == 729
    assert worth(1, 0, 700, "Unlisted") == 700


def test_loyalty_score_is_capped(spark):
    out = loyalty.loyalty_score(F.lit(40), F.lit(9000), F.lit(36.0), F.lit("Quick Pass"), F.lit("Active"))
    assert values(spark, out) == 100
    assert values(spark, loyalty.loyalty_score(F.lit(10), F.lit(1500), F.lit(9.0), F.lit("x"), F.lit("y"))) == 35


def test_display_names(spark):
    def name(*parts):
        return values(spark, catalogue.display_name(*[F.lit(p).cast("string") for p in parts[:5]], lit(parts[5]), F.lit(parts[6])))

    assert name("Brand", "Milk", "Cow Milk", "Toned", None, "500", "ml") == "Brand Cow Milk Toned 500.0 ml"
    assert name("Brand", "Chips", "Baked", "baked", "Salted", "90", "g") == "Brand Chips Baked Salted 90.0 g"
    assert name("Salt", "Salt", None, None, "", "1.5", "kg") == "Salt 1.5 kg"


def test_sku_base(spark):
    def sku(*parts):
        return values(spark, catalogue.sku_base(F.lit(parts[0]), F.lit(parts[1]), F.lit(parts[2]).cast("string"), lit(parts[3])))

    assert sku("Farm Fresh", "T-Shirt", "Regular", "500") == "FAR-TSH-REG-5000"
    assert sku("24/7", "Apple", None, "1.5") == "247-APP-REG-15"
    assert sku("A", "B", "", "2") == "A-B-REG-20"


@pytest.mark.parametrize("base,price", [("25.4", 25), ("30.4", 30), ("31.2", 29), ("34.2", 35), ("37.9", 39), ("42.5", 39),
                                        ("43.5", 45), ("100.0", 99)])
def test_retail_price_endings(spark, base, price):
    assert values(spark, catalogue.retail_price(lit(base))) == D(price)


def test_price_ladder_never_inverts(spark):
    assert values(spark, catalogue.selling_price(lit("99"), lit("12.5"))) == D("86.62")
    assert values(spark, catalogue.selling_price(lit("99"), lit("0"))) == D("99.00")
    assert values(spark, catalogue.effective_discount(lit("99"), lit("0"))) == D("0.0")
    assert values(spark, catalogue.cost_price(lit("10"), lit("0"))) == D("9.00")
    assert values(spark, catalogue.cost_price(lit("80"), lit("0.25"))) == D("60.00")


def test_product_flags(spark):
    assert values(spark, catalogue.is_perishable(F.lit("Ambient"), F.lit("Fruits & Vegetables"))) is True
    assert values(spark, catalogue.is_perishable(F.lit("Ambient"), F.lit("Snacks"))) is False
    assert values(spark, catalogue.launch_status(F.lit("Frooti MANGO 1.0 L"), F.lit("Regular"))) == "Seasonal"
    assert values(spark, catalogue.blank_to_sentinel(F.lit("\t "))) == "Not Applicable"


def test_ratio_and_tolerance(spark):
    assert values(spark, money.ratio(lit("1"), F.lit(0))) is None
    assert values(spark, money.ratio(lit("2.005"), F.lit(1), 2)) == D("2.01")
    assert values(spark, money.percent(lit("-1"), lit("8"), 1)) == D("-12.5")
    assert values(spark, money.close_to(lit("100.00"), lit("100.01"), 0.01)) is True
    assert values(spark, dates.date_literal("2025-09-3")) == dt.date(2025, 9, 3)


def test_allocation_hands_out_cents_in_order(spark):
    lines = spark.createDataFrame([(1, i, D("10.00")) for i in (1, 2, 3)], "o long, p long, gross decimal(14,2)")
    targets = spark.createDataFrame([(1, D("20.00"))], "o long, target decimal(14,2)")
    out = derive.allocate_discount(lines, targets, "o", "p", "gross", "target")
    assert {r.p: (r.item_discount, r.final_item_price) for r in out.collect()} == {
        3: (D("3.34"), D("6.66")), 2: (D("3.33"), D("6.67")), 1: (D("3.33"), D("6.67"))}


def test_profile_of_nulls_and_repeats(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (2, None)], "id int, v string")
    found = {r.measure: r.found for r in profile.gaps_and_repeats(df, {"id": ["id"]}).collect()}
    assert found == {"nulls": 1, "repeated rows": 1, "id": 1}
    shares = {r.v: r.share_pct for r in profile.value_shares(df, "v").collect()}
    assert shares == {"a": D("100.00")}
