"""Attributes of an order: slot, peak flag, delivery time and fee, totals, payment, rating, refund."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Business constants of an order.
PEAK_HOURS = [12, 13, 14, 18, 19, 20, 21]
WEATHER_TIME_FACTOR = {"Rain": 1.2, "Heavy Rain": 1.5}
WEATHER_SURGE_FEE = {"Rain": "10.00", "Heavy Rain": "25.00"}
ESTIMATED_MIN, ESTIMATED_MAX = 10, 30
FREE_DISTANCE_KM, FEE_PER_KM, PEAK_FEE = "4.0", "10.00", "10.00"
FESTIVAL_MINUTES, PEAK_MINUTES, FESTIVAL_BASKET_FACTOR = 5, 5, "1.2"
COUPON_CAP = "0.40"
REFUND_SHARE = {"Approved": "1.0", "Rejected": "0.0", "Pending": "0.0"}


def exact(text: str, kind: str = "decimal(6,2)") -> Column:
    return F.lit(text).cast(kind)


def lookup(key: Column, table: dict, default, kind: str) -> Column:
    """Value of a small fixed table, or the default."""
    chain = F.lit(default).cast(kind)
    for name, value in table.items():
        chain = F.when(key == name, F.lit(value).cast(kind)).otherwise(chain)
    return chain


def delivery_slot(ts: Column) -> Column:
    """The clock hour of a timestamp and the next one, such as '06:00 PM - 07:00 PM'."""

    def label(hour: Column) -> Column:
        half = F.when(hour < 12, " AM").otherwise(" PM")
        return F.concat(F.lpad(((hour + 11) % 12 + 1).cast("string"), 2, "0"), F.lit(":00"), half)

    start = F.hour(ts)
    return F.concat_ws(" - ", label(start), label((start + 1) % 24))


def yes_no(flag: Column) -> Column:
    return F.when(flag, "Yes").otherwise("No")


def peak_hour(ts: Column) -> Column:
    return yes_no(F.hour(ts).isin(PEAK_HOURS))


def estimated_minutes(km: Column, weather: Column, peak: Column, festival: Column) -> Column:
    """Base and distance, stretched by weather, plus peak and festival minutes, within bounds."""
    factor = lookup(weather, WEATHER_TIME_FACTOR, 1.0, "double")
    added = F.when(peak == "Yes", PEAK_MINUTES).otherwise(0) + F.when(festival == "Yes", FESTIVAL_MINUTES).otherwise(0)
    minutes = (F.lit(10.0) + km.cast("double") * 2.5) * factor + added
    bounded = F.greatest(F.lit(float(ESTIMATED_MIN)), F.least(F.lit(float(ESTIMATED_MAX)), minutes))
    return F.rint(bounded).cast("int")


def delivery_fee(km: Column, weather: Column, peak: Column) -> Column:
    beyond = F.greatest(km.cast("decimal(6,2)") - exact(FREE_DISTANCE_KM), exact("0"))
    surge = lookup(weather, WEATHER_SURGE_FEE, "0.00", "decimal(6,2)")
    rush = F.when(peak == "Yes", exact(PEAK_FEE)).otherwise(exact("0"))
    return F.bround(beyond * exact(FEE_PER_KM) + surge + rush, 2).cast("decimal(14,2)")


def festive_basket(basket: Column, festival: Column) -> Column:
    return basket * F.when(festival == "Yes", exact(FESTIVAL_BASKET_FACTOR)).otherwise(exact("1.0"))


def applied_coupon(basket: Column, fee: Column, coupon: Column) -> Column:
    """The coupon up to its share of the basket; none if it would leave nothing to pay."""
    capped = F.least(coupon.cast("decimal(20,6)"), (basket * exact(COUPON_CAP)).cast("decimal(20,6)"))
    return F.when(basket + fee - capped <= 0, F.lit(0).cast("decimal(20,6)")).otherwise(capped)


def order_total(basket: Column, fee: Column, discount: Column) -> Column:
    return F.bround(basket + fee - discount, 2).cast("decimal(14,2)")


def payment_status(status: Column, method: Column) -> Column:
    """Payment status; a cancelled order paid in advance may be either of two."""
    cash = method == "Cash on Delivery"
    return (
        F.when(status == "Delivered", "Paid")
        .when(cash, "Pending")
        .when(status == "Cancelled", "Refunded or Pending")
        .otherwise("Refunded")
    )


def adjusted_rating(base: Column, status: Column, weather: Column, estimated: Column, actual: Column) -> Column:
    """No rating without delivery; late deliveries cap it, punctual ones in heavy rain lift it."""
    late = F.when(actual > estimated + 15, F.least(base, F.lit(3))).otherwise(base)
    lifted = F.when((weather == "Heavy Rain") & (actual <= estimated), F.greatest(late, F.lit(4))).otherwise(late)
    return F.when(~status.isin("Cancelled", "Failed"), lifted)


def refund_amount(line_value: Column, status: Column) -> Column:
    share = lookup(status, REFUND_SHARE, None, "decimal(3,1)")
    return F.bround(line_value * share, 2).cast("decimal(14,2)")


def return_date(ts: Column, offset_days: Column) -> Column:
    """The order's timestamp moved by whole days."""
    return ts + F.make_dt_interval(days=offset_days)
