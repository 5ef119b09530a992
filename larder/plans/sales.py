"""Company totals, revenue over time, payment methods, statuses and stores."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larder.functions.dates import day_of, month_of
from larder.functions.money import mean, percent, ratio
from larder.operators.prefix import id_levels, ordered_rank
from larder.operators.ranking import top_rows
from larder.operators.series import with_moving_mean, with_previous, with_running_sum
from larder.sources.retail import RetailTables


def _month(column: str = "order_timestamp"):
    return month_of(F.col(column)).alias("month")


def monthly_revenue(t: RetailTables) -> DataFrame:
    return t.orders.groupBy(_month()).agg(F.sum("total_order_value").alias("monthly_revenue"))


def overview(t: RetailTables) -> DataFrame:
    returned = t.returns.agg(F.count(F.lit(1))).scalar()
    lines = t.order_details.agg(F.count(F.lit(1))).scalar()
    return t.orders.agg(
        F.sum("total_order_value").alias("total_revenue"),
        F.count("order_id").alias("total_orders"),
        F.countDistinct("customer_id").alias("active_customers"),
        mean(F.col("total_order_value"), 2).alias("average_order_value"),
    ).select(
        "*",
        returned.alias("returned_items"),
        percent(returned, lines).alias("return_rate_percent"),
    )


def monthly_orders(t: RetailTables) -> DataFrame:
    return (
        t.orders.groupBy(month_of(F.col("order_timestamp")).alias("order_month"))
        .agg(F.count("order_id").alias("orders"), F.sum("total_order_value").alias("monthly_revenue"))
        .select("orders", "order_month", "monthly_revenue")
        .orderBy(F.col("order_month").asc_nulls_last())
    )


def month_over_month(t: RetailTables) -> DataFrame:
    now, before = F.col("monthly_revenue"), F.col("previous_month_revenue")
    return (
        with_previous(monthly_revenue(t), "month", "monthly_revenue", "previous_month_revenue")
        .withColumn("revenue_difference", now - before)
        .withColumn("growth_percentage", percent(now - before, before))
        .orderBy(F.col("month").asc_nulls_last())
    )


def running_revenue(t: RetailTables) -> DataFrame:
    series = with_running_sum(monthly_revenue(t), "month", "monthly_revenue", "running_total_revenue")
    # sorted on the date, then shown as a label such as "Jan 2025"
    return series.orderBy(F.asc_nulls_last("month")).select(
        F.date_format("month", "MMM yyyy").alias("month"), "monthly_revenue", "running_total_revenue"
    )


def moving_average(t: RetailTables, rows: int = 7) -> DataFrame:
    daily = t.orders.groupBy(day_of(F.col("order_timestamp")).alias("day")).agg(
        F.sum("total_order_value").alias("daily_revenue")
    )
    return with_moving_mean(daily, "day", "daily_revenue", rows, "moving_average_7_days").orderBy(
        F.asc_nulls_last("day")
    )


def payment_methods(t: RetailTables) -> DataFrame:
    return (
        t.orders.groupBy("payment_method")
        .agg(
            F.count(F.lit(1)).alias("total_orders"),
            F.sum("total_order_value").alias("total_revenue"),
            mean(F.col("total_order_value")).alias("average_order_value"),
        )
        .orderBy(F.col("total_revenue").desc_nulls_first(), "payment_method")
    )


def order_status(
    t: RetailTables, statuses: tuple[str, ...] = ("Delivered", "Cancelled", "Returned", "Failed")
) -> DataFrame:
    counted = t.orders.agg(
        F.count(F.lit(1)).alias("_all"),
        *[F.count_if(F.col("order_status") == s).alias(f"{s.lower()}_orders") for s in statuses],
    )
    shares = [percent(F.col(f"{s.lower()}_orders"), F.col("_all")).alias(f"{s.lower()}_pct") for s in statuses]
    return counted.select("*", *shares).drop("_all")


def _store_sums(t: RetailTables, *time) -> DataFrame:
    """Orders per store (and period) with the store's name; stores unknown to the dimension drop out."""
    sums = t.orders.groupBy("store_id", *time).agg(
        F.count(F.lit(1)).alias("_orders"),
        F.count("total_order_value").alias("_valued"),
        F.sum("total_order_value").alias("_revenue"),
    )
    return sums.join(t.dark_stores.select("store_id", "store_name"), "store_id")


def store_performance(t: RetailTables) -> DataFrame:
    return (
        _store_sums(t)
        .groupBy("store_name")
        .agg(
            F.sum("_orders").alias("total_orders"),
            F.sum("_revenue").alias("total_revenue"),
            ratio(F.sum("_revenue"), F.sum("_valued")).alias("average_order_value"),
        )
        .orderBy(F.desc_nulls_first("total_revenue"), F.desc("total_orders"), "store_name")
    )


def top_stores_by_month(t: RetailTables, k: int = 3) -> DataFrame:
    monthly = _store_sums(t, _month()).select(
        "month", "store_id", "store_name", F.col("_revenue").alias("total_revenue")
    )
    order = [F.col("total_revenue").desc_nulls_first(), F.col("store_id")]
    return top_rows(monthly, ["month"], order, k).orderBy(F.asc_nulls_last("month"), "rank")


def monthly_category_revenue(t: RetailTables, revenue: str = "total_revenue") -> DataFrame:
    """Revenue per month and category; lines meet orders once, the one large join.

    They are summed per month and product before the products are joined, so
    that best sellers are no hot keys there, whatever the size of that table.
    """
    months = t.orders.select("order_id", _month())
    sold = t.order_details.select("order_id", "product_id", "final_item_price").join(months, "order_id")
    categories = t.products.select("product_id", "category")
    return (
        sold.groupBy("month", "product_id")
        .agg(F.sum("final_item_price").alias("final_item_price"))
        .join(categories, "product_id")
        .groupBy("month", "category")
        .agg(F.sum("final_item_price").alias(revenue))
    )


def category_by_month(t: RetailTables) -> DataFrame:
    return monthly_category_revenue(t).orderBy(F.asc_nulls_last("month"), F.asc_nulls_last("category"))


def category_month_over_month(t: RetailTables) -> DataFrame:
    now, before = F.col("monthly_revenue"), F.col("previous_month_revenue")
    series = monthly_category_revenue(t, "monthly_revenue")
    return (
        with_previous(series, "month", "monthly_revenue", "previous_month_revenue", by=["category"])
        .withColumn("mom_growth_percentage", percent(now - before, before))
        .orderBy(F.asc_nulls_last("category"), F.asc_nulls_last("month"))
    )


def active_riders_by_store(t: RetailTables) -> DataFrame:
    """The list of active riders of each store, one numbered row per entry.

    Rows instead of an array: a store with very many riders needs no wide row.
    """
    active = t.riders.filter(F.col("rider_status") == "Active").select("store_id", "rider_id")
    return ordered_rank(active, ["store_id"], id_levels(active, "rider_id"), [F.col("rider_id")], "position")
