"""Customer value, segments, loyalty, cohorts and churn."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from larder.functions.dates import date_literal, day_of, days_between, month_of
from larder.functions.money import mean, percent, ratio
from larder.operators.ranking import top_rows, top_values
from larder.sources.retail import RetailTables


def _spending(t: RetailTables) -> DataFrame:
    """Orders and spend per customer id, combined map-side."""
    return t.orders.groupBy("customer_id").agg(
        F.count("order_id").alias("number_of_orders"), F.sum("total_order_value").alias("total_spending")
    )


def top_customers(t: RetailTables, k: int = 10) -> DataFrame:
    attributes = t.customers.select("customer_id", "customer_name", "membership", "loyalty_score")
    return (
        attributes.join(_spending(t), "customer_id")
        .orderBy(F.desc_nulls_first("total_spending"), F.desc_nulls_first("loyalty_score"), "customer_id")
        .limit(k)
    )


def top_by_membership(t: RetailTables, k: int = 3) -> DataFrame:
    spent = (
        t.customers.select("customer_id", "customer_name", "membership", "loyalty_score")
        .join(_spending(t), "customer_id")
        .drop("number_of_orders")
    )
    return top_values(spent, ["membership"], "total_spending", k, "customer_rank").orderBy(
        "membership", "customer_rank", "customer_id"
    )


def top_by_area(t: RetailTables, k: int = 5) -> DataFrame:
    spent = (
        t.customer_areas.select("customer_id", "customer_name", "area")
        .join(_spending(t), "customer_id")
        .drop("number_of_orders")
    )
    return top_values(spent, ["area"], "total_spending", k, "customer_rank").orderBy(
        "area", "customer_rank", F.desc("total_spending"), "customer_id"
    )


def lapsed(t: RetailTables, as_of: str = "2025-10-30", days: int = 90) -> DataFrame:
    cutoff = F.date_sub(date_literal(as_of), days).cast("timestamp_ntz")
    last = t.orders.groupBy("customer_id").agg(F.max("order_timestamp").alias("last_order_details"))
    return (
        t.customers.select("customer_id", "customer_name")
        .join(last.filter(F.col("last_order_details") < cutoff), "customer_id")
        .orderBy("last_order_details", "customer_id")
    )


def spend_segments(
    t: RetailTables, premium: float = 14000, gold_from: float = 8000, gold_to: float = 13999
) -> DataFrame:
    spend = F.col("total_spending")
    return (
        t.customers.select("customer_id", "customer_name")
        .join(_spending(t).drop("number_of_orders"), "customer_id", "left")
        .withColumn("total_spending", F.coalesce(spend, F.lit(0).cast("decimal(24,2)")))
        .withColumn(
            "segement",
            F.when(spend >= premium, "Premium").when(spend.between(gold_from, gold_to), "Gold").otherwise("Standard"),
        )
        .orderBy(F.desc("total_spending"), "customer_id")
    )


def purchase_frequency(t: RetailTables) -> DataFrame:
    """Orders, revenue and mean gap in days between consecutive orders.

    The gaps of a customer add up to last date minus first date, so their mean
    needs no ordering of the orders - and no task that holds a whole customer.
    """
    ts = F.col("order_timestamp")
    span = days_between(day_of(F.max(ts)), day_of(F.min(ts)))
    return (
        t.orders.groupBy("customer_id")
        .agg(
            F.count("order_id").alias("total_orders"),
            F.sum("total_order_value").alias("total_revenue"),
            ratio(span, F.count(ts) - 1, 2).alias("avg_days_beween_orders"),
        )
        .orderBy(F.desc("total_orders"), "customer_id")
    )


def churn_risk(
    t: RetailTables,
    as_of: str = "2025-09-30",
    active_as_of: str = "2025-09-3",
    active_days: int = 30,
    risk_days: int = 60,
) -> DataFrame:
    """Days since the last order, and a label.

    ``active_as_of`` may differ from ``as_of``: the label "Active" counts its
    days from there.
    """
    last = F.col("last_order_date")
    return (
        t.orders.groupBy("customer_id")
        .agg(F.max("order_timestamp").alias("_last"))
        .select("customer_id", day_of(F.col("_last")).alias("last_order_date"))
        .withColumn("days_since_last_order", days_between(date_literal(as_of), last))
        .withColumn(
            "churn_status",
            F.when(days_between(date_literal(active_as_of), last) <= active_days, "Active")
            .when(F.col("days_since_last_order") <= risk_days, "At Risk")
            .otherwise("Churned"),
        )
        .orderBy(F.desc_nulls_first("days_since_last_order"), "customer_id")
    )


def membership_value(t: RetailTables) -> DataFrame:
    spent = t.orders.groupBy("customer_id").agg(
        F.count("order_id").alias("_orders"),
        F.sum("total_order_value").alias("_revenue"),
        F.count("total_order_value").alias("_valued"),
    )
    return (
        t.customers.select("customer_id", "membership")
        .join(spent, "customer_id")
        .groupBy("membership")
        .agg(
            F.count("customer_id").alias("customers"),
            F.sum("_orders").alias("orders"),
            F.sum("_revenue").alias("revenue"),
            ratio(F.sum("_revenue"), F.sum("_valued")).alias("aov"),
        )
        .orderBy(F.desc_nulls_first("aov"), "membership")
    )


def lifetime_value(t: RetailTables) -> DataFrame:
    ts = F.col("order_timestamp")
    return (
        t.orders.groupBy("customer_id")
        .agg(
            F.count("order_id").alias("total_orders"),
            F.sum("total_order_value").alias("total_revenue"),
            mean(F.col("total_order_value"), 2).alias("avg_revenue"),
            days_between(day_of(F.max(ts)), day_of(F.min(ts))).alias("customer_lifetime_days"),
        )
        .withColumn(
            "avg_orders_per_month", ratio(F.col("total_orders") * 30, F.col("customer_lifetime_days"), 2)
        )
        .orderBy(F.desc_nulls_first("total_revenue"), "customer_id")
    )


def top_share(t: RetailTables, k: int = 10) -> DataFrame:
    spending = _spending(t)
    total = spending.agg(F.sum("total_spending")).scalar()
    top = spending.orderBy(F.desc_nulls_first("total_spending"), "customer_id").limit(k)
    return (
        top.agg(F.sum("total_spending").alias("top_10_revenue"))
        .withColumn("total_company_revenue", total)
        .withColumn(
            "top_10_revenue_contribution_percentage",
            percent(F.col("top_10_revenue"), F.col("total_company_revenue")),
        )
    )


def top_by_month(t: RetailTables, k: int = 5) -> DataFrame:
    monthly = t.orders.groupBy(month_of(F.col("order_timestamp")).alias("month"), "customer_id").agg(
        F.sum("total_order_value").alias("total_revenue")
    )
    order = [F.col("total_revenue").desc_nulls_first(), F.col("customer_id")]
    return top_rows(monthly, ["month"], order, k).orderBy(F.asc_nulls_last("month"), "rank")


def top_in_category(t: RetailTables) -> DataFrame:
    """The biggest spender of each category.

    Lines meet orders first and are summed per customer and product: they are
    shuffled once, by order, and best sellers are no hot keys of a join.
    """
    bought = (
        t.order_details.select("order_id", "product_id", "final_item_price")
        .join(t.orders.select("order_id", "customer_id"), "order_id")
        .groupBy("customer_id", "product_id")
        .agg(F.sum("final_item_price").alias("final_item_price"))
        .join(t.products.select("product_id", "category"), "product_id")
        .groupBy("category", "customer_id")
        .agg(F.sum("final_item_price").alias("total_product_revenue"))
        .join(t.customers.select("customer_id", "customer_name"), "customer_id")
    )
    order = [F.col("total_product_revenue").desc_nulls_first(), F.col("customer_id")]
    return (
        top_rows(bought, ["category"], order, 1)
        .select("category", "customer_id", "customer_name", "total_product_revenue")
        .orderBy(F.asc_nulls_last("category"))
    )


def _order_ids(lines: DataFrame) -> DataFrame:
    return lines.select("order_id").distinct()


def with_unreturned_order(t: RetailTables) -> DataFrame:
    """Customers with at least one order (having lines) without any return."""
    kept = (
        t.orders.select("order_id", "customer_id")
        .join(_order_ids(t.order_details), "order_id", "left_semi")
        .join(_order_ids(t.returns), "order_id", "left_anti")
    )
    buyers = kept.select("customer_id").distinct()
    return t.customers.select("customer_id", "customer_name").join(buyers, "customer_id", "left_semi")


def never_returned(t: RetailTables) -> DataFrame:
    """Customers with orders, none of which has a return."""
    orders = t.orders.select("order_id", "customer_id")
    buyers = orders.join(_order_ids(t.order_details), "order_id", "left_semi").select("customer_id").distinct()
    returners = orders.join(_order_ids(t.returns), "order_id", "left_semi").select("customer_id").distinct()
    return (
        t.customers.select("customer_id", "customer_name")
        .join(buyers, "customer_id", "left_semi")
        .join(returners, "customer_id", "left_anti")
    )


def bought_first_not_second(
    t: RetailTables,
    name_a: str = "Pringles Potato Chips Baked Classic Salted 90.0 g",
    name_b: str = "Fortune Chakki Atta Maida Select 15.0 kg",
) -> DataFrame:
    """Customers who bought a product of one name and never one of another name.

    One pass: every order is reduced to two flags, every customer to two flags.
    """
    wanted = t.products.filter(F.col("product_name").isin(name_a, name_b)).select(
        "product_id", (F.col("product_name") == name_a).alias("_a"), (F.col("product_name") == name_b).alias("_b")
    )
    flags = [F.max("_a").alias("_a"), F.max("_b").alias("_b")]
    buyers = (
        t.order_details.select("order_id", "product_id")
        .join(wanted, "product_id")
        .groupBy("order_id")
        .agg(*flags)
        .join(t.orders.select("order_id", "customer_id"), "order_id")
        .groupBy("customer_id")
        .agg(*flags)
        .filter(F.col("_a") & ~F.col("_b"))
    )
    return (
        t.customers.select("customer_id", "customer_name")
        .join(buyers, "customer_id", "left_semi")
        .orderBy("customer_name", "customer_id")
    )


def _active_months(t: RetailTables) -> DataFrame:
    """(customer_id, month, first_month), one row per month in which a customer ordered.

    Repeated orders of a month merge before the window, so a customer's group
    is bounded by the number of months, however many orders there are.
    """
    months = t.orders.select("customer_id", month_of(F.col("order_timestamp")).alias("month")).distinct()
    return months.withColumn("first_month", F.min("month").over(Window.partitionBy("customer_id")))


def new_and_repeat(t: RetailTables) -> DataFrame:
    new = F.col("month") == F.col("first_month")
    return (
        _active_months(t)
        .filter(F.col("customer_id").isNotNull())
        .groupBy("month")
        .agg(
            F.count(F.lit(1)).alias("total_customers"),
            F.count_if(new).alias("new_customers"),
            F.count_if(~new).alias("repeat_customers"),
        )
        .orderBy(F.asc_nulls_last("month"))
    )


def cohort_retention(t: RetailTables) -> DataFrame:
    """Active customers per first-order month and activity month.

    A cohort's size is its own activity in its first month, so it is read off
    the (cohort, month) table instead of another pass over the orders.
    """
    active = (
        _active_months(t)
        .filter(F.col("customer_id").isNotNull())
        .groupBy(F.col("first_month").alias("cohort_month"), F.col("month").alias("activity_month"))
        .agg(F.count(F.lit(1)).alias("acyive_customers"))
    )
    cohort = Window.partitionBy("cohort_month")
    size = F.max(F.when(F.col("activity_month") == F.col("cohort_month"), F.col("acyive_customers"))).over(cohort)
    return (
        active.withColumn("cohort_customers", size)
        .withColumn("retention_percentage", percent(F.col("acyive_customers"), F.col("cohort_customers")))
        .select("cohort_month", "activity_month", "cohort_customers", "acyive_customers", "retention_percentage")
        .orderBy(F.asc_nulls_last("cohort_month"), F.asc_nulls_last("activity_month"))
    )


def reactivations(t: RetailTables, gap: int = 60) -> DataFrame:
    """Orders placed at least ``gap`` days after the previous one, with the number of later orders.

    Orders of one day merge first: only the first order of a day can follow a
    gap, and later orders are counted by date. A customer's group is therefore
    bounded by the number of days, and later orders are one suffix sum.
    """
    if gap < 1:
        raise ValueError("gap must be at least one day")
    days = t.orders.groupBy("customer_id", day_of(F.col("order_timestamp")).alias("reactivation_date")).agg(
        F.count("order_id").alias("_orders")
    )
    by_day = Window.partitionBy("customer_id").orderBy("reactivation_date")
    later = by_day.rowsBetween(1, Window.unboundedFollowing)
    since = days_between(F.col("reactivation_date"), F.lag("reactivation_date").over(by_day))
    return (
        days.filter(F.col("customer_id").isNotNull())
        .select(
            "customer_id",
            "reactivation_date",
            since.alias("days_since_previous_order"),
            F.coalesce(F.sum("_orders").over(later), F.lit(0)).alias("orders_after_reactivation"),
        )
        .filter(F.col("days_since_previous_order") >= gap)
        .orderBy("reactivation_date", "customer_id")
    )


def repeat_purchase_rate(t: RetailTables) -> DataFrame:
    """Share of ordering customers with more than one order."""
    return (
        _spending(t)
        .filter(F.col("customer_id").isNotNull())
        .agg(
            F.count(F.lit(1)).alias("customers"),
            F.count_if(F.col("number_of_orders") > 1).alias("repeat_customers"),
        )
        .withColumn("repeat_purchase_rate", percent(F.col("repeat_customers"), F.col("customers")))
    )
