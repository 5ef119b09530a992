"""The validation rules of the retail tables, as calls of the quality operators."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larder.operators import quality as q
from larder.sources.retail import RetailTables

# Bounds and domains that the tables promise.
ESTIMATED_MINUTES = (10, 30)
ACTUAL_MINUTES = (8, 45)
MANDATORY_ORDER_COLUMNS = ("order_id", "customer_id", "store_id", "rider_id", "order_timestamp", "total_order_value")
STORE_TYPE_BOUNDS = {
    "Micro": {"service_radius_km": (2.0, 3.0), "storage_capacity": (1200, 1800), "daily_order_capacity": (600, 900)},
    "Medium": {"service_radius_km": (3.0, 5.0), "storage_capacity": (1800, 2600), "daily_order_capacity": (900, 1500)},
    "Large": {"service_radius_km": (5.0, 7.0), "storage_capacity": (2600, 3500), "daily_order_capacity": (1500, 2500)},
}
STORE_STATUSES = ("Active", "Maintenance", "Under Expansion")
RIDER_STATUSES = ("Active", "On Leave", "Inactive")
RATING_BOUNDS = (3.0, 5.0)
DELIVERY_MINUTES_BOUNDS = (10.0, 30.0)
RIDER_NAME_LIMIT = 3
ASSORTMENT_SHARES = {"Micro": (0.55, 0.65), "Medium": (0.70, 0.80), "Large": (0.85, 0.95)}
DEFAULT_ASSORTMENT = (0.50, 0.60)
COLD_STORAGE = ("Refrigerated", "Frozen")


def check_orders(t: RetailTables) -> DataFrame:
    """Violation counts of the orders table."""
    orders = t.orders
    amounts = ["total_order_value", "delivery_fee", "coupon_discount", "delivery_distance_km"]
    unrated = F.col("order_status").isin("Cancelled", "Failed") & F.col("customer_delivery_rating").isNotNull()
    reasoned = (F.col("order_status") == "Delivered") & F.col("cancellation_reason").isNotNull()
    active = t.riders.filter(F.col("rider_status") == "Active")
    return q.report(
        "orders",
        orders,
        {
            **{f"{c} not negative": F.coalesce(F.col(c) >= 0, F.lit(True)) for c in amounts},
            **{f"{c} present": F.col(c).isNotNull() for c in MANDATORY_ORDER_COLUMNS},
            "delivered without cancellation reason": ~reasoned,
            "cancelled or failed without rating": ~unrated,
            "estimated minutes in range": F.col("estimated_delivery_time").between(*ESTIMATED_MINUTES),
            "actual minutes in range": F.col("actual_delivery_time").between(*ACTUAL_MINUTES),
        },
        {
            "rows repeat": q.repeated_rows(orders),
            "order_id unique": q.repeated_keys(orders, ["order_id"]),
            "customer known": q.orphans(orders, ["customer_id"], t.customers),
            "store known": q.orphans(orders, ["store_id"], t.dark_stores),
            "rider known": q.orphans(orders, ["rider_id"], t.riders),
            "rider of the same store": q.disagreeing(orders, "rider_id", "store_id", active),
            "rider active": q.parent_state(orders, "rider_id", t.riders, "rider_status", ["Active"]),
        },
    )


def check_order_details(t: RetailTables) -> DataFrame:
    lines = t.order_details
    gross = F.col("selling_price") * F.col("quantity")
    line_ok = q.close_to(F.round(gross - F.col("item_discount"), 2), F.round("final_item_price", 2), 1e-8)
    return q.report(
        "order_details",
        lines,
        {
            **{f"{c} present": F.col(c).isNotNull() for c in lines.columns},
            "quantity positive": F.col("quantity") > 0,
            "selling_price positive": F.col("selling_price") > 0,
            "item_discount not negative": F.col("item_discount") >= 0,
            "final_item_price not negative": F.col("final_item_price") >= 0,
            "price times quantity less discount": line_ok,
        },
        {
            "order_detail_id unique": q.repeated_keys(lines, ["order_detail_id"]),
            "product once per order": q.repeated_keys(lines, ["order_id", "product_id"]),
            "product known": q.orphans(lines, ["product_id"], t.products),
            "order known": q.orphans(lines, ["order_id"], t.orders),
            "lines add up to the order": q.unreconciled(
                t.orders, "order_id", "total_order_value", lines, "final_item_price"
            ),
        },
    )


def check_returns(t: RetailTables) -> DataFrame:
    returns, pair = t.returns, ["order_id", "product_id"]
    return q.report(
        "returns",
        returns,
        {
            **{f"{c} present": F.col(c).isNotNull() for c in returns.columns},
            "refund not negative": F.col("refund_amount") >= 0,
        },
        {
            "return_id unique": q.repeated_keys(returns, ["return_id"]),
            "order known": q.orphans(returns, ["order_id"], t.orders),
            "line known": q.orphans(returns, pair, t.order_details),
            "order delivered": q.parent_state(returns, "order_id", t.orders, "order_status", ["Delivered"]),
            "refund within line value": q.above_parent_value(
                returns, pair, "refund_amount", t.order_details, "final_item_price"
            ),
            "refund follows status": q.refunds_off_line_value(returns, pair, t.order_details),
            "return after order": q.early_dates(returns, "order_id", "return_date", t.orders, "order_timestamp"),
        },
    )


def check_customers(t: RetailTables) -> DataFrame:
    return q.report(
        "customers",
        t.customers,
        {
            **{f"{c} present": F.col(c).isNotNull() for c in t.customers.columns},
            "registered before last order": F.col("registration_date") < F.col("last_order_date"),
            "lifetime value at least one basket": F.col("lifetime_value") >= F.col("average_basket_value"),
            "loyalty score in range": F.col("loyalty_score").between(0, 100),
        },
        {"customer_id unique": q.repeated_keys(t.customers, ["customer_id"])},
    )


def check_products(t: RetailTables) -> DataFrame:
    combination = ["brand", "item", "type", "variant", "flavour", "size"]
    return q.report(
        "products",
        t.products,
        {
            **{f"{c} present": F.col(c).isNotNull() for c in t.products.columns},
            "price at most retail price": F.col("selling_price") <= F.col("mrp"),
            "cost below price": F.col("cost_price") < F.col("selling_price"),
        },
        {
            "product_id unique": q.repeated_keys(t.products, ["product_id"]),
            "sku unique": q.repeated_keys(t.products, ["sku"]),
            "combination unique": q.repeated_keys(t.products, combination),
        },
    )


def check_dark_stores(t: RetailTables, expected_rows: int = 12) -> DataFrame:
    stores = t.dark_stores
    cooled = {name: {"temperature_control": True} for name in STORE_TYPE_BOUNDS}
    unique = ("store_id", "store_name", "area", "pincode")
    return q.report(
        "dark_stores",
        stores,
        {
            **{f"{c} present": F.col(c).isNotNull() for c in stores.columns},
            "store_type known": F.col("store_type").isin(*STORE_TYPE_BOUNDS),
            "current_status known": F.col("current_status").isin(*STORE_STATUSES),
        },
        {
            "row count": q.row_count(stores, expected_rows),
            **{f"{c} unique": q.repeated_keys(stores, [c]) for c in unique},
            "within bounds of the type": q.outside_type_bounds(stores, "store_type", STORE_TYPE_BOUNDS, cooled),
        },
    )


def check_riders(t: RetailTables) -> DataFrame:
    riders = t.riders
    return q.report(
        "riders",
        riders,
        {
            **{f"{c} present": F.col(c).isNotNull() for c in riders.columns},
            "rider_status known": F.col("rider_status").isin(*RIDER_STATUSES),
            "rating in range": F.col("average_rating").between(*RATING_BOUNDS),
            "minutes in range": F.col("average_delivery_time_min").between(*DELIVERY_MINUTES_BOUNDS),
        },
        {
            "rider_id unique": q.repeated_keys(riders, ["rider_id"]),
            "store known": q.orphans(riders, ["store_id"], t.dark_stores),
            "name not too frequent": q.too_frequent(riders, "rider_name", RIDER_NAME_LIMIT),
            "name once per store": q.repeated_keys(riders, ["rider_name", "store_id"]),
        },
    )


def eligible_products(stores: DataFrame, products: DataFrame) -> DataFrame:
    """Number of products each store may stock: all, or those that need no cooling."""
    everything = products.agg(F.count(F.lit(1))).scalar()
    ambient = products.agg(F.count_if(q.unless(F.col("storage_type").isin(*COLD_STORAGE)))).scalar()
    return stores.withColumn(
        "eligible", F.when(F.col("temperature_control"), everything).otherwise(ambient)
    ).select("store_id", "store_type", "eligible")


def check_inventory(t: RetailTables) -> DataFrame:
    stock = t.inventory
    left, level, status = F.col("current_stock"), F.col("reorder_level"), F.col("inventory_status")
    return q.report(
        "inventory",
        stock,
        {
            **{f"{c} present": F.col(c).isNotNull() for c in stock.columns},
            "current_stock not negative": left >= 0,
            "reorder_level not negative": level >= 0,
            "next restock after last": F.col("next_restock_date") > F.col("last_restock_date"),
            "out of stock is zero": (status != "Out of Stock") | (left == 0),
            "low stock within level": (status != "Low Stock") | ((left > 0) & (left <= level)),
        },
        {
            "rows repeat": q.repeated_rows(stock),
            "inventory_id unique": q.repeated_keys(stock, ["inventory_id"]),
            "batch_id unique": q.repeated_keys(stock, ["batch_id"]),
            "store known": q.orphans(stock, ["store_id"], t.dark_stores),
            "product known": q.orphans(stock, ["product_id"], t.products),
            "assortment within share": q.outside_assortment(
                stock,
                eligible_products(t.dark_stores, t.products),
                "store_id",
                "store_type",
                ASSORTMENT_SHARES,
                DEFAULT_ASSORTMENT,
            ),
        },
    )


def check_all(t: RetailTables, store_rows: int = 12) -> DataFrame:
    """(table_name, rule, violations) for all eight tables."""
    checks = [check_customers, check_products, check_riders, check_orders, check_order_details]
    checks += [check_returns, check_inventory]
    reports = [check(t) for check in checks] + [check_dark_stores(t, store_rows)]
    return reduce(DataFrame.unionByName, reports)
