"""Quality checks on the test tables, with parameters under which the data does violate them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larder.operators import quality as q
from larder.operators.keyed import orders_and_lines, returns_of_orders, together
from larder.plans.checks import eligible_products
from larder.registered.binding import Query, bind
from larder.sources.testdata import TestTables

PAIR = ["order_id", "product_id"]


def _returned_orders(t: TestTables) -> DataFrame:
    first = t.returns.groupBy("order_id").agg(F.min("return_date").alias("first_return"))
    return t.orders.select("order_id", "customer_id").join(first, "order_id", "left")


def _reasoned(t: TestTables) -> DataFrame:
    reason = F.when(F.col("payment_method") != "1-URGENT", F.col("payment_method"))
    return t.orders.select("order_id", "order_status", reason.alias("cancellation_reason"))


def _shifted_lines(t: TestTables) -> DataFrame:
    """Lines of number 7 carry half a unit too much."""
    surplus = F.when(F.col("line_number") == 7, F.lit("0.50").cast("decimal(14,2)")).otherwise(0)
    return t.order_details.select(
        *PAIR, "line_number", "gross", "item_discount", (F.col("final_item_price") + surplus).alias("final_item_price")
    )


def typed_stores(t: TestTables) -> DataFrame:
    kind = F.element_at(F.array(F.lit("Micro"), F.lit("Medium"), F.lit("Large")), (F.col("store_id") % 3 + 1).cast("int"))
    return t.dark_stores.select(
        "store_id", kind.alias("store_type"), (F.col("store_id") % 2 == 0).alias("temperature_control")
    )


def stored_products(t: TestTables) -> DataFrame:
    storage = F.when(F.col("category") == "SMALL", "Frozen").otherwise("Ambient")
    return t.products.select("product_id", storage.alias("storage_type"))


def _report(t: TestTables) -> DataFrame:
    return together(
        orders_and_lines(
            t.orders,
            t.order_details,
            {
                "order_timestamp present": F.col("order_timestamp").isNotNull(),
                "status delivered or failed": F.col("order_status").isin("Delivered", "Failed"),
                "value in range": F.col("total_order_value").between(1000, 400000),
            },
            {"quantity in range": F.col("quantity").between(2, 49), "discount present": F.col("item_discount") > 0},
            {"customer known": ("customer_id", t.customers)},
            {"product known": t.products},
        ),
        returns_of_orders(t.returns, t.orders),
        q.report(
            "inventory",
            t.inventory,
            {
                "restock after last": F.col("next_restock_date") > F.col("last_restock_date"),
                "out of stock is zero": (F.col("inventory_status") != "Out of Stock") | (F.col("current_stock") == 0),
            },
            {},
        ),
    )


def quality() -> dict[str, Query]:
    def status_rule(t: TestTables) -> DataFrame:
        left, level = F.col("current_stock"), F.col("reorder_level")
        rules = {"Out of Stock": left == 0, "Low Stock": (left > 0) & (left <= level)}
        return q.wrong_for_status(t.inventory, "inventory_status", rules)

    sizes = {"SMALL": {"size": (1, 25)}, "MEDIUM": {"size": (10, 40)}, "LARGE": {"size": (20, 50)}}
    sizes |= {"STANDARD": {"size": (1, 50)}, "ECONOMY": {"size": (1, 45)}}
    shares = {"Micro": (0.20, 0.24), "Medium": (0.25, 0.26), "Large": (0.26, 0.35)}

    plans = {
        "dq01_unique_key": lambda t: q.repeated_keys(t.returns, ["return_id"]),
        "dq02_composite_key": lambda t: q.repeated_keys(t.order_details, PAIR),
        "dq03_repeated_rows": lambda t: q.repeated_rows(t.orders.select("customer_id", "store_id", "order_status")),
        "dq04_null_counts": lambda t: q.null_counts(_returned_orders(t), ["order_id", "customer_id", "first_return"]),
        "dq04_incomplete_rows": lambda t: q.incomplete_rows(_returned_orders(t), ["customer_id", "first_return"]),
        "dq05_foreign_key": lambda t: q.orphans(
            t.orders.select("order_id", "customer_id"), ["order_id"], t.order_details
        ),
        "dq06_composite_foreign_key": lambda t: q.orphans(t.order_details.select(*PAIR, "line_number"), PAIR, t.returns),
        "dq07_domain": lambda t: q.outside_domain(
            t.orders.select("order_id", "payment_method"), "payment_method", ["1-URGENT", "2-HIGH", "3-MEDIUM"]
        ),
        "dq08_range": lambda t: q.outside_range(t.order_details.select(*PAIR, "quantity"), "quantity", 5, 45),
        "dq09_sign": lambda t: q.negative(
            t.order_details.select(*PAIR, "item_discount", (F.col("final_item_price") - 5000).alias("net")),
            "net",
            "item_discount",
            or_zero=True,
        ),
        "dq09_whole_number": lambda t: q.fractional(t.orders.select("order_id", "total_order_value"), "total_order_value"),
        "dq10_conditional_null": lambda t: q.present_when(
            _reasoned(t), F.col("order_status") == "Delivered", "cancellation_reason"
        ),
        "dq11_column_compare": lambda t: q.comparison(
            t.order_details.select(*PAIR, (F.col("item_discount") * 12).alias("twelvefold"), "final_item_price"),
            "twelvefold",
            "<=",
            "final_item_price",
        ),
        "dq12_date_order_in_row": lambda t: q.comparison(
            t.inventory.select("store_id", "product_id", "last_restock_date", "next_restock_date"),
            "last_restock_date",
            "<",
            "next_restock_date",
        ),
        "dq13_date_order_across": lambda t: q.early_dates(
            t.returns.select("return_id", "order_id", "return_date"), "order_id", "return_date", t.orders, "order_timestamp"
        ),
        "dq14_line_arithmetic": lambda t: q.wrong_line_totals(
            _shifted_lines(t), F.col("gross"), "item_discount", "final_item_price"
        ),
        "dq15_reconciliation": lambda t: q.unreconciled(
            t.orders, "order_id", "total_order_value", t.order_details, "final_item_price"
        ),
        "dq16_status_rule": status_rule,
        "dq16_refund_for_status": lambda t: q.refunds_off_line_value(t.returns, PAIR, t.order_details),
        "dq17_refund_bound": lambda t: q.above_parent_value(
            t.returns, PAIR, "refund_amount", t.order_details, "final_item_price"
        ),
        "dq18_parent_status": lambda t: q.parent_state(
            t.returns.select("return_id", "order_id"), "order_id", t.orders, "order_status", ["Delivered"]
        ),
        "dq19_attribute_agreement": lambda t: q.disagreeing(
            t.orders.select("order_id", "rider_id", "store_id"),
            "rider_id",
            "store_id",
            t.riders.filter(F.col("rider_status") == "Active"),
        ),
        "dq19_rider_not_active": lambda t: q.parent_state(
            t.orders.select("order_id", "rider_id"), "rider_id", t.riders, "rider_status", ["Active"]
        ),
        "dq20_max_occurrences": lambda t: q.too_frequent(t.products, "product_name", 30),
        "dq21_bounds_by_type": lambda t: q.outside_type_bounds(
            t.products.select("product_id", "category", "size"), "category", sizes
        ),
        "dq22_assortment_share": lambda t: q.outside_assortment(
            t.inventory.select("store_id"),
            eligible_products(typed_stores(t), stored_products(t)),
            "store_id",
            "store_type",
            shares,
            (0.50, 0.60),
        ),
        "dq23_row_count": lambda t: q.row_count(t.dark_stores, 12),
        "dq_report": _report,
    }
    return {name: bind(plan) for name, plan in plans.items()}
