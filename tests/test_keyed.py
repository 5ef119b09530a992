"""Keyed validation passes give the counts of the single rules."""

from __future__ import annotations

import datetime as dt
import re
from decimal import Decimal

import pytest
from conftest import SF_SMALL
from pyspark.sql import functions as F

from larder.operators import quality as q
from larder.operators.keyed import orders_and_lines, returns_of_orders
from larder.registered import oracle_sql, queries

ORDERS = "order_id bigint, customer_id bigint, order_status string, order_timestamp timestamp_ntz, total_order_value decimal(12,2)"
LINES = "order_id bigint, product_id bigint, quantity int, final_item_price decimal(12,2)"
RETURNS = "return_id string, order_id bigint, return_date timestamp_ntz"


def at(day: int) -> dt.datetime:
    return dt.datetime(2024, 5, day)


def money(x) -> Decimal | None:
    return None if x is None else Decimal(str(x))


def odd_shop(spark):
    orders = [
        (1, 1, "Delivered", at(1), 30),  # right
        (2, 1, "Delivered", at(2), 10),  # total differs
        (3, 9, "Cancelled", at(3), 5),  # no lines, unknown customer
        (4, None, "Failed", at(4), None),  # no total
        (5, 2, None, at(5), 8),  # the same key twice, another total
        (5, 2, "Delivered", at(5), 9),
        (None, 2, "Delivered", None, 1),
        (None, 2, "Delivered", None, 1),
    ]
    lines = [(1, 7, 1, 10), (1, 8, 2, 20), (2, 7, 3, 10), (2, 7, None, 1), (4, 99, 5, 4), (5, None, 6, 8), (6, 7, 7, 3)]
    lines += [(None, 7, 1, 1), (None, 7, 1, 1), (7, 8, 0, None)]
    returns = [("a", 1, at(1)), ("a", 2, at(1)), ("b", 3, at(9)), ("c", 4, at(3)), ("d", 77, at(1)), (None, None, None), (None, 5, at(6))]
    return (
        spark.createDataFrame([(*r[:4], money(r[4])) for r in orders], ORDERS),
        spark.createDataFrame([(*r[:3], money(r[3])) for r in lines], LINES),
        spark.createDataFrame(returns, RETURNS),
        spark.createDataFrame([(1,), (2,), (2,), (None,)], "customer_id bigint"),
        spark.createDataFrame([(7,), (8,)], "product_id bigint"),
    )


ORDER_RULES = {"placed": lambda: F.col("order_timestamp").isNotNull(), "large": lambda: F.col("total_order_value") >= 5}
LINE_RULES = {"quantity": lambda: F.col("quantity").between(1, 5)}


def passes(orders, lines, returns, customers, products):
    df = orders_and_lines(
        orders,
        lines,
        {n: c() for n, c in ORDER_RULES.items()},
        {n: c() for n, c in LINE_RULES.items()},
        {"customer known": ("customer_id", customers)},
        {"product known": products},
    ).unionByName(returns_of_orders(returns, orders))
    rows = [((r.table_name, r.rule), r.violations) for r in df.collect()]
    assert len(rows) == len(dict(rows))
    return dict(rows)


def singly(orders, lines, returns, customers, products):
    counts = {("orders", n): q.violating(orders, c()) for n, c in ORDER_RULES.items()}
    counts |= {("order_details", n): q.violating(lines, c()) for n, c in LINE_RULES.items()}
    counts |= {
        ("orders", "customer known"): q.orphans(orders, ["customer_id"], customers),
        ("orders", "order_id unique"): q.repeated_keys(orders, ["order_id"]),
        ("orders", "lines add up"): q.unreconciled(orders, "order_id", "total_order_value", lines, "final_item_price"),
        ("order_details", "product known"): q.orphans(lines, ["product_id"], products),
        ("order_details", "product once per order"): q.repeated_keys(lines, ["order_id", "product_id"]),
        ("returns", "return_id unique"): q.repeated_keys(returns, ["return_id"]),
        ("returns", "order delivered"): q.parent_state(returns, "order_id", orders, "order_status", ["Delivered"]),
        ("returns", "return after order"): q.early_dates(
            returns, "order_id", "return_date", orders.dropDuplicates(["order_id"]), "order_timestamp"
        ),
    }
    return {key: bad.count() for key, bad in counts.items()}


def test_counts_of_odd_tables(spark):
    shop = odd_shop(spark)
    found = passes(*shop)
    assert found == singly(*shop)
    assert found["orders", "lines add up"] == 9 and found["returns", "order delivered"] == 3


def test_counts_of_odd_tables_with_shuffled_joins(spark, no_broadcast):
    shop = odd_shop(spark)
    assert passes(*shop) == singly(*shop)


@pytest.mark.parametrize("empty", [(0,), (1,), (2,), (3, 4), (0, 1, 2, 3, 4)])
def test_empty_tables_have_a_row_for_each_rule(spark, empty):
    shop = [t.limit(0) if i in empty else t for i, t in enumerate(odd_shop(spark))]
    found = passes(*shop)
    assert len(found) == 11 and found == singly(*shop)


def test_order_with_a_third_of_all_lines(spark):
    orders, _, returns, customers, products = odd_shop(spark)
    lines = spark.range(30_000).select(
        F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id")).cast("bigint").alias("order_id"),
        (F.col("id") % 1000).alias("product_id"),
        F.lit(1).alias("quantity"),
        F.lit("1.00").cast("decimal(12,2)").alias("final_item_price"),
    )
    shop = (orders, lines, returns, customers, products)
    assert passes(*shop) == singly(*shop)


def test_report_reads_lines_three_times_and_matches_without_broadcasts(spark, db_small, no_broadcast):
    from compare import difference

    df = queries()["dq_report"](spark, SF_SMALL)
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert len(re.findall(r"Relation \[[^]]*l_orderkey", plan)) <= 3
    assert len(re.findall(r"Relation \[[^]]*o_orderkey", plan)) <= 2
    assert difference(df, db_small, oracle_sql()["dq_report"]) is None
