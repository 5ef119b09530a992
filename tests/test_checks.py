"""Each validation rule on a clean shop and on rows that break it."""

from __future__ import annotations

from decimal import Decimal as D

import pytest
import shop as s
from pyspark.sql import functions as F

from larder.operators import quality as q
from larder.plans import checks


def violations(report):
    return {(r.table_name, r.rule): r.violations for r in report.collect() if r.violations}


def test_valid_shop_passes(spark):
    report = checks.check_all(s.Shop(spark), store_rows=2)
    # a non-active rider is no violation by itself; no order uses one
    assert violations(report) == {}


def spoil(table, *extra, drop=0):
    rows = s.valid_rows()[table]
    return {table: rows[: len(rows) - drop] + list(extra)}


CASES = [
    (checks.check_orders, spoil("orders", s.order(1, 1, "2025-05-01T10:00:00", "5.00")), {"order_id unique": 1}),
    (checks.check_orders, spoil("orders", s.valid_rows()["orders"][0]), {"order_id unique": 1, "rows repeat": 1}),
    (checks.check_orders, spoil("orders", s.order(9, 7, "2025-05-01T10:00:00", "5.00")), {"customer known": 1}),
    (checks.check_orders, spoil("orders", s.order(9, 1, "2025-05-01T10:00:00", "5.00", store_id="DS009")),
     {"store known": 1, "rider of the same store": 1}),
    (checks.check_orders, spoil("orders", s.order(9, 1, "2025-05-01T10:00:00", "5.00", rider_id="RID0002")),
     {"rider of the same store": 1}),
    (checks.check_orders, spoil("orders", s.order(9, 1, "2025-05-01T10:00:00", "5.00", rider_id="RID0003")),
     {"rider active": 1}),
    (checks.check_orders, spoil("orders", s.order(9, 1, "2025-05-01T10:00:00", "-5.00", rider_id=None)),
     {"total_order_value not negative": 1, "rider_id present": 1, "rider known": 1}),
    (checks.check_orders, spoil("orders", s.order(9, 1, "2025-05-01T10:00:00", "5.00", cancellation_reason="x")),
     {"delivered without cancellation reason": 1}),
    (checks.check_orders, spoil("orders", s.order(9, 1, "2025-05-01T10:00:00", "5.00", order_status="Failed")),
     {"cancelled or failed without rating": 1}),
    (checks.check_orders, spoil("orders", s.order(9, 1, "2025-05-01T10:00:00", "5.00", estimated_delivery_time=31,
                                                  actual_delivery_time=None)),
     {"estimated minutes in range": 1, "actual minutes in range": 1}),
    (checks.check_order_details, spoil("order_details", s.line(4, 3, 4, 1, "0.00")),
     {"order_detail_id unique": 1, "selling_price positive": 1}),
    (checks.check_order_details, spoil("order_details", s.line(9, 3, 3, 1, "1.00", "1.00")),
     {"product once per order": 1}),
    (checks.check_order_details, spoil("order_details", s.line(9, 3, 8, 1, "1.00")),
     {"product known": 1, "lines add up to the order": 1}),
    (checks.check_order_details, spoil("order_details", s.line(9, 8, 3, 1, "1.00")),
     {"order known": 1, "lines add up to the order": 1}),
    (checks.check_order_details, spoil("order_details", drop=1), {"lines add up to the order": 1}),
    (checks.check_order_details, spoil("order_details", s.line(9, 3, 4, 1, "0.01", final_item_price=D("0.02"))),
     {"price times quantity less discount": 1, "lines add up to the order": 1}),
    (checks.check_returns, spoil("returns", s.returned(1, 1, 1, "2025-04-01T18:30:00", "90.00")), {"return_id unique": 1}),
    (checks.check_returns, spoil("returns", s.returned(9, 1, 4, "2025-04-01T18:30:00", "0.00")), {"line known": 1}),
    (checks.check_returns, spoil("returns", s.returned(9, 3, 3, "2025-06-15T20:00:00", "90.00")), {"order delivered": 1}),
    (checks.check_returns, spoil("returns", s.returned(9, 1, 1, "2025-04-01T18:29:59", "91.00")),
     {"refund within line value": 1, "refund follows status": 1, "return after order": 1}),
    (checks.check_returns, spoil("returns", s.returned(9, 1, 1, "2025-04-01T18:30:00", "1.00", "Pending")),
     {"refund follows status": 1}),
    (checks.check_customers, spoil("customers", s.customer(1, loyalty_score=101, lifetime_value=10)),
     {"customer_id unique": 1, "loyalty score in range": 1, "lifetime value at least one basket": 1}),
    (checks.check_customers, spoil("customers", s.customer(9, registration_date=s.day("2025-05-01"), area=None)),
     {"registered before last order": 1, "area present": 1}),
    (checks.check_products, spoil("products", s.product(9, sku="SKU-1", selling_price=D("101.00"), cost_price=D("101.00"))),
     {"sku unique": 1, "price at most retail price": 1, "cost below price": 1}),
    (checks.check_products, spoil("products", s.product(9, item="Item 1")), {"combination unique": 1}),
    (checks.check_riders, spoil("riders", s.rider(1, 9, rider_status="Gone", average_rating=D("2.9"))),
     {"rider_id unique": 1, "store known": 1, "rider_status known": 1, "rating in range": 1}),
    (checks.check_riders, spoil("riders", *[s.rider(i, 1, rider_name="Rider 1") for i in range(5, 8)]),
     {"name not too frequent": 1, "name once per store": 1}),
    (checks.check_inventory, spoil("inventory", s.stock(6, 2, 4)), {"assortment within share": 1}),
    (checks.check_inventory, spoil("inventory", s.stock(5, 2, 3, current_stock=3, inventory_status="Out of Stock",
                                                       next_restock_date=s.day("2025-03-20")), drop=1),
     {"out of stock is zero": 1, "next restock after last": 1}),
    (checks.check_inventory, spoil("inventory", s.stock(5, 2, 3, current_stock=0, inventory_status="Low Stock"), drop=1),
     {"low stock within level": 1}),
]


@pytest.mark.parametrize("case", range(len(CASES)))
def test_broken_rows_are_counted(spark, case):
    check, tables, expected = CASES[case]
    found = {rule: n for (_, rule), n in violations(check(s.Shop(spark, **tables))).items()}
    assert found == expected


def test_stores_against_bounds_of_their_type(spark):
    stores = [s.store(1, "Micro"), s.store(2, "Large", temperature_control=False), s.store(3, "Micro", storage_capacity=1801),
              s.store(4, "Large", store_type="Mega")]
    found = violations(checks.check_dark_stores(s.Shop(spark, dark_stores=stores), expected_rows=12))
    assert {rule: n for (_, rule), n in found.items()} == {
        "store_type known": 1, "row count": 1, "within bounds of the type": 3,
    }


def test_null_never_confirms_a_rule(spark):
    df = spark.createDataFrame([(1, None), (2, 5), (3, 50)], "id int, v int")
    assert [r.id for r in q.outside_range(df, "v", 1, 10).orderBy("id").collect()] == [1, 3]
    assert [r.id for r in q.outside_domain(df, "v", [5]).orderBy("id").collect()] == [1, 3]
    assert [r.id for r in q.comparison(df, "v", "<=", "v").collect()] == [1]


def test_unreconciled_names_each_rule(spark):
    orders = spark.createDataFrame([(1, D("10.00")), (2, D("5.00")), (3, D("7.00"))], "order_id int, total decimal(14,2)")
    lines = spark.createDataFrame(
        [(1, D("4.00")), (1, D("6.01")), (2, D("4.98")), (9, D("1.00"))], "order_id int, final decimal(14,2)"
    )
    out = q.unreconciled(orders, "order_id", "total", lines, "final").collect()
    assert {r.order_id: r.rule for r in out} == {2: "total differs", 3: "without lines", 9: "without parent"}


def test_tolerance_grows_with_the_amount(spark):
    df = spark.createDataFrame([(1, D("2000.00"), D("2000.01")), (2, D("20.00"), D("20.01"))],
                               "id int, gross decimal(14,2), final decimal(14,2)")
    df = df.withColumn("item_discount", F.lit(0).cast("decimal(14,2)"))
    assert [r.id for r in q.wrong_line_totals(df, F.col("gross"), "item_discount", "final").collect()] == [2]
