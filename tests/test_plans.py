"""Edge cases of the business questions that the test tables cannot show."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal as D

import shop as s

from larder.plans import customers, products, sales


def rows(df):
    return [tuple(r) for r in df.collect()]


def test_overview_counts_return_lines(spark):
    r = sales.overview(s.Shop(spark)).first()
    assert (r.total_revenue, r.total_orders, r.active_customers) == (D("355.00"), 3, 2)
    assert (r.average_order_value, r.returned_items, r.return_rate_percent) == (D("118.33"), 2, D("50.00"))


def test_spend_between_gold_and_premium_is_standard(spark):
    orders = [s.order(1, 1, "2025-04-01T10:00:00", "13999.50"), s.order(2, 2, "2025-04-01T10:00:00", "13999.00")]
    found = {r.customer_id: r.segement for r in customers.spend_segments(s.Shop(spark, orders=orders)).collect()}
    assert found == {"C000001": "Standard", "C000002": "Gold", "C000003": "Standard"}


def test_customers_without_orders_spend_nothing(spark):
    found = {r.customer_id: r.total_spending for r in customers.spend_segments(s.Shop(spark)).collect()}
    assert found["C000003"] == D("0.00")


def test_lifetime_of_no_days_has_no_rate(spark):
    orders = [s.order(i, 1, f"2025-04-01T1{i}:00:00", "10.00") for i in (1, 2)] + [s.order(5, 2, "2025-04-01T10:00:00", "1.00"),
                                                                                s.order(6, 2, "2025-05-01T10:00:00", "1.00")]
    found = {r.customer_id: (r.customer_lifetime_days, r.avg_orders_per_month)
             for r in customers.lifetime_value(s.Shop(spark, orders=orders)).collect()}
    assert found == {"C000001": (0, None), "C000002": (30, D("2.00"))}


def test_single_order_has_no_gap(spark):
    found = {r.customer_id: r.avg_days_beween_orders for r in customers.purchase_frequency(s.Shop(spark)).collect()}
    assert found == {"C000001": D("75.00"), "C000002": None}


def test_churn_label_keeps_two_reference_dates(spark):
    days = {"C000001": "2025-08-04", "C000002": "2025-08-03", "C000003": "2025-07-31"}
    orders = [s.order(i, i, f"{d}T10:00:00", "1.00") for i, d in enumerate(days.values(), 1)]
    found = {r.customer_id: (r.days_since_last_order, r.churn_status)
             for r in customers.churn_risk(s.Shop(spark, orders=orders)).collect()}
    assert found == {"C000001": (57, "Active"), "C000002": (58, "At Risk"), "C000003": (61, "Churned")}


def test_lapsed_compares_with_midnight(spark):
    orders = [s.order(1, 1, "2025-08-01T00:00:00", "1.00"), s.order(2, 2, "2025-07-31T23:59:59", "1.00")]
    assert [r.customer_id for r in customers.lapsed(s.Shop(spark, orders=orders)).collect()] == ["C000002"]


def test_returns_of_one_order_or_of_all(spark):
    shop = s.Shop(spark, returns=[s.returned(1, 1, 1, "2025-04-01T18:30:00", "90.00")])
    assert {r.customer_id for r in customers.with_unreturned_order(shop).collect()} == {"C000001", "C000002"}
    assert {r.customer_id for r in customers.never_returned(shop).collect()} == {"C000002"}


def test_pareto_drops_the_product_that_crosses(spark):
    lines = [s.line(1, 1, 1, 1, "50.00"), s.line(2, 1, 2, 1, "30.00"), s.line(3, 1, 3, 1, "15.00"), s.line(4, 1, 4, 1, "5.00")]
    shop = s.Shop(spark, order_details=lines)
    assert [r.revenue for r in products.pareto(shop).collect()] == [D("50.00"), D("30.00")]
    assert [r.revenue for r in products.pareto(shop, 79.9).collect()] == [D("50.00")]


def test_pareto_counts_equal_revenues_together(spark):
    lines = [s.line(i, 1, i, 1, "40.00") for i in (1, 2)] + [s.line(3, 1, 3, 1, "20.00")]
    out = products.pareto(s.Shop(spark, order_details=lines))
    assert [(r.running_revenue, r.cumulative_percentage) for r in out.collect()] == [(D("80.00"), D("80.00"))] * 2


def test_pairs_multiply_repeated_lines(spark):
    lines = [s.line(1, 1, 1, 1, "1.00"), s.line(2, 1, 1, 1, "1.00"), s.line(3, 1, 2, 1, "1.00")]
    assert rows(products.product_pairs(s.Shop(spark, order_details=lines))) == [("Brand Item 1", "Brand Item 2", 2)]


def test_pairs_ignore_unknown_products(spark, no_broadcast):
    lines = [s.line(i, i, p, 1, "1.00") for i in (1, 2) for p in (1, 99)] + [s.line(9, 3, p, 1, "1.00") for p in (2, 3)]
    assert rows(products.product_pairs(s.Shop(spark, order_details=lines))) == [("Brand Item 2", "Brand Item 3", 1)]


def test_basket_bands_follow_custom_order(spark):
    lines = [s.line(i, 1, 1, 1, "1.00") for i in range(7)] + [s.line(9, 2, 1, 1, "1.00")]
    lines += [s.line(20 + i, 3, 1, 1, "1.00") for i in range(4)] + [s.line(40, 99, 1, 1, "1.00")]
    assert [r.basket_type for r in products.basket_sizes(s.Shop(spark, order_details=lines)).collect()] == [
        "Small Basket", "Medium Basket", "Large Basket"]


def test_bought_first_never_second(spark):
    found = customers.bought_first_not_second(s.Shop(spark), "Brand Item 1", "Brand Item 2").collect()
    assert [r.customer_id for r in found] == ["C000002"]


def test_reactivation_merges_orders_of_a_day(spark):
    times = ["2025-01-01T10:00:00", "2025-03-02T09:00:00", "2025-03-02T18:00:00", "2025-04-30T10:00:00", "2025-07-01T10:00:00"]
    orders = [s.order(i, 1, t, "1.00") for i, t in enumerate(times, 1)]
    found = rows(customers.reactivations(s.Shop(spark, orders=orders)))
    assert found == [("C000001", dt.date(2025, 3, 2), 60, 2), ("C000001", dt.date(2025, 7, 1), 62, 0)]


def test_cohort_counts_each_customer_once_a_month(spark):
    times = [(1, "2025-04-01"), (1, "2025-04-20"), (1, "2025-06-01"), (2, "2025-04-05"), (3, "2025-06-30")]
    orders = [s.order(i, c, f"{t}T10:00:00", "1.00") for i, (c, t) in enumerate(times, 1)]
    shop, april, june = s.Shop(spark, orders=orders), dt.date(2025, 4, 1), dt.date(2025, 6, 1)
    assert rows(customers.cohort_retention(shop)) == [
        (april, april, 2, 2, D("100.00")), (april, june, 2, 1, D("50.00")), (june, june, 1, 1, D("100.00"))]
    assert rows(customers.new_and_repeat(shop)) == [(april, 2, 2, 0), (june, 2, 1, 1)]
    assert rows(customers.repeat_purchase_rate(shop)) == [(3, 1, D("33.33"))]


def test_running_revenue_shows_month_labels(spark):
    assert rows(sales.running_revenue(s.Shop(spark))) == [
        ("Apr 2025", D("265.00"), D("265.00")), ("Jun 2025", D("90.00"), D("355.00"))]


def test_growth_compares_with_the_month_before_that_is_present(spark):
    found = rows(sales.month_over_month(s.Shop(spark)))
    assert found[0][2:] == (None, None, None)
    assert found[1][1:] == (D("90.00"), D("265.00"), D("-175.00"), D("-66.04"))


def test_moving_average_is_over_rows(spark):
    orders = [s.order(i, 1, f"2025-04-{2 * i:02d}T10:00:00", f"{i}.00") for i in range(1, 10)]
    found = rows(sales.moving_average(s.Shop(spark, orders=orders)))
    assert [r[2] for r in found] == [D("1.00"), D("1.50"), D("2.00"), D("2.50"), D("3.00"), D("3.50"), D("4.00"),
                                    D("5.00"), D("6.00")]


def test_statuses_that_never_occur_are_zero(spark):
    r = sales.order_status(s.Shop(spark)).first()
    assert (r.delivered_orders, r.returned_orders, r.cancelled_pct, r.returned_pct) == (2, 0, D("33.33"), D("0.00"))


def test_no_orders_at_all(spark):
    empty = s.Shop(spark, orders=[])
    assert sales.overview(empty).first().average_order_value is None
    assert customers.top_share(empty).first().top_10_revenue_contribution_percentage is None
    assert rows(sales.month_over_month(empty)) == []
