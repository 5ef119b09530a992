"""Business questions on the test tables."""

from __future__ import annotations

from larder.plans import customers, products, sales
from larder.registered.binding import Query, bind

#: A period that starts and ends within a month.
PERIOD = ("1998-03-15", "1999-08-10")


def business() -> dict[str, Query]:
    return {
        "m1q1_overview": bind(sales.overview),
        "m1q2_monthly_orders": bind(sales.monthly_orders),
        "m1q3_avg_basket": bind(products.average_basket),
        "m1q4_top_products": bind(products.top_products),
        "m1q5_no_return_customers": bind(customers.with_unreturned_order),
        "m1q5b_never_returned": bind(customers.never_returned),
        "m2q1_top_customers": bind(customers.top_customers),
        "m2q2_top3_by_membership": bind(customers.top_by_membership),
        "m2q3_lapsed_90d": bind(customers.lapsed, as_of="2001-08-01"),
        "m2q4_top5_by_area": bind(customers.top_by_area),
        "m2q5_above_avg_products": bind(products.above_average),
        "m3q1_mom_revenue": bind(sales.month_over_month),
        "m3q2_running_revenue": bind(sales.running_revenue),
        "m3q3_moving_avg_7d": bind(sales.moving_average),
        "m3q4_top_product_by_category": bind(products.best_in_category),
        "m3q5_pareto_80": bind(products.pareto),
        "m4q1_spend_segments": bind(
            customers.spend_segments, premium=3_000_000, gold_from=2_000_000, gold_to=2_999_999
        ),
        "m4q2_payment_methods": bind(sales.payment_methods),
        "m4q3_order_status": bind(sales.order_status),
        "m4q4_store_performance": bind(sales.store_performance),
        "m4q5_monthly_category": bind(sales.category_by_month),
        "m5q1_new_vs_repeat": bind(customers.new_and_repeat),
        "m5q2_top5_monthly": bind(customers.top_by_month),
        "m5q3_purchase_frequency": bind(customers.purchase_frequency),
        "m5q4_churn_risk": bind(customers.churn_risk, as_of="2001-08-01", active_as_of="2001-07-05"),
        "m5q5_membership_aov": bind(customers.membership_value),
        "m6q1_penetration": bind(products.penetration),
        "m6q2_category_share": bind(products.category_share),
        "m6q3_discount_bands": bind(products.discount_bands, low=1000, high=3000),
        "m6q4_underperformers": bind(products.underperformers),
        "m6q5_category_mom": bind(sales.category_month_over_month),
        "m7q1_product_pairs": bind(products.product_pairs),
        "m7q2_basket_sizes": bind(products.basket_sizes),
        "m7q3_top3_stores_monthly": bind(sales.top_stores_by_month),
        "m7q4_top_customer_by_category": bind(customers.top_in_category),
        "m7q5_bought_a_not_b": bind(customers.bought_first_not_second, name_a="red plate", name_b="small widget"),
        "m8q1_cohort_retention": bind(customers.cohort_retention),
        "m8q2_reactivation": bind(customers.reactivations),
        "m8q3_clv": bind(customers.lifetime_value),
        "m8q4_underperformers_again": bind(products.underperformers),
        "m8q4b_repeat_purchase_rate": bind(customers.repeat_purchase_rate),
        "m8q5_top10_share": bind(customers.top_share),
        "io5_period_overview": bind(sales.overview, period=PERIOD),
        "io5_period_monthly_orders": bind(sales.monthly_orders, period=PERIOD),
        "io5_period_monthly_category": bind(sales.category_by_month, period=PERIOD),
    }
