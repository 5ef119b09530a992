"""Twins of the business questions."""

from __future__ import annotations

from larder.oracle.dialect import div, money, query, whole

PRODUCT_SUMS = "SELECT product_id, SUM(final_c) AS rev, SUM(quantity) AS units FROM lines GROUP BY product_id"
CUSTOMER_SUMS = "SELECT customer_id, COUNT(*) AS n, SUM(value_c) AS spent FROM sales GROUP BY customer_id"
MONTH_SUMS = "SELECT month, COUNT(*) AS n, SUM(value_c) AS rev FROM sales GROUP BY month"
MONTH_CATEGORY = """SELECT month, category, SUM(final_c) AS rev
    FROM lines JOIN sales USING (order_id) JOIN products USING (product_id) GROUP BY ALL"""
FIRST_MONTHS = "SELECT customer_id, MIN(month) AS first_month FROM sales GROUP BY customer_id"


def _lagging(order_by: str) -> str:
    return f"""SELECT *, LAG(rev) OVER ({order_by}) AS prev FROM series"""


def business() -> dict[str, str]:
    sql: dict[str, str] = {}

    sql["m1q1_overview"] = query(
        f"""SELECT {money('SUM(value_c)')} AS total_revenue, COUNT(*) AS total_orders,
            COUNT(DISTINCT customer_id) AS active_customers, {div('SUM(value_c)', '100 * COUNT(*)', 2)} AS average_order_value,
            ANY_VALUE(rets) AS returned_items, {div('100 * ANY_VALUE(rets)', 'ANY_VALUE(nlines)', 2)} AS return_rate_percent
        FROM sales, (SELECT COUNT(*) AS rets FROM returned), (SELECT COUNT(*) AS nlines FROM lines)"""
    )
    sql["m1q2_monthly_orders"] = query(
        f"SELECT n AS orders, month AS order_month, {money('rev')} AS monthly_revenue FROM series", series=MONTH_SUMS
    )
    sql["m1q3_avg_basket"] = query(
        f"SELECT {div('SUM(quantity)', 'COUNT(DISTINCT order_id)', 6)} AS average_basketsize FROM lines"
    )
    sql["m1q4_top_products"] = query(
        f"""SELECT product_name, {whole('units')} AS quantity_sold FROM sums JOIN products USING (product_id)
        ORDER BY units DESC, product_name, product_id LIMIT 10""",
        sums=PRODUCT_SUMS,
    )
    sql["m1q5_no_return_customers"] = query(
        """SELECT customer_id, customer_name FROM customers WHERE customer_id IN (
            SELECT customer_id FROM sales WHERE order_id IN (SELECT order_id FROM lines)
                AND order_id NOT IN (SELECT order_id FROM returned))"""
    )
    sql["m1q5b_never_returned"] = query(
        """SELECT c.customer_id, c.customer_name FROM customers c JOIN sales s ON s.customer_id = c.customer_id
        JOIN lines l ON l.order_id = s.order_id LEFT JOIN returned r ON r.order_id = s.order_id
        GROUP BY ALL HAVING COUNT(r.return_id) = 0"""
    )
    sql["m2q1_top_customers"] = query(
        f"""SELECT customer_id, customer_name, membership, loyalty_score, n AS number_of_orders,
            {money('spent')} AS total_spending FROM sums JOIN customers USING (customer_id)
        ORDER BY spent DESC, loyalty_score DESC, customer_id LIMIT 10""",
        sums=CUSTOMER_SUMS,
    )
    sql["m2q2_top3_by_membership"] = query(
        f"""SELECT customer_id, customer_name, membership, loyalty_score, {money('spent')} AS total_spending,
            CAST(DENSE_RANK() OVER (PARTITION BY membership ORDER BY spent DESC) AS INT) AS customer_rank
        FROM sums JOIN customers USING (customer_id) QUALIFY customer_rank <= 3""",
        sums=CUSTOMER_SUMS,
    )
    sql["m2q3_lapsed_90d"] = query(
        """SELECT customer_id, customer_name, last_order_details FROM customers JOIN
            (SELECT customer_id, MAX(ts) AS last_order_details FROM sales GROUP BY customer_id) USING (customer_id)
        WHERE last_order_details < TIMESTAMP '2001-05-03 00:00:00'"""
    )
    sql["m2q4_top5_by_area"] = query(
        f"""SELECT customer_id, customer_name, area, {money('spent')} AS total_spending,
            CAST(DENSE_RANK() OVER (PARTITION BY area ORDER BY spent DESC) AS INT) AS customer_rank
        FROM sums JOIN customers USING (customer_id) QUALIFY customer_rank <= 5""",
        sums=CUSTOMER_SUMS,
    )
    sql["m2q5_above_avg_products"] = query(
        f"""SELECT product_id, product_name, category, {money('rev')} AS product_revenue
        FROM sums JOIN products USING (product_id), (SELECT SUM(rev) AS all_rev, COUNT(*) AS n FROM sums)
        WHERE rev * n > all_rev""",
        sums=PRODUCT_SUMS,
    )
    sql["m3q1_mom_revenue"] = query(
        f"""SELECT month, {money('rev')} AS monthly_revenue, {money('prev')} AS previous_month_revenue,
            {money('rev - prev')} AS revenue_difference, {div('100 * (rev - prev)', 'prev', 2)} AS growth_percentage
        FROM lagged""",
        series=MONTH_SUMS,
        lagged=_lagging("ORDER BY month"),
    )
    sql["m3q2_running_revenue"] = query(
        f"""SELECT strftime(a.month, '%b %Y') AS month, {money('a.rev')} AS monthly_revenue,
            {money('SUM(b.rev)')} AS running_total_revenue
        FROM series a JOIN series b ON b.month <= a.month GROUP BY a.month, a.rev""",
        series=MONTH_SUMS,
    )
    sql["m3q3_moving_avg_7d"] = query(
        f"""SELECT a.day, {money('a.rev')} AS daily_revenue, {div('SUM(b.rev)', '100 * COUNT(b.rev)', 2)} AS moving_average_7_days
        FROM numbered a JOIN numbered b ON b.i BETWEEN a.i - 6 AND a.i GROUP BY a.day, a.rev""",
        series="SELECT day, SUM(value_c) AS rev FROM sales GROUP BY day",
        numbered="SELECT *, ROW_NUMBER() OVER (ORDER BY day) AS i FROM series",
    )
    sql["m3q4_top_product_by_category"] = query(
        f"""SELECT category, product_name AS product, {money('rev')} AS revenue
        FROM sums JOIN products USING (product_id)
        QUALIFY ROW_NUMBER() OVER (PARTITION BY category ORDER BY rev DESC, product_name, product_id) = 1""",
        sums=PRODUCT_SUMS,
    )
    sql["m3q5_pareto_80"] = query(
        f"""SELECT product_name, {money('rev')} AS revenue, {money('running')} AS running_revenue,
            {div('100 * running', 'total', 2)} AS cumulative_percentage FROM ranked WHERE running * 100 <= total * 80""",
        sums=PRODUCT_SUMS,
        ranked="""SELECT product_name, rev, SUM(rev) OVER (ORDER BY rev DESC) AS running, SUM(rev) OVER () AS total
            FROM sums JOIN products USING (product_id)""",
    )
    sql["m4q1_spend_segments"] = query(
        f"""SELECT customer_id, customer_name, {money('COALESCE(spent, 0)')} AS total_spending,
            CASE WHEN spent >= 300000000 THEN 'Premium' WHEN spent >= 200000000 AND spent <= 299999900 THEN 'Gold'
                ELSE 'Standard' END AS segement
        FROM customers LEFT JOIN sums USING (customer_id)""",
        sums=CUSTOMER_SUMS,
    )
    sql["m4q2_payment_methods"] = query(
        f"""SELECT payment_method, COUNT(*) AS total_orders, {money('SUM(value_c)')} AS total_revenue,
            {div('SUM(value_c)', '100 * COUNT(value_c)', 6)} AS average_order_value FROM sales GROUP BY payment_method"""
    )
    statuses = ("Delivered", "Cancelled", "Returned", "Failed")
    sql["m4q3_order_status"] = query(
        "SELECT "
        + ", ".join(f"COUNT(*) FILTER (order_status = '{s}') AS {s.lower()}_orders" for s in statuses)
        + ", "
        + ", ".join(
            div(f"100 * COUNT(*) FILTER (order_status = '{s}')", "COUNT(*)", 2) + f" AS {s.lower()}_pct" for s in statuses
        )
        + " FROM sales"
    )
    sql["m4q4_store_performance"] = query(
        f"""SELECT store_name, COUNT(*) AS total_orders, {money('SUM(value_c)')} AS total_revenue,
            {div('SUM(value_c)', '100 * COUNT(value_c)', 6)} AS average_order_value
        FROM sales JOIN stores USING (store_id) GROUP BY store_name"""
    )
    sql["m4q5_monthly_category"] = query(
        f"SELECT month, category, {money('rev')} AS total_revenue FROM series", series=MONTH_CATEGORY
    )
    sql["m5q1_new_vs_repeat"] = query(
        """SELECT month, COUNT(DISTINCT customer_id) AS total_customers,
            COUNT(DISTINCT customer_id) FILTER (month = first_month) AS new_customers,
            COUNT(DISTINCT customer_id) FILTER (month > first_month) AS repeat_customers
        FROM sales JOIN firsts USING (customer_id) GROUP BY month""",
        firsts=FIRST_MONTHS,
    )
    sql["m5q2_top5_monthly"] = query(
        f"""SELECT month, customer_id, {money('rev')} AS total_revenue,
            CAST(ROW_NUMBER() OVER (PARTITION BY month ORDER BY rev DESC, customer_id) AS INT) AS rank
        FROM (SELECT month, customer_id, SUM(value_c) AS rev FROM sales GROUP BY ALL) QUALIFY rank <= 5"""
    )
    sql["m5q3_purchase_frequency"] = query(
        f"""SELECT customer_id, COUNT(*) AS total_orders, {money('SUM(value_c)')} AS total_revenue,
            {div('SUM(gap)', 'COUNT(gap)', 2)} AS avg_days_beween_orders FROM gaps GROUP BY customer_id""",
        gaps="""SELECT customer_id, value_c, day - LAG(day) OVER (PARTITION BY customer_id ORDER BY ts) AS gap
            FROM sales""",
    )
    sql["m5q4_churn_risk"] = query(
        """SELECT customer_id, last_order_date, CAST(DATE '2001-08-01' - last_order_date AS INT) AS days_since_last_order,
            CASE WHEN last_order_date >= DATE '2001-06-05' THEN 'Active' WHEN last_order_date >= DATE '2001-06-02'
                THEN 'At Risk' ELSE 'Churned' END AS churn_status
        FROM (SELECT customer_id, MAX(day) AS last_order_date FROM sales GROUP BY customer_id)"""
    )
    sql["m5q5_membership_aov"] = query(
        f"""SELECT membership, COUNT(DISTINCT customer_id) AS customers, COUNT(order_id) AS orders,
            {money('SUM(value_c)')} AS revenue, {div('SUM(value_c)', '100 * COUNT(value_c)', 6)} AS aov
        FROM sales JOIN customers USING (customer_id) GROUP BY membership"""
    )
    sql["m6q1_penetration"] = query(
        f"""SELECT product_id, product_name, found AS orders_containing_poduct, n AS total_orders,
            {div('100 * found', 'n', 2)} AS penetration_percentage
        FROM (SELECT product_id, COUNT(*) AS found FROM (SELECT DISTINCT product_id, order_id FROM lines) GROUP BY 1)
        JOIN products USING (product_id), (SELECT COUNT(*) AS n FROM sales)"""
    )
    sql["m6q2_category_share"] = query(
        f"""SELECT category, {money('rev')} AS category_revenue, {money('total')} AS total_revenue,
            {div('100 * rev', 'total', 2)} AS revenue_contribution_percentage FROM sums, (SELECT SUM(rev) AS total FROM sums)""",
        sums="SELECT category, SUM(final_c) AS rev FROM lines JOIN products USING (product_id) GROUP BY category",
    )
    sql["m6q3_discount_bands"] = query(
        f"""SELECT CASE WHEN discount_c <= 100000 THEN 'No/Low Discount' WHEN discount_c <= 300000 THEN 'Medium Discount'
                ELSE 'High Discount' END AS discount_band,
            COUNT(*) AS total_line_items, {whole('SUM(quantity)')} AS total_units_sold,
            {div('SUM(quantity)', 'COUNT(quantity)', 2)} AS avg_quantity_per_item, {money('SUM(final_c)')} AS total_revenue
        FROM lines GROUP BY 1"""
    )
    sql["m6q4_underperformers"] = query(
        f"""SELECT category, product_id, product_name, {money('rev')} AS product_revenue,
            {div('all_rev', '100 * n', 2)} AS category_avg_revenue,
            {div('rev * n - all_rev', '100 * n', 2)} AS difference_from_average
        FROM priced JOIN (SELECT category, SUM(rev) AS all_rev, COUNT(*) AS n FROM priced GROUP BY category)
            USING (category) WHERE rev * n < all_rev""",
        sums=PRODUCT_SUMS,
        priced="SELECT * FROM sums JOIN products USING (product_id)",
    )
    sql["m8q4_underperformers_again"] = sql["m6q4_underperformers"]
    sql["m6q5_category_mom"] = query(
        f"""SELECT month, category, {money('rev')} AS monthly_revenue, {money('prev')} AS previous_month_revenue,
            {div('100 * (rev - prev)', 'prev', 2)} AS mom_growth_percentage FROM lagged""",
        series=MONTH_CATEGORY,
        lagged=_lagging("PARTITION BY category ORDER BY month"),
    )
    sql["m7q1_product_pairs"] = query(
        """SELECT x.product_name AS product_1, y.product_name AS product_2, times AS times_bought_together
        FROM (SELECT l.product_id AS a, r.product_id AS b, COUNT(*) AS times FROM lines l JOIN lines r
                ON l.order_id = r.order_id AND l.product_id < r.product_id GROUP BY ALL)
        JOIN products x ON x.product_id = a JOIN products y ON y.product_id = b
        ORDER BY times DESC, a, b LIMIT 10"""
    )
    sql["m7q2_basket_sizes"] = query(
        f"""SELECT CASE WHEN k <= 3 THEN 'Small Basket' WHEN k <= 6 THEN 'Medium Basket' ELSE 'Large Basket' END
                AS basket_type, COUNT(*) AS total_orders, {div('SUM(k)', 'COUNT(*)', 2)} AS avg_products_per_order,
            {div('SUM(amount)', '100 * COUNT(*)', 2)} AS avg_order_value
        FROM (SELECT order_id, COUNT(*) AS k, SUM(final_c) AS amount FROM lines JOIN sales USING (order_id)
            GROUP BY order_id) GROUP BY 1"""
    )
    sql["m7q3_top3_stores_monthly"] = query(
        f"""SELECT month, store_id, store_name, {money('rev')} AS total_revenue,
            CAST(ROW_NUMBER() OVER (PARTITION BY month ORDER BY rev DESC, store_id) AS INT) AS rank
        FROM (SELECT month, store_id, store_name, SUM(value_c) AS rev FROM sales JOIN stores USING (store_id) GROUP BY ALL)
        QUALIFY rank <= 3"""
    )
    sql["m7q4_top_customer_by_category"] = query(
        f"""SELECT category, customer_id, customer_name, {money('rev')} AS total_product_revenue
        FROM (SELECT category, customer_id, customer_name, SUM(final_c) AS rev FROM lines JOIN sales USING (order_id)
            JOIN products USING (product_id) JOIN customers USING (customer_id) GROUP BY ALL)
        QUALIFY ROW_NUMBER() OVER (PARTITION BY category ORDER BY rev DESC, customer_id) = 1"""
    )
    sql["m7q5_bought_a_not_b"] = query(
        """SELECT customer_id, customer_name FROM customers WHERE customer_id IN
            (SELECT customer_id FROM bought WHERE product_name = 'red plate')
        AND customer_id NOT IN (SELECT customer_id FROM bought WHERE product_name = 'small widget')""",
        bought="SELECT customer_id, product_name FROM lines JOIN sales USING (order_id) JOIN products USING (product_id)",
    )
    sql["m8q1_cohort_retention"] = query(
        f"""SELECT first_month AS cohort_month, month AS activity_month, ANY_VALUE(members) AS cohort_customers,
            COUNT(DISTINCT customer_id) AS acyive_customers,
            {div('100 * COUNT(DISTINCT customer_id)', 'ANY_VALUE(members)', 2)} AS retention_percentage
        FROM sales JOIN firsts USING (customer_id)
        JOIN (SELECT first_month, COUNT(*) AS members FROM firsts GROUP BY 1) USING (first_month) GROUP BY 1, 2""",
        firsts=FIRST_MONTHS,
    )
    sql["m8q2_reactivation"] = query(
        """SELECT e.customer_id, e.day AS reactivation_date, CAST(e.gap AS INT) AS days_since_previous_order,
            COUNT(s.order_id) AS orders_after_reactivation
        FROM gaps e LEFT JOIN sales s ON s.customer_id = e.customer_id AND s.day > e.day
        WHERE e.gap >= 60 GROUP BY e.customer_id, e.order_id, e.day, e.gap""",
        gaps="""SELECT customer_id, order_id, day,
            day - LAG(day) OVER (PARTITION BY customer_id ORDER BY ts, order_id) AS gap FROM sales""",
    )
    sql["m8q3_clv"] = query(
        f"""SELECT customer_id, n AS total_orders, {money('spent')} AS total_revenue,
            {div('spent', '100 * n', 2)} AS avg_revenue, CAST(d AS INT) AS customer_lifetime_days,
            {div('30 * n', 'd', 2)} AS avg_orders_per_month
        FROM (SELECT customer_id, COUNT(*) AS n, SUM(value_c) AS spent, MAX(day) - MIN(day) AS d FROM sales GROUP BY 1)"""
    )
    sql["m8q4b_repeat_purchase_rate"] = query(
        f"""SELECT COUNT(*) AS customers, COUNT(*) FILTER (n > 1) AS repeat_customers,
            {div('100 * COUNT(*) FILTER (n > 1)', 'COUNT(*)', 2)} AS repeat_purchase_rate FROM sums""",
        sums=CUSTOMER_SUMS,
    )
    sql["m8q5_top10_share"] = query(
        f"""SELECT {money('top')} AS top_10_revenue, {money('total')} AS total_company_revenue,
            {div('100 * top', 'total', 2)} AS top_10_revenue_contribution_percentage
        FROM (SELECT SUM(spent) AS top FROM (SELECT spent FROM sums ORDER BY spent DESC LIMIT 10)),
            (SELECT SUM(value_c) AS total FROM sales)""",
        sums=CUSTOMER_SUMS,
    )
    placed = "SELECT * FROM sales WHERE ts >= TIMESTAMP '1998-03-15' AND ts < TIMESTAMP '1999-08-10'"
    sql["io5_period_overview"] = query(
        f"""SELECT {money('SUM(value_c)')} AS total_revenue, COUNT(*) AS total_orders,
            COUNT(DISTINCT customer_id) AS active_customers, {div('SUM(value_c)', '100 * COUNT(*)', 2)} AS average_order_value,
            ANY_VALUE(rets) AS returned_items, {div('100 * ANY_VALUE(rets)', 'ANY_VALUE(nlines)', 2)} AS return_rate_percent
        FROM placed, (SELECT COUNT(*) AS rets FROM returned WHERE order_id IN (SELECT order_id FROM placed)),
            (SELECT COUNT(*) AS nlines FROM lines WHERE order_id IN (SELECT order_id FROM placed))""",
        placed=placed,
    )
    sql["io5_period_monthly_orders"] = query(
        f"""SELECT COUNT(*) AS orders, month AS order_month, {money('SUM(value_c)')} AS monthly_revenue
        FROM placed GROUP BY month""",
        placed=placed,
    )
    sql["io5_period_monthly_category"] = query(
        f"""SELECT month, category, {money('SUM(final_c)')} AS total_revenue
        FROM lines JOIN placed USING (order_id) JOIN products USING (product_id) GROUP BY ALL""",
        placed=placed,
    )
    return sql
