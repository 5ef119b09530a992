"""Twins of the quality checks."""

from __future__ import annotations

from larder.oracle.dialect import money, query, whole


def quality() -> dict[str, str]:
    sql: dict[str, str] = {}
    sql["dq01_unique_key"] = query("SELECT return_id, COUNT(*) AS copies FROM returned GROUP BY 1 HAVING COUNT(*) > 1")
    sql["dq02_composite_key"] = query(
        "SELECT order_id, product_id, COUNT(*) AS copies FROM lines GROUP BY ALL HAVING COUNT(*) > 1"
    )
    sql["dq03_repeated_rows"] = query(
        "SELECT customer_id, store_id, order_status, COUNT(*) AS copies FROM sales GROUP BY ALL HAVING COUNT(*) > 1"
    )
    returned_orders = """SELECT order_id, customer_id, (SELECT MIN(return_date) FROM returned r
        WHERE r.order_id = s.order_id) AS first_return FROM sales s"""
    sql["dq04_null_counts"] = query(
        """SELECT 'order_id' AS column_name, COUNT(*) FILTER (order_id IS NULL) AS nulls FROM ro
        UNION ALL SELECT 'customer_id', COUNT(*) FILTER (customer_id IS NULL) FROM ro
        UNION ALL SELECT 'first_return', COUNT(*) FILTER (first_return IS NULL) FROM ro""",
        ro=returned_orders,
    )
    sql["dq04_incomplete_rows"] = query("SELECT * FROM ro WHERE first_return IS NULL", ro=returned_orders)
    sql["dq05_foreign_key"] = query(
        "SELECT order_id, customer_id FROM sales WHERE order_id NOT IN (SELECT order_id FROM lines)"
    )
    sql["dq06_composite_foreign_key"] = query(
        """SELECT order_id, product_id, line_number FROM lines l WHERE NOT EXISTS
            (FROM returned r WHERE r.order_id = l.order_id AND r.product_id = l.product_id)"""
    )
    sql["dq07_domain"] = query(
        "SELECT order_id, payment_method FROM sales WHERE payment_method NOT IN ('1-URGENT', '2-HIGH', '3-MEDIUM')"
    )
    sql["dq08_range"] = query("SELECT order_id, product_id, quantity FROM lines WHERE quantity < 5 OR quantity > 45")
    sql["dq09_sign"] = query(
        f"""SELECT order_id, product_id, {money('discount_c')} AS item_discount, {money('final_c - 500000')} AS net
        FROM lines WHERE final_c <= 500000 OR discount_c <= 0"""
    )
    sql["dq09_whole_number"] = query(
        f"SELECT order_id, {money('value_c')} AS total_order_value FROM sales WHERE value_c % 100 <> 0"
    )
    sql["dq10_conditional_null"] = query(
        """SELECT order_id, order_status, payment_method AS cancellation_reason FROM sales
        WHERE order_status = 'Delivered' AND payment_method <> '1-URGENT'"""
    )
    sql["dq11_column_compare"] = query(
        f"""SELECT order_id, product_id, {money('12 * discount_c')} AS twelvefold, {money('final_c')} AS final_item_price
        FROM lines WHERE 12 * discount_c > final_c"""
    )
    sql["dq12_date_order_in_row"] = query(
        """SELECT store_id, product_id, last_restock_date, next_restock_date FROM stock
        WHERE last_restock_date >= next_restock_date"""
    )
    sql["dq13_date_order_across"] = query(
        """SELECT return_id, order_id, return_date, ts AS order_timestamp FROM returned JOIN sales USING (order_id)
        WHERE return_date < ts"""
    )
    sql["dq14_line_arithmetic"] = query(
        f"""SELECT order_id, product_id, line_number, {money('gross_c')} AS gross, {money('discount_c')} AS item_discount,
            {money('final_c + 50')} AS final_item_price
        FROM lines WHERE line_number = 7 AND 50 * 100000 > final_c + 50"""
    )
    sql["dq15_reconciliation"] = query(
        f"""SELECT order_id, {money('value_c')} AS total_order_value, {money('amount')} AS line_total,
            CASE WHEN amount IS NULL THEN 'without lines' WHEN value_c IS NULL THEN 'without parent'
                ELSE 'total differs' END AS rule
        FROM sales FULL JOIN (SELECT order_id, SUM(final_c) AS amount FROM lines GROUP BY 1) USING (order_id)
        WHERE amount IS NULL OR value_c IS NULL OR abs(amount - value_c) > 1"""
    )
    sql["dq16_status_rule"] = query(
        """SELECT * FROM stock WHERE (inventory_status = 'Out of Stock' AND current_stock <> 0)
            OR (inventory_status = 'Low Stock' AND NOT (current_stock > 0 AND current_stock <= reorder_level))"""
    )
    returned_columns = f"""return_id, order_id, product_id, return_date, return_status,
        {money('refund_c')} AS refund_amount"""
    # a tolerance of 0.01 plus 1e-5 of the limit, in units of 1e-5 cents
    fits = "abs(refund_c - {v}) * 100000 <= 100000 + {v}"
    sql["dq16_refund_for_status"] = query(
        f"""SELECT {returned_columns} FROM returned r WHERE (return_status = 'Rejected' AND refund_c <> 0)
            OR (return_status = 'Approved' AND EXISTS (FROM lines l WHERE l.order_id = r.order_id
                AND l.product_id = r.product_id AND NOT ({fits.format(v='l.final_c')})))"""
    )
    sql["dq17_refund_bound"] = query(
        f"""SELECT {returned_columns} FROM returned r WHERE EXISTS (FROM lines l WHERE l.order_id = r.order_id
            AND l.product_id = r.product_id AND refund_c >= l.final_c AND NOT ({fits.format(v='l.final_c')}))"""
    )
    sql["dq18_parent_status"] = query(
        """SELECT return_id, order_id FROM returned JOIN sales USING (order_id) WHERE order_status <> 'Delivered'"""
    )
    sql["dq19_attribute_agreement"] = query(
        """SELECT s.order_id, s.rider_id, s.store_id, r.store_id AS expected FROM sales s JOIN rider_list r
            ON r.rider_id = s.rider_id WHERE r.rider_status = 'Active' AND r.store_id <> s.store_id"""
    )
    sql["dq19_rider_not_active"] = query(
        """SELECT order_id, rider_id FROM sales WHERE rider_id IN
            (SELECT rider_id FROM rider_list WHERE rider_status <> 'Active')"""
    )
    sql["dq20_max_occurrences"] = query(
        "SELECT product_name, COUNT(*) AS occurrences FROM products GROUP BY 1 HAVING COUNT(*) > 30"
    )
    sql["dq21_bounds_by_type"] = query(
        """SELECT product_id, category, size FROM products WHERE NOT CASE category
            WHEN 'SMALL' THEN size BETWEEN 1 AND 25 WHEN 'MEDIUM' THEN size BETWEEN 10 AND 40
            WHEN 'LARGE' THEN size BETWEEN 20 AND 50 WHEN 'STANDARD' THEN size BETWEEN 1 AND 50
            WHEN 'ECONOMY' THEN size BETWEEN 1 AND 45 ELSE FALSE END"""
    )
    sql["dq22_assortment_share"] = query(
        f"""SELECT store_id, store_type, eligible, COALESCE(n, 0) AS stocked, {whole('eligible * lo // 100')} AS at_least,
            {whole('eligible * hi // 100')} AS at_most
        FROM typed LEFT JOIN (SELECT store_id, COUNT(*) AS n FROM stock GROUP BY 1) USING (store_id)
        WHERE eligible > 0 AND NOT COALESCE(n, 0) BETWEEN eligible * lo // 100 AND eligible * hi // 100""",
        typed="""SELECT store_id, ['Micro', 'Medium', 'Large'][store_id % 3 + 1] AS store_type,
            [20, 25, 26][store_id % 3 + 1] AS lo, [24, 26, 35][store_id % 3 + 1] AS hi,
            (SELECT COUNT(*) FROM products WHERE store_id % 2 = 0 OR category <> 'SMALL') AS eligible FROM stores""",
    )
    sql["dq23_row_count"] = query(
        f"SELECT {whole('12')} AS expected, COUNT(*) AS found FROM stores HAVING COUNT(*) <> 12"
    )
    counted = {
        ("orders", "order_timestamp present"): "sales WHERE ts IS NULL",
        ("orders", "status delivered or failed"): "sales WHERE order_status NOT IN ('Delivered', 'Failed')",
        ("orders", "value in range"): "sales WHERE value_c < 100000 OR value_c > 40000000",
        ("orders", "order_id unique"): "(SELECT order_id FROM sales GROUP BY 1 HAVING COUNT(*) > 1)",
        ("orders", "customer known"): "sales ANTI JOIN customers USING (customer_id)",
        ("orders", "lines add up"): """sales FULL JOIN (SELECT order_id, SUM(final_c) AS amount FROM lines GROUP BY 1)
            USING (order_id) WHERE amount IS NULL OR value_c IS NULL OR abs(amount - value_c) > 1""",
        ("order_details", "quantity in range"): "lines WHERE quantity NOT BETWEEN 2 AND 49",
        ("order_details", "discount present"): "lines WHERE discount_c <= 0",
        ("order_details", "product once per order"): """(SELECT order_id, product_id FROM lines GROUP BY ALL
            HAVING COUNT(*) > 1)""",
        ("order_details", "product known"): "lines ANTI JOIN products USING (product_id)",
        ("returns", "return_id unique"): "(SELECT return_id FROM returned GROUP BY 1 HAVING COUNT(*) > 1)",
        ("returns", "order delivered"): "returned JOIN sales USING (order_id) WHERE order_status <> 'Delivered'",
        ("returns", "return after order"): "returned JOIN sales USING (order_id) WHERE return_date < ts",
        ("inventory", "restock after last"): "stock WHERE next_restock_date <= last_restock_date",
        ("inventory", "out of stock is zero"): "stock WHERE inventory_status = 'Out of Stock' AND current_stock <> 0",
    }
    sql["dq_report"] = query(
        " UNION ALL ".join(
            f"SELECT '{table}' AS table_name, '{rule}' AS rule, COUNT(*) AS violations FROM {source}"
            for (table, rule), source in counted.items()
        )
    )
    return sql
