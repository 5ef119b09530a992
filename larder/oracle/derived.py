"""Twins of the derivations."""

from __future__ import annotations

from larder.oracle.dialect import money, query, whole

TRIPS = """SELECT event_id, ts, hour(ts) AS h, 50 + event_id * 7 % 751 AS km_c,
    ['Clear', 'Cloudy', 'Rain', 'Heavy Rain'][event_id % 4 + 1] AS weather,
    CASE WHEN hour(ts) BETWEEN 12 AND 14 OR hour(ts) BETWEEN 18 AND 21 THEN 'Yes' ELSE 'No' END AS peak_hour,
    event_id % 12 = 0 AS festive, CAST(ROUND(value * 100) AS BIGINT) AS basket_c, event_id % 97 * 100 AS coupon_c,
    CASE WHEN event_id % 20 < 15 THEN 'Delivered' WHEN event_id % 20 < 18 THEN 'Cancelled' ELSE 'Failed' END AS status,
    ['UPI', 'Credit Card', 'Debit Card', 'Cash on Delivery', 'Wallet'][event_id % 5 + 1] AS method,
    CAST(event_id % 5 + 1 AS INT) AS base_rating, CAST(8 + event_id % 38 AS INT) AS actual FROM events"""
TIMED = """SELECT *, CAST(round_even(least(30, greatest(10,
    (10 + km_c / 100 * 2.5::DOUBLE) * CASE weather WHEN 'Rain' THEN 1.2::DOUBLE WHEN 'Heavy Rain' THEN 1.5::DOUBLE ELSE 1 END
    + CASE WHEN peak_hour = 'Yes' THEN 5 ELSE 0 END + CASE WHEN festive THEN 5 ELSE 0 END)), 0) AS INT) AS minutes,
    greatest(km_c - 400, 0) * 10 + CASE weather WHEN 'Rain' THEN 1000 WHEN 'Heavy Rain' THEN 2500 ELSE 0 END
    + CASE WHEN peak_hour = 'Yes' THEN 1000 ELSE 0 END AS fee_c FROM trips"""


def half_even(num: str, den: str) -> str:
    """num / den of non-negative whole numbers to the nearest whole number, ties to the even one."""
    n, d = f"CAST({num} AS HUGEINT)", f"CAST({den} AS HUGEINT)"
    return (
        f"({n} // {d} + CASE WHEN 2 * ({n} % {d}) > {d} OR (2 * ({n} % {d}) = {d} AND ({n} // {d}) % 2 = 1) "
        f"THEN 1 ELSE 0 END)"
    )


def hashed(key: str) -> str:
    return f"CAST('0x' || substr(md5('42:' || {key}), 1, 13) AS BIGINT)"


def derived() -> dict[str, str]:
    sql: dict[str, str] = {}
    trip = {"trips": TRIPS, "timed": TIMED}
    sql["t01_delivery_slot"] = query(
        """SELECT event_id, strftime(date_trunc('hour', ts), '%I:%M %p') || ' - ' ||
            strftime(date_trunc('hour', ts) + INTERVAL 1 HOUR, '%I:%M %p') AS delivery_slot FROM events"""
    )
    sql["t02_peak_hour"] = query("SELECT event_id, peak_hour FROM trips", **trip)
    sql["t03_delivery_minutes"] = query(
        f"SELECT event_id, {money('km_c')} AS km, weather, minutes AS estimated_minutes FROM timed", **trip
    )
    sql["t04_delivery_fee"] = query(
        f"SELECT event_id, {money('km_c')} AS km, weather, {money('fee_c')} AS delivery_fee FROM timed", **trip
    )
    # money of one ten-thousandth of a unit, so that basket factors and coupon caps stay whole
    sql["t05_order_total"] = query(
        f"""SELECT event_id, {money(half_even('coupon_x', '100'))} AS coupon_discount,
            {money(half_even('basket_x + fee_x - coupon_x', '100'))} AS total_order_value
        FROM (SELECT event_id, basket_x, fee_x, CASE WHEN basket_x + fee_x - capped <= 0 THEN 0 ELSE capped END AS coupon_x
            FROM (SELECT event_id, b * 10 AS basket_x, fee_c * 100 AS fee_x, least(coupon_c * 100, b * 4) AS capped
                FROM (SELECT *, basket_c * CASE WHEN festive THEN 12 ELSE 10 END AS b FROM timed)))""",
        **trip,
    )
    sql["t06_payment_status"] = query(
        """SELECT event_id, status, method, CASE status WHEN 'Delivered' THEN 'Paid'
            WHEN 'Cancelled' THEN CASE WHEN method = 'Cash on Delivery' THEN 'Pending' ELSE 'Refunded or Pending' END
            ELSE CASE WHEN method = 'Cash on Delivery' THEN 'Pending' ELSE 'Refunded' END END AS payment_status FROM trips""",
        **trip,
    )
    sql["t07_rating"] = query(
        """SELECT event_id, status, CASE WHEN status = 'Delivered' THEN
            CASE WHEN actual > minutes + 15 THEN least(base_rating, 3)
                WHEN actual <= minutes AND weather = 'Heavy Rain' THEN greatest(base_rating, 4)
                ELSE base_rating END END AS customer_delivery_rating FROM timed""",
        **trip,
    )
    sql["t08_discount_allocation"] = query(
        f"""SELECT order_id, product_id, line_number, {money('gross_c')} AS gross,
            {money('share - extra')} AS item_discount, {money('gross_c - share + extra')} AS final_item_price
        FROM (SELECT *, sign(missing) * (abs(missing) // n + CASE WHEN place <= abs(missing) % n THEN 1 ELSE 0 END) AS extra
            FROM (SELECT *, target - total + SUM(share) OVER (PARTITION BY order_id) AS missing,
                    ROW_NUMBER() OVER (PARTITION BY order_id ORDER BY gross_c DESC, product_id DESC, line_number DESC) AS place
                FROM (SELECT *, {half_even('(total - target) * gross_c', 'total')} AS share
                    FROM lines JOIN (SELECT order_id, SUM(gross_c) AS total, (SUM(gross_c) * 9 + 5) // 10 AS target,
                        COUNT(*) AS n FROM lines GROUP BY 1) USING (order_id))))"""
    )
    delivered = "SELECT * FROM lines JOIN sales USING (order_id) WHERE order_status = 'Delivered'"
    sql["t09_return_eligibility"] = query(
        "SELECT order_id, product_id, line_number, ts AS order_timestamp FROM delivered", delivered=delivered
    )
    sql["t10_refund_amount"] = query(
        f"""SELECT order_id, product_id, ['Approved', 'Rejected', 'Pending'][product_id % 3 + 1] AS return_status,
            CASE WHEN product_id % 3 = 0 THEN {money('final_c')} ELSE 0 END AS refund_amount FROM delivered""",
        delivered=delivered,
    )
    sql["t11_return_date"] = query(
        "SELECT order_id, product_id, ts + to_days(CAST(product_id % 4 AS INT)) AS return_date FROM delivered",
        delivered=delivered,
    )
    sql["t12_reorder_level"] = query(
        """SELECT product_id, category, CASE WHEN category IN ('SMALL', 'PROMO') THEN 'Fast'
                WHEN category = 'LARGE' THEN 'Slow' ELSE 'Medium' END AS velocity,
            CASE category WHEN 'SMALL' THEN 36 WHEN 'MEDIUM' THEN 15 WHEN 'LARGE' THEN 9 WHEN 'STANDARD' THEN 24
                WHEN 'PROMO' THEN 15 ELSE 12 END AS reorder_level FROM products"""
    )
    sql["t13_stock_status"] = query(
        """SELECT store_id, product_id, current_stock, CASE WHEN current_stock > reorder_level THEN 'In Stock'
            WHEN current_stock = 0 THEN 'Out of Stock' ELSE 'Low Stock' END AS status FROM stock"""
    )
    sql["t14_batch_id"] = query(
        """SELECT order_id, n AS sequence, 'B' || strftime(ts, '%y%m%d') || printf('%04d', n) AS batch_id
        FROM (SELECT order_id, ts, ROW_NUMBER() OVER (ORDER BY order_id) AS n FROM sales)"""
    )
    sql["t15_cold_chain_expiry"] = query(
        """SELECT store_id, product_id, CASE WHEN category = 'SMALL' THEN 'Frozen' ELSE 'Ambient' END AS storage_type,
            CASE WHEN category = 'SMALL' THEN strftime(last_restock_date
                + CAST(size * (50 + product_id % 46) // 100 AS INT), '%Y-%m-%d') ELSE 'Not Applicable' END AS expiry_date
        FROM stock JOIN products USING (product_id) WHERE category <> 'SMALL' OR store_id % 2 = 0"""
    )
    def catalogue(parts: str) -> str:
        return f"""SELECT category, 'size ' || base AS sub_category, b.brand_name AS brand, 'Popular' AS brand_tier, noun AS item,
            CAST(NULL AS VARCHAR) AS type, adjective AS variant, flavour, 'pc' AS unit, CAST(base + more AS DOUBLE) AS size,
            CAST(base + more AS DOUBLE) AS price_min, CAST(2 * (base + more) AS DOUBLE) AS price_max, 'Ambient' AS storage_type,
            5 AS gst_percentage, base AS shelf_life_days
        FROM (SELECT category, brand, size AS base, split_part(product_name, ' ', 1) AS adjective,
                split_part(product_name, ' ', 2) AS noun, unnest([0, 50]) AS more FROM products WHERE {parts}) p,
            LATERAL (SELECT unnest([p.brand, 'House']) AS brand_name) b
            JOIN (VALUES ('red', 'plain'), ('red', 'spiced'), (NULL, NULL)) f(colour, flavour)
                ON (adjective = 'red' AND colour = 'red') OR (adjective <> 'red' AND colour IS NULL)"""

    sql["t16_flat_catalogue"] = query(catalogue("true"))
    sql["io4_catalogue_parse"] = query(catalogue("product_id % 50 <> 0"))
    sql["io1_csv_parse"] = query(
        f"""SELECT order_id AS line, CASE WHEN order_id % 40 <> 0 THEN 'DS, ' || store_id END AS store_id,
            CASE WHEN order_id % 40 <> 0 THEN ts END AS order_timestamp,
            CASE WHEN order_id % 40 <> 0 THEN {money('value_c')} END AS total_order_value, order_id % 40 = 0 AS corrupt FROM sales"""
    )
    sql["t14_text_batch_id"] = query(
        """SELECT order_key, ROW_NUMBER() OVER (ORDER BY order_key) AS sequence
        FROM (SELECT 'ORDER-BATCH-' || printf('%010d', order_id) AS order_key FROM sales)"""
    )
    stretch = """SELECT store_id, shelf, line, CAST(SUM(q) OVER w AS BIGINT) - q AS lo, CAST(SUM(q) OVER w AS BIGINT) AS hi
        FROM (SELECT l_suppkey AS store_id, l_partkey % 20 AS shelf, l_orderkey * 8 + l_linenumber AS line,
            MIN(CAST(l_shipdate AS DATE)) AS day, CAST(SUM(l_quantity) AS BIGINT) AS q
            FROM lineitem WHERE l_linestatus = '{}' GROUP BY ALL)
        WINDOW w AS (PARTITION BY store_id, shelf ORDER BY day, line)"""
    sql["b1_first_expired_first_out"] = query(
        """SELECT store_id, shelf, s.line AS batch_id, d.line AS request_id,
            least(s.hi, d.hi) - greatest(s.lo, d.lo) AS quantity
        FROM supply s JOIN demand d USING (store_id, shelf) WHERE s.lo < d.hi AND d.lo < s.hi""",
        supply=stretch.format("F"),
        demand=stretch.format("O"),
    )
    sql["b2_cash_on_delivery_ban"] = query(
        """SELECT customer_id, MIN(day) AS banned_since, CAST(arg_min(n, day) AS BIGINT) AS within_days
        FROM (SELECT DISTINCT s.customer_id, s.day, (SELECT COUNT(*) FROM sales r WHERE r.customer_id = s.customer_id
                AND r.order_status = 'Cancelled' AND r.day BETWEEN s.day - 29 AND s.day) AS n
            FROM sales s WHERE s.order_status = 'Cancelled') WHERE n >= 2 GROUP BY 1"""
    )
    sql["b3_daily_cutoff"] = query(
        """SELECT store_id, day, orders, event_id AS last_order, ts AS last_at
        FROM (SELECT user_id % 10 AS store_id, CAST(ts AS DATE) AS day, event_id, ts,
                ROW_NUMBER() OVER (PARTITION BY user_id % 10, CAST(ts AS DATE) ORDER BY ts, event_id) AS n,
                COUNT(*) OVER (PARTITION BY user_id % 10, CAST(ts AS DATE)) AS orders FROM events)
        WHERE n = (9 * (20 + store_id * 3) + 9) // 10"""
    )
    sql["t17_first_combination"] = query(
        """SELECT MIN(product_id) AS product_id, category, brand, product_name, size FROM products GROUP BY ALL"""
    )

    def code(text: str) -> str:
        return f"substr(regexp_replace(upper({text}), '[^A-Z0-9]', '', 'g'), 1, 3)"

    sql["t18_unique_sku"] = query(
        """SELECT product_id, base, base || CASE WHEN n > 1 THEN '-' || (n - 1) ELSE '' END AS sku
        FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY base ORDER BY product_id) AS n FROM coded)""",
        coded=f"""SELECT product_id, {code('brand')} || '-' || {code('product_name')} || '-' ||
            CASE WHEN product_id % 4 > 0 THEN {code('category')} ELSE 'REG' END || '-' || size || '0' AS base FROM products""",
    )
    sql["t19_display_name"] = query(
        """SELECT product_id, brand || CASE product_id % 3 WHEN 0 THEN ' ' || product_name WHEN 1 THEN ' ' || noun || ' Deluxe'
                ELSE ' ' || noun END
            || CASE WHEN product_id % 5 > 0 THEN ' ' || adjective ELSE ' ' || upper(adjective[1]) || adjective[2:] END
            || ' ' || size || '.0 g' AS display_name
        FROM (SELECT *, split_part(product_name, ' ', 1) AS adjective, split_part(product_name, ' ', 2) AS noun
            FROM products)"""
    )
    sql["t20_price_ladder"] = query(
        f"""SELECT product_id, {money('100 * retail')} AS retail, {money('selling')} AS selling,
            CASE WHEN product_id % 350 = 0 THEN 0 ELSE CAST(product_id % 350 AS DOUBLE) / 10 END AS discount_percentage,
            {money(half_even('selling * (85 - product_id % 20)', '100'))} AS cost
        FROM (SELECT *, {half_even('100 * retail * (1000 - product_id % 350)', '1000')} AS selling
            FROM (SELECT product_id, CASE WHEN p <= 30 THEN p WHEN p % 10 < 4 THEN p - p % 10 - 1
                    WHEN p % 10 < 8 THEN p - p % 10 + 5 ELSE p - p % 10 + 9 END AS retail
                FROM (SELECT product_id, {half_even('mrp_c * (product_id % 40 + 1)', '4000')} AS p FROM products)))"""
    )
    sql["t21_product_flags"] = query(
        """SELECT product_id, category = 'SMALL' AS is_perishable,
            CASE WHEN product_id % 7 = 0 THEN 'Seasonal' ELSE 'Regular' END AS launch_status,
            CASE WHEN product_id % 3 = 1 THEN product_name ELSE 'Not Applicable' END AS type FROM products"""
    )
    sql["t22_customer_scores"] = query(
        f"""SELECT customer_id, tenure AS tenure_months,
            {whole('least(greatest(floor(floor(tenure * freq * basket) * least(1.5, 1 + tenure / 24)), low, basket), high)')}
                AS lifetime_value,
            CAST(floor(least(30, freq / 20::DOUBLE * 30) + least(20, basket / 3000::DOUBLE * 20) + least(20, tenure / 18 * 20)
                + CASE WHEN customer_id % 2 = 0 THEN 15 ELSE 0 END + CASE WHEN customer_id % 3 = 0 THEN 15 ELSE 0 END) AS INT)
                AS loyalty_score
        FROM (SELECT customer_id, greatest(1, (customer_id % 900 + customer_id % 211) / 30::DOUBLE) AS tenure,
            CAST(1 + customer_id % 25 AS DOUBLE) AS freq, CAST(100 + customer_id * 37 % 3000 AS DOUBLE) AS basket,
            coalesce([5000, 20000, 40000, 50000, 30000, 2000, 10000][customer_id % 8 + 1], 0) AS low,
            coalesce([40000, 120000, 200000, 250000, 100000, 15000, 60000][customer_id % 8 + 1], 250000) AS high
            FROM customers)"""
    )
    sql["t23_age_range"] = query(
        """SELECT customer_id, CASE customer_id % 3 WHEN 0 THEN low || '-' || high WHEN 1 THEN low || '-' || high || '+'
                ELSE low || '+' END AS age_group, low AS age_min, CASE WHEN customer_id % 3 = 2 THEN 60 ELSE high END AS age_max
        FROM (SELECT customer_id, CAST(18 + customer_id % 30 AS INT) AS low, CAST(50 + customer_id % 20 AS INT) AS high
            FROM customers)"""
    )
    sql["f16_percent_text"] = query(
        f"""SELECT customer_id, CASE WHEN plain THEN 'all of it' ELSE 'keep ' || low || '-' || (low + 25) || '% of items' END AS rule,
            CASE WHEN plain THEN 0 ELSE {money('low')} END AS share_min,
            CASE WHEN plain THEN 0 ELSE {money('low + 25')} END AS share_max,
            CASE WHEN plain THEN 0 ELSE {money('low + 25')} END AS share
        FROM (SELECT customer_id, customer_id % 4 = 0 AS plain, customer_id % 50 AS low FROM customers)"""
    )
    sql["t24_quota_sample"] = query(
        f"""SELECT product_id, category FROM products
        QUALIFY ROW_NUMBER() OVER (PARTITION BY category ORDER BY {hashed('product_id')}, product_id) <=
            CASE category WHEN 'SMALL' THEN 80 WHEN 'MEDIUM' THEN 150 WHEN 'LARGE' THEN 180 ELSE 50 END"""
    )
    sql["t25_weighted_sample"] = query(
        f"""SELECT store_id, product_id FROM stock
        QUALIFY ROW_NUMBER() OVER (PARTITION BY store_id ORDER BY
                -ln(({hashed("store_id || ':' || product_id")} + 0.5::DOUBLE) / 4503599627370496::DOUBLE)
                / CASE WHEN product_id % 3 = 0 THEN 1.4::DOUBLE ELSE 1.0::DOUBLE END, product_id)
            <= COUNT(*) OVER (PARTITION BY store_id) * [55, 70, 85][store_id % 3 + 1] // 100"""
    )
    return sql
