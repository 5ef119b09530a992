"""Twins of the table profiles."""

from __future__ import annotations

from larder.oracle.dialect import div, money, query, whole


def profiles() -> dict[str, str]:
    share = div("100 * rows", "SUM(rows) OVER (PARTITION BY column_name)", 2)
    counts = " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, CAST({c} AS VARCHAR) AS value, COUNT(*) AS rows FROM sales GROUP BY {c}"
        for c in ("payment_method", "order_status", "store_id")
    )
    statuses = ("Approved", "Rejected", "Pending")
    return {
        "p01_value_shares": query(
            f"""SELECT value AS payment_method, rows, {share} AS share_pct FROM counts
            WHERE column_name = 'payment_method'""",
            counts=counts,
        ),
        "p01_distributions": query(f"SELECT column_name, value, rows, {share} AS share_pct FROM counts", counts=counts),
        "p02_means": query(
            f"""SELECT line_number, COUNT(*) AS rows, {whole('SUM(quantity)')} AS quantity_sum,
                {div('SUM(quantity)', 'COUNT(*)', 2)} AS quantity_mean, {money('SUM(final_c)')} AS final_item_price_sum,
                {div('SUM(final_c)', '100 * COUNT(*)', 2)} AS final_item_price_mean FROM lines GROUP BY line_number"""
        ),
        "p02_line_summary": query(
            f"""SELECT COUNT(*) AS total_lines, COUNT(DISTINCT order_id) AS orders,
                {div('SUM(final_c)', '100 * COUNT(*)', 2)} AS average_final_price,
                {div('SUM(discount_c)', '100 * COUNT(*)', 2)} AS average_discount, {money('SUM(final_c)')} AS total_value,
                {div('COUNT(*)', 'COUNT(DISTINCT order_id)', 2)} AS lines_per_order FROM lines"""
        ),
        "a17_active_riders_by_store": query(
            """SELECT store_id, rider_id, ROW_NUMBER() OVER (PARTITION BY store_id ORDER BY rider_id) AS position
            FROM rider_list WHERE rider_status = 'Active'"""
        ),
        "p03_gaps_and_repeats": query(
            f"""SELECT 'nulls' AS measure, {whole("COUNT(*) * 3 - COUNT(return_id) - COUNT(order_id) - COUNT(product_id)")} AS found
                FROM returned
            UNION ALL SELECT 'repeated rows', (SELECT COUNT(*) FROM returned)
                - (SELECT COUNT(*) FROM (SELECT DISTINCT return_id, order_id, product_id FROM returned))
            UNION ALL SELECT 'return_id', COUNT(*) - COUNT(DISTINCT return_id) FROM returned"""
        ),
        "p04_top_values": query(
            "SELECT product_name, COUNT(*) AS rows FROM products GROUP BY 1 ORDER BY rows DESC, product_name LIMIT 5"
        ),
        "p05_counts_by_attribute": query(
            f"""SELECT ['Micro', 'Medium', 'Large'][store_id % 3 + 1] AS store_type, COUNT(DISTINCT store_id) AS members,
                COUNT(*) AS rows, {div('COUNT(*)', 'COUNT(DISTINCT store_id)', 2)} AS rows_per_member FROM stock GROUP BY 1"""
        ),
        "p06_return_summary": query(
            f"""SELECT COUNT(*) AS total_returns, {div('SUM(refund_c)', '100 * COUNT(*)', 2)} AS average_refund,
                {money('SUM(refund_c)')} AS total_refund, {div('100 * COUNT(*)', '(SELECT COUNT(*) FROM lines)', 2)} AS return_rate_pct, """
            + ", ".join(
                div(f"100 * COUNT(*) FILTER (return_status = '{s}')", "COUNT(*)", 2) + f" AS {s.lower()}_pct" for s in statuses
            )
            + " FROM returned"
        ),
    }
