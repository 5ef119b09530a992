"""Pieces of SQL text shared by the twins (DuckDB dialect)."""

from __future__ import annotations

TABLES = {
    "customers": """SELECT c_custkey AS customer_id, c_name AS customer_name, c_mktsegment AS membership,
        c_acctbal AS loyalty_score, n_name AS area
        FROM customer LEFT JOIN nation ON n_nationkey = c_nationkey""",
    "products": """SELECT p_partkey AS product_id, p_name AS product_name, p_type AS category, p_brand AS brand,
        p_size AS size, CAST(ROUND(p_retailprice * 100) AS BIGINT) AS mrp_c FROM part""",
    "stores": "SELECT s_suppkey AS store_id, s_name AS store_name, s_nationkey AS area_id FROM supplier",
    "rider_list": """SELECT s_suppkey AS rider_id, s_name AS rider_name, s_suppkey % 10 AS store_id, s_acctbal AS earnings,
        CASE WHEN s_acctbal < 1000 THEN 'Inactive' WHEN s_acctbal < 2000 THEN 'On Leave' ELSE 'Active' END
            AS rider_status FROM supplier""",
    "sales": """SELECT o_orderkey AS order_id, o_custkey AS customer_id, o_orderkey % 10 AS store_id,
        o_custkey % 100 AS rider_id, o_orderdate AS ts, CAST(o_orderdate AS DATE) AS day,
        CAST(date_trunc('month', o_orderdate) AS DATE) AS month, o_orderpriority AS payment_method,
        CASE o_orderstatus WHEN 'F' THEN 'Delivered' WHEN 'O' THEN 'Cancelled' ELSE 'Failed' END AS order_status,
        CAST(ROUND(o_totalprice * 100) AS BIGINT) AS value_c FROM orders""",
    "item_lines": """SELECT l_orderkey AS order_id, l_partkey AS product_id, l_linenumber AS line_number,
        CAST(l_quantity AS INT) AS quantity, CAST(ROUND(l_extendedprice * 100) AS BIGINT) AS gross_c,
        (CAST(ROUND(l_extendedprice * 100) AS BIGINT) * CAST(ROUND(l_discount * 100) AS BIGINT) + 50) // 100
            AS discount_c FROM lineitem""",
    "lines": "SELECT *, gross_c - discount_c AS final_c FROM item_lines",
    "returned": """SELECT CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) AS return_id,
        l_orderkey AS order_id, l_partkey AS product_id, l_shipdate AS return_date,
        CASE WHEN l_linestatus = 'F' THEN 'Approved' ELSE 'Rejected' END AS return_status,
        (CAST(ROUND(l_extendedprice * 100) AS BIGINT) * CAST(ROUND(l_discount * 100) AS BIGINT) * 20 + 50) // 100
            AS refund_c FROM lineitem WHERE l_returnflag = 'R'""",
    "stock": """SELECT l_suppkey AS store_id, l_partkey AS product_id,
        CAST(SUM(CAST(l_quantity AS INT)) % 50 AS BIGINT) AS current_stock,
        CAST(MAX(l_linenumber) AS BIGINT) AS reorder_level,
        CAST(MIN(l_shipdate) AS DATE) AS last_restock_date, CAST(MAX(l_shipdate) AS DATE) AS next_restock_date,
        CASE MAX(l_returnflag) WHEN 'A' THEN 'Out of Stock' WHEN 'N' THEN 'Low Stock' ELSE 'In Stock' END
            AS inventory_status
        FROM lineitem GROUP BY l_suppkey, l_partkey""",
}


def query(body: str, **ctes: str) -> str:
    """``body`` over the bound tables and the given named subqueries, in order."""
    named = {**TABLES, **ctes}
    return "WITH " + ",\n".join(f"{name} AS ({text})" for name, text in named.items()) + "\n" + body


def money(cents: str) -> str:
    return f"(CAST({cents} AS DOUBLE) / 100)"


def div(num: str, den: str, places: int) -> str:
    """num / den of whole numbers, rounded half away from zero; null where den is 0."""
    n, d, scale = f"CAST({num} AS HUGEINT)", f"CAST({den} AS HUGEINT)", 10**places
    return (
        f"(CASE WHEN {d} <> 0 THEN CAST(sign({n}) * sign({d}) * "
        f"((2 * abs({n}) * {scale} + abs({d})) // (2 * abs({d}))) AS DOUBLE) / {scale} END)"
    )


def whole(expr: str) -> str:
    return f"CAST({expr} AS BIGINT)"
