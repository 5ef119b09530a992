"""What the physical plans look like: scans, joins, limits and reuse."""

from __future__ import annotations

import re
from collections import Counter

import pytest
from conftest import SF_SMALL

from larder import registered

QUERIES = registered.queries()


def planned(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def final(df) -> str:
    """The adaptive plan after execution, without the initial plans it replaced."""
    df.collect()
    kept, skip = [], None
    for line in planned(df).split("\n"):
        depth = len(line) - len(line.lstrip(" :+-"))
        if skip is not None and depth > skip:
            continue
        skip = depth - 1 if "== Initial Plan ==" in line else None
        if skip is None:
            kept.append(line)
    return "\n".join(kept)


def scans(plan: str) -> Counter:
    return Counter(re.findall(r"FileScan parquet.*?/(\w+)\.parquet", plan))


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_cross_joins_and_no_python(name, spark, no_broadcast):
    plan = planned(QUERIES[name](spark, SF_SMALL))
    assert not re.search(r"CartesianProduct|NestedLoopJoin|EvalPython|InPandas|MapPartitions", plan)


@pytest.mark.parametrize("name", ["m3q4_top_product_by_category", "m5q2_top5_monthly", "m7q3_top3_stores_monthly",
                                  "m7q4_top_customer_by_category", "t17_first_combination", "t24_quota_sample"])
def test_groups_are_cut_on_the_map_side(name, spark):
    assert "WindowGroupLimit" in planned(QUERIES[name](spark, SF_SMALL))


@pytest.mark.parametrize("name", ["m1q4_top_products", "m2q1_top_customers", "m7q1_product_pairs", "p04_top_values"])
def test_limits_become_top_k(name, spark):
    assert "TakeOrderedAndProject" in planned(QUERIES[name](spark, SF_SMALL))


@pytest.mark.parametrize("name,columns", [
    ("m1q2_monthly_orders", "o_orderkey:bigint,o_totalprice:double,o_orderdate:timestamp_ntz"),
    ("m1q3_avg_basket", "l_orderkey:bigint,l_quantity:double"),
    ("m4q3_order_status", "o_orderstatus:string"),
    ("m5q4_churn_risk", "o_custkey:bigint,o_orderdate:timestamp_ntz"),
])
def test_scans_read_only_what_is_used(name, columns, spark):
    assert f"ReadSchema: struct<{columns}>" in planned(QUERIES[name](spark, SF_SMALL))


def test_filters_reach_the_scan(spark):
    plan = planned(QUERIES["m7q5_bought_a_not_b"](spark, SF_SMALL))
    assert re.search(r"PushedFilters: \[In\(p_name, \[red plate,small widget\]\)", plan)


@pytest.mark.parametrize("name,table", [
    ("m2q5_above_avg_products", "lineitem"), ("m3q5_pareto_80", "lineitem"), ("m6q2_category_share", "lineitem"),
    ("m6q4_underperformers", "lineitem"), ("m2q2_top3_by_membership", "orders"), ("m5q1_new_vs_repeat", "orders"),
    ("m8q1_cohort_retention", "orders"), ("m8q2_reactivation", "orders"), ("m8q5_top10_share", "orders"),
    ("m7q5_bought_a_not_b", "lineitem"),
])
def test_facts_are_scanned_once(name, table, spark):
    assert scans(final(QUERIES[name](spark, SF_SMALL)))[table] == 1


@pytest.mark.parametrize("name", ["m5q3_purchase_frequency", "m8q3_clv", "m5q4_churn_risk"])
def test_customer_metrics_need_no_window(name, spark):
    plan = planned(QUERIES[name](spark, SF_SMALL))
    assert "Window" not in plan and "partial_" in plan
