"""Every registered query against its SQL twin, with broadcast joins and without."""

from __future__ import annotations

import pytest
from compare import difference
from conftest import SF_SMALL

import __spark_entry__ as entry_module
from larder import registered

QUERIES = registered.queries()
TWINS = registered.oracle_sql()


def test_every_query_has_a_twin():
    assert set(TWINS) == set(QUERIES)
    assert set(QUERIES) <= set(entry_module.queries())


def test_entry_returns_rows(spark):
    assert entry_module.entry(spark).columns == ["orders", "order_month", "monthly_revenue"]


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_matches_twin(name, spark, db_small):
    assert difference(QUERIES[name](spark, SF_SMALL), db_small, TWINS[name]) is None


JOINING = [n for n in sorted(QUERIES) if n[0] == "m" or n in ("dq06_composite_foreign_key", "dq15_reconciliation",
                                                             "t08_discount_allocation", "t25_weighted_sample")]


@pytest.mark.parametrize("name", JOINING)
def test_matches_twin_with_shuffled_joins(name, spark, db_small, no_broadcast):
    assert difference(QUERIES[name](spark, SF_SMALL), db_small, TWINS[name]) is None
