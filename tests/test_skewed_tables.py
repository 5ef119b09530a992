"""All queries on tables where one order, product, customer and category hold a third of the rows."""

from __future__ import annotations

import pytest
from compare import TABLES, database, difference
from conftest import SF_SMALL

from larder import registered

QUERIES = registered.queries()
TWINS = registered.oracle_sql()

HOT = {
    "orders": "SELECT * REPLACE (CASE WHEN o_orderkey % 3 = 0 THEN 5 ELSE o_custkey END AS o_custkey) FROM orders",
    "part": "SELECT * REPLACE (CASE WHEN p_partkey % 3 = 0 THEN 'PROMO' ELSE p_type END AS p_type) FROM part",
    # a third of the lines in one order, a third of one product, and one line five hundred times
    "lineitem": """SELECT * EXCLUDE (n) REPLACE (CASE WHEN n % 3 = 0 THEN 77 ELSE l_orderkey END AS l_orderkey,
            CASE WHEN n % 3 = 1 THEN 3 ELSE l_partkey END AS l_partkey)
        FROM (SELECT *, ROW_NUMBER() OVER () AS n FROM lineitem)
        UNION ALL SELECT l.* FROM (SELECT * FROM lineitem LIMIT 1) l, range(500)""",
}


def write_skewed(source: str, folder: str) -> str:
    db = database(source)
    for name in TABLES:
        query = HOT.get(name, f"SELECT * FROM {name}")
        db.execute(f"COPY ({query}) TO '{folder}/{name}.parquet' (FORMAT parquet, ROW_GROUP_SIZE 2048)")
    return folder


@pytest.fixture(scope="module")
def skewed(tmp_path_factory):
    folder = write_skewed(SF_SMALL, str(tmp_path_factory.mktemp("skewed")))
    return folder, database(folder)


@pytest.mark.parametrize("name", [n for n in sorted(QUERIES) if n[0] in "bmdp" or n[:3] in ("t08", "t13", "t15", "t17", "t18", "t25")])
def test_hot_keys(name, spark, skewed):
    folder, db = skewed
    assert difference(QUERIES[name](spark, folder), db, TWINS[name]) is None
