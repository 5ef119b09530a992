"""Files in and out."""

from __future__ import annotations

import json
import re
import uuid
from decimal import Decimal as D

import pytest
import shop as s
from pyspark.sql import functions as F

from larder.operators import derive
from larder.plans import sales
from larder.sources import files, schemas
from larder.sources.retail import RetailTables


def test_csv_round_trip_with_title_case_header(spark, tmp_path):
    path = str(tmp_path / "riders.csv")
    title = [F.col(c).alias("_".join(w.capitalize() for w in c.split("_"))) for c in schemas.schema("riders").fieldNames()]
    files.write_csv(s.Shop(spark).riders.select(*title), path)
    back = files.read_csv(spark, "riders", path)
    assert back.columns == schemas.schema("riders").fieldNames()
    assert sorted(back.collect()) == sorted(s.Shop(spark).riders.collect())


def test_csv_with_foreign_header_fails(spark, tmp_path):
    path = tmp_path / "riders.csv"
    path.write_text("Rider_ID,Name,Store_ID,Rider_Status,Average_Rating,Average_Delivery_Time_Min\nR1,A,S1,Active,4.0,12.0\n")
    with pytest.raises(Exception, match="(?i)header"):
        files.read_csv(spark, "riders", str(path)).collect()


def test_csv_with_malformed_row_fails(spark, tmp_path):
    path = tmp_path / "riders.csv"
    header = ",".join(schemas.schema("riders").fieldNames())
    path.write_text(f"{header}\nR1,A,S1,Active,high,12.0\n")
    with pytest.raises(Exception, match="(?i)malformed"):
        files.read_csv(spark, "riders", str(path)).collect()


def test_whole_shop_from_csv_and_parquet(spark, tmp_path):
    shop = s.Shop(spark)
    for name in schemas.TABLE_NAMES:
        files.write_csv(getattr(shop, name), str(tmp_path / f"{name}.csv"))
        month = "order_timestamp" if name == "orders" else None
        files.write_parquet(getattr(shop, name), str(tmp_path / name), month)
    expected = sales.overview(shop).collect()
    for fmt in ("csv", "parquet"):
        assert sales.overview(RetailTables(spark, str(tmp_path), fmt)).collect() == expected
    with pytest.raises(ValueError):
        RetailTables(spark, str(tmp_path), "orc")


def test_monthly_files_prune_by_month(spark, tmp_path):
    path = str(tmp_path / "orders")
    files.write_parquet(s.Shop(spark).orders, path, "order_timestamp")
    april = spark.read.parquet(path).filter("month = '2025-04'")
    assert april.count() == 2
    assert "PartitionFilters: [isnotnull(month" in april._jdf.queryExecution().executedPlan().toString()


def test_period_reads_its_months_alone(spark, tmp_path):
    shop = s.Shop(spark)
    for name in schemas.TABLE_NAMES:
        files.write_parquet(getattr(shop, name), str(tmp_path / name), "order_timestamp" if name == "orders" else None)
    whole = RetailTables(spark, str(tmp_path))
    assert whole.orders.columns == schemas.schema("orders").fieldNames()
    days = sorted(r[0].date().isoformat() for r in whole.orders.select("order_timestamp").collect())
    for period in ((days[0], days[-1]), (days[1], None), (None, days[-1]), (days[0], days[0])):
        t = RetailTables(spark, str(tmp_path), period=period)
        plan = t.orders._jdf.queryExecution().executedPlan().toString()
        assert re.search(r"PartitionFilters: \[[^]]*month", plan)
        kept = [d for d in days if (period[0] or "") <= d < (period[1] or "9")]
        assert sorted(r[0].date().isoformat() for r in t.orders.select("order_timestamp").collect()) == kept
        ids = {r.order_id for r in t.orders.collect()}
        assert {r.order_id for r in t.order_details.collect()} <= ids
        assert {r.order_id for r in t.returns.collect()} <= ids
    lines = whole.order_details.count()
    assert RetailTables(spark, str(tmp_path), period=(None, None)).order_details.count() == lines


def test_bucketed_tables_join_without_shuffle(spark, tmp_path, no_broadcast):
    shop, base = s.Shop(spark), f"shop_{uuid.uuid4().hex}"
    spark.sql(f"CREATE DATABASE {base} LOCATION '{tmp_path}'")
    for name in schemas.TABLE_NAMES:
        if name in ("orders", "order_details"):
            month = "order_timestamp" if name == "orders" else None
            files.save_bucketed(getattr(shop, name), f"{base}.{name}", "order_id", 4, month)
        else:
            getattr(shop, name).write.saveAsTable(f"{base}.{name}")
    t = RetailTables(spark, base, "table")
    joined = t.order_details.join(t.orders, "order_id")
    assert "Exchange hashpartitioning" not in joined._jdf.queryExecution().executedPlan().toString()
    assert joined.count() == shop.order_details.join(shop.orders, "order_id").count()
    assert sales.overview(t).collect() == sales.overview(shop).collect()
    first = t.orders.selectExpr("date(min(order_timestamp))").first()[0].isoformat()
    later = RetailTables(spark, base, "table", period=(first, None))
    assert "Exchange hashpartitioning" not in later.order_details._jdf.queryExecution().executedPlan().toString()
    assert sales.overview(later).collect() == sales.overview(shop).collect()


def test_views_serve_sql(spark):
    s.Shop(spark).register_views("orders", "customers")
    found = spark.sql("""SELECT c.customer_name, SUM(o.total_order_value) AS spent FROM customers c
        JOIN orders o ON o.customer_id = c.customer_id GROUP BY ALL ORDER BY spent DESC""").collect()
    assert [tuple(r) for r in found] == [("Person 1", D("270.00")), ("Person 2", D("85.00"))]
    s.Shop(spark).register_views()
    assert {v.name for v in spark.catalog.listTables() if v.isTemporary} >= set(schemas.TABLE_NAMES)


def test_missing_columns_are_named(spark):
    with pytest.raises(ValueError, match="Rider_Status"):
        files.require_columns(s.Shop(spark).riders.drop("rider_status"), ["Rider_ID", "Rider_Status"], "riders")
    assert files.to_table_columns(s.Shop(spark).riders.withColumn("x", F.lit(1)), "riders").columns[-1] != "x"


def test_keys_must_be_present_once(spark):
    stores = s.Shop(spark).dark_stores
    assert files.require_keys(stores, ["store_id"], "stores") is stores
    with pytest.raises(ValueError, match="1 repeated"):
        files.require_keys(stores.unionByName(stores.limit(1)), ["store_id"], "stores")
    with pytest.raises(ValueError, match="2 row"):
        files.require_keys(stores.withColumn("store_id", F.lit(None).cast("string")), ["store_id"], "stores")
    assert files.require_some(s.Shop(spark).riders, F.col("rider_status") == "Active", "active riders").count() == 2
    with pytest.raises(ValueError, match="no active riders"):
        files.require_some(s.Shop(spark).riders, F.col("rider_status") == "Gone", "active riders")


def test_sentinel_becomes_null(spark):
    assert files.blank_to_null(s.Shop(spark).products, ["variant"]).filter("variant is null").count() == 4


CATALOGUE = {
    "metadata": {"version": "1"},
    "categories": [
        {
            "category_name": "Snacks",
            "sub_categories": [
                {
                    "sub_category_name": "Chips", "storage_type": "Ambient", "gst_percentage": 12, "base_shelf_life_days": 120,
                    "brands": [{"name": "A", "tier": "Premium"}, {"name": "B", "tier": "Budget"}],
                    "items": [
                        {"item_name": "Wafer", "types": ["Baked", "Fried"], "variants": [], "flavours": ["Salt", "Chili", "Lime"],
                         "sizes": [{"unit": "g", "value": 90, "price_range": {"min": 20, "max": 35.5}},
                                   {"unit": "kg", "value": 1.5, "price_range": {"min": 200, "max": 300}}]},
                        {"item_name": "Nacho", "types": [], "variants": ["Large"], "sizes": [
                            {"unit": "g", "value": 60, "price_range": {"min": 10, "max": 20}}]},
                        {"item_name": "Unsized", "types": ["x"], "variants": ["y"], "flavours": ["z"], "sizes": []},
                    ],
                }
            ],
        },
        {"category_name": "Empty", "sub_categories": []},
    ],
}


def test_catalogue_flattens_every_combination(spark, tmp_path):
    path = tmp_path / "catalogue.json"
    path.write_text(json.dumps(CATALOGUE, indent=2))
    flat = derive.flatten_catalogue(files.read_catalogue(spark, str(path)))
    assert flat.count() == 2 * (2 * 1 * 3 * 2) + 2 * 1
    nacho = flat.filter("item = 'Nacho' and brand = 'A'").first()
    assert (nacho.type, nacho.variant, nacho.flavour, nacho.size, nacho.price_min) == (None, "Large", None, D("60.00"), D("10.00"))
    keys = ["brand", "item", "type", "variant", "flavour", "size"]
    assert derive.first_of_each(flat.unionByName(flat), keys, [F.col("category")]).count() == flat.count()
