"""Binding of the retail tables onto the TPC-H-like test tables.

The columns that the analytical plans and checks read are derived here; the
binding drops no rows; ``returns`` takes all flagged lines.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from larder.functions.money import money
from larder.sources.files import in_period
from larder.sources.retail import RetailTables

SCHEMAS = {
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": """o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double,
        o_orderdate timestamp_ntz, o_orderpriority string""",
    "lineitem": """l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double,
        l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string,
        l_shipdate timestamp_ntz""",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
}


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{folder.rstrip('/')}/{name}.parquet")


class TestTables(RetailTables):
    """Retail tables derived from ``customer orders lineitem part supplier nation``."""

    __test__ = False

    def raw(self, name: str) -> DataFrame:
        return table(self.spark, self.folder, name)

    @cached_property
    def customers(self) -> DataFrame:
        return self.raw("customer").select(
            F.col("c_custkey").alias("customer_id"),
            F.col("c_name").alias("customer_name"),
            F.col("c_mktsegment").alias("membership"),
            money(F.col("c_acctbal")).alias("loyalty_score"),
            F.col("c_nationkey").alias("area_id"),
        )

    @property
    def customer_areas(self) -> DataFrame:
        areas = self.raw("nation").select(F.col("n_nationkey").alias("area_id"), F.col("n_name").alias("area"))
        return self.customers.join(areas, "area_id")

    @cached_property
    def products(self) -> DataFrame:
        return self.raw("part").select(
            F.col("p_partkey").alias("product_id"),
            F.col("p_name").alias("product_name"),
            F.col("p_type").alias("category"),
            F.col("p_brand").alias("brand"),
            F.col("p_size").alias("size"),
            money(F.col("p_retailprice")).alias("mrp"),
        )

    @cached_property
    def dark_stores(self) -> DataFrame:
        return self.raw("supplier").select(
            F.col("s_suppkey").alias("store_id"),
            F.col("s_name").alias("store_name"),
            F.col("s_nationkey").alias("area_id"),
        )

    @cached_property
    def riders(self) -> DataFrame:
        status = (
            F.when(F.col("s_acctbal") < 1000, "Inactive").when(F.col("s_acctbal") < 2000, "On Leave").otherwise("Active")
        )
        return self.raw("supplier").select(
            F.col("s_suppkey").alias("rider_id"),
            F.col("s_name").alias("rider_name"),
            (F.col("s_suppkey") % 10).alias("store_id"),
            status.alias("rider_status"),
            money(F.col("s_acctbal")).alias("earnings"),
        )

    @cached_property
    def orders(self) -> DataFrame:
        status = (
            F.when(F.col("o_orderstatus") == "F", "Delivered")
            .when(F.col("o_orderstatus") == "O", "Cancelled")
            .otherwise("Failed")
        )
        rows = self.raw("orders")
        if self.period is not None:
            rows = in_period(rows, "o_orderdate", self.period)
        return rows.select(
            F.col("o_orderkey").alias("order_id"),
            F.col("o_custkey").alias("customer_id"),
            (F.col("o_orderkey") % 10).alias("store_id"),
            (F.col("o_custkey") % 100).alias("rider_id"),
            F.col("o_orderdate").alias("order_timestamp"),
            F.col("o_orderpriority").alias("payment_method"),
            status.alias("order_status"),
            money(F.col("o_totalprice")).alias("total_order_value"),
        )

    @cached_property
    def order_details(self) -> DataFrame:
        gross = money(F.col("l_extendedprice"))
        discount = F.round(gross * F.col("l_discount").cast("decimal(4,2)"), 2).cast("decimal(14,2)")
        rows = self.raw("lineitem").select(
            F.col("l_orderkey").alias("order_id"),
            F.col("l_partkey").alias("product_id"),
            F.col("l_linenumber").alias("line_number"),
            F.col("l_quantity").cast("int").alias("quantity"),
            gross.alias("gross"),
            discount.alias("item_discount"),
            (gross - discount).cast("decimal(14,2)").alias("final_item_price"),
        )
        return self._of_period(rows)

    @cached_property
    def returns(self) -> DataFrame:
        flagged = F.col("l_returnflag") == "R"
        rows = self.raw("lineitem").filter(flagged).select(
            F.concat_ws("-", F.col("l_orderkey"), F.col("l_linenumber")).alias("return_id"),
            F.col("l_orderkey").alias("order_id"),
            F.col("l_partkey").alias("product_id"),
            F.col("l_shipdate").alias("return_date"),
            F.when(F.col("l_linestatus") == "F", "Approved").otherwise("Rejected").alias("return_status"),
            F.round(money(F.col("l_extendedprice")) * F.col("l_discount").cast("decimal(4,2)") * 20, 2)
            .cast("decimal(14,2)")
            .alias("refund_amount"),
        )
        return self._of_period(rows)

    @cached_property
    def inventory(self) -> DataFrame:
        """Stock per supplier and part, rolled up from the lines that moved it."""
        rolled = (
            self.raw("lineitem")
            .groupBy(F.col("l_suppkey").alias("store_id"), F.col("l_partkey").alias("product_id"))
            .agg(
                (F.sum(F.col("l_quantity").cast("int")) % 50).alias("current_stock"),
                F.max("l_linenumber").cast("bigint").alias("reorder_level"),
                F.to_date(F.min("l_shipdate")).alias("last_restock_date"),
                F.to_date(F.max("l_shipdate")).alias("next_restock_date"),
                F.max("l_returnflag").alias("_flag"),
            )
        )
        status = (
            F.when(F.col("_flag") == "A", "Out of Stock").when(F.col("_flag") == "N", "Low Stock").otherwise("In Stock")
        )
        return rolled.withColumn("inventory_status", status).drop("_flag")
