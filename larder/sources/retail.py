"""The set of retail tables that the analytical plans read."""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from larder.sources import files, schemas


# Files whose names differ from their table's.
CSV_NAMES = {"dark_stores": "darkstores"}


class RetailTables:
    """Retail tables under one folder, ``<folder>/<table>`` as Parquet or ``<table>.csv`` (stores: ``darkstores.csv``).

    With the format ``table``, ``folder`` is a database of the catalog (see ``files.save_bucketed``). A ``period`` (first day, first
    day after; None leaves a side open) keeps the orders placed in it, with their lines and returns; of orders
    written by month, no other month is read.

    Frames are made on first use, so a plan opens only the tables it reads.
    Subclasses may bind other physical tables to the same names.
    """

    def __init__(self, spark: SparkSession, folder: str, fmt: str = "parquet", period: files.Period | None = None):
        if fmt not in ("parquet", "csv", "table"):
            raise ValueError(f"unknown format {fmt!r}: use 'parquet', 'csv' or 'table'")
        self.spark, self.folder, self.fmt, self.period = spark, folder.rstrip("/"), fmt, period

    def _table(self, name: str, timestamp: str | None = None) -> DataFrame:
        """A table; one with a ``timestamp`` in the period alone."""
        period = self.period if timestamp else None
        if self.fmt == "csv":
            return files.declared(files.read_csv(self.spark, name, self._csv(name)), name, period, timestamp)
        if self.fmt == "table":
            return files.declared(self.spark.table(f"{self.folder}.{name}"), name, period, timestamp)
        return files.read_parquet(self.spark, name, f"{self.folder}/{name}", period, timestamp)

    def _of_period(self, rows: DataFrame) -> DataFrame:
        """Rows of the orders that the period keeps."""
        return rows if self.period is None else rows.join(self.orders.select("order_id"), "order_id", "left_semi")

    def _csv(self, name: str) -> str:
        """The table's file; a folder may also hold it under the table's own name."""
        usual = f"{self.folder}/{CSV_NAMES.get(name, name)}.csv"
        if name not in CSV_NAMES:
            return usual
        path = self.spark._jvm.org.apache.hadoop.fs.Path(usual)
        there = path.getFileSystem(self.spark._jsparkSession.sessionState().newHadoopConf()).exists(path)
        return usual if there else f"{self.folder}/{name}.csv"

    @cached_property
    def customers(self) -> DataFrame:
        return self._table("customers")

    @property
    def customer_areas(self) -> DataFrame:
        """Customers including their area; a separate frame where the area lives elsewhere."""
        return self.customers

    @cached_property
    def products(self) -> DataFrame:
        return self._table("products")

    @cached_property
    def dark_stores(self) -> DataFrame:
        return self._table("dark_stores")

    @cached_property
    def riders(self) -> DataFrame:
        return self._table("riders")

    @cached_property
    def orders(self) -> DataFrame:
        return self._table("orders", "order_timestamp")

    @cached_property
    def order_details(self) -> DataFrame:
        return self._of_period(self._table("order_details"))

    @cached_property
    def returns(self) -> DataFrame:
        return self._of_period(self._table("returns"))

    @cached_property
    def inventory(self) -> DataFrame:
        return self._table("inventory")

    def register_views(self, *names: str) -> None:
        """Temporary views of the named tables (all eight by default), for SQL of one's own."""
        for name in names or schemas.TABLE_NAMES:
            getattr(self, name).createOrReplaceTempView(name)
