"""Reading and writing the retail tables and the nested catalogue."""

from __future__ import annotations

import datetime
from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from larder.sources import schemas


def read_csv(spark: SparkSession, table: str, path: str) -> DataFrame:
    """A retail table from CSV with header; malformed rows and foreign headers fail the read."""
    return (
        spark.read.schema(schemas.schema(table))
        .option("header", True)
        .option("enforceSchema", False)
        .option("mode", "FAILFAST")
        .csv(path)
    )


# A period: the first day in it and the first day after it, as ISO dates; None leaves that side open.
Period = tuple[str | None, str | None]
MONTH = "month"


def read_parquet(spark: SparkSession, table: str, path: str, period: Period | None = None, timestamp: str = "") -> DataFrame:
    """The declared columns of a table; of a table written by month, only the months that a period touches are read."""
    return declared(spark.read.schema(schemas.schema(table)).parquet(path), table, period, timestamp)


def declared(df: DataFrame, table: str, period: Period | None = None, timestamp: str = "") -> DataFrame:
    names = schemas.schema(table).fieldNames()
    if period is not None:
        df = in_period(df, timestamp, period, MONTH if MONTH in df.columns and MONTH not in names else None)
    return df.select(*names)


def in_period(df: DataFrame, timestamp: str, period: Period, month: str | None = None) -> DataFrame:
    """Rows whose timestamp lies in the period, none without one; ``month`` is a column of their months as ``yyyy-MM``."""
    first, after = (None if d is None else datetime.date.fromisoformat(d) for d in period)
    kept = df.filter(F.col(timestamp).isNotNull())
    if first is not None:
        kept = kept.filter(F.col(timestamp) >= F.lit(first))
        kept = kept.filter(F.col(month) >= f"{first:%Y-%m}") if month else kept
    if after is not None:
        kept = kept.filter(F.col(timestamp) < F.lit(after))
        kept = kept.filter(F.col(month) <= f"{after - datetime.timedelta(days=1):%Y-%m}") if month else kept
    return kept


def save_bucketed(df: DataFrame, name: str, key: str, buckets: int, month_of: str | None = None) -> None:
    """A table of the catalog in buckets of a key: tables with the same key and number of buckets join without a shuffle.

    Rows are dealt by the key before the write, so that every bucket is one file (one a month with ``month_of``).
    """
    rows = df if month_of is None else df.withColumn(MONTH, F.date_format(month_of, "yyyy-MM"))
    writer = rows.repartition(buckets, key).write.mode("errorifexists").format("parquet").bucketBy(buckets, key).sortBy(key)
    (writer if month_of is None else writer.partitionBy(MONTH)).saveAsTable(name)


def write_csv(df: DataFrame, path: str) -> None:
    """CSV with header, in the frame's own column order."""
    df.write.mode("errorifexists").option("header", True).csv(path)


def write_parquet(df: DataFrame, path: str, month_of: str | None = None) -> None:
    """Parquet; with ``month_of`` partitioned by month so that monthly queries prune directories.

    Rows are clustered by month before the write, spread over several files per
    month by adaptive execution, which splits a month that is too large.
    """
    if month_of is None:
        df.write.mode("errorifexists").parquet(path)
        return
    monthly = df.withColumn(MONTH, F.date_format(month_of, "yyyy-MM"))
    monthly.hint("rebalance", MONTH).write.mode("errorifexists").partitionBy(MONTH).parquet(path)


def read_catalogue(spark: SparkSession, path: str) -> DataFrame:
    """The nested catalogue document(s): one row per document."""
    return (
        spark.read.schema(schemas.catalogue_schema())
        .option("multiLine", True)
        .option("mode", "FAILFAST")
        .json(path)
    )


# Where a malformed record is kept as it came.
CORRUPT = "_corrupt_record"


def parse_csv(df: DataFrame, column: str, table: str, mode: str = "PERMISSIVE") -> DataFrame:
    """CSV records in a text column as the declared columns of a table, in place of that column.

    With ``PERMISSIVE`` a record that does not fit the schema has nulls and stands in ``_corrupt_record``; with ``FAILFAST`` it
    fails the job.
    """
    return _parsed(df, column, schemas.schema(table), mode, F.from_csv)


def parse_catalogue(df: DataFrame, column: str, mode: str = "PERMISSIVE") -> DataFrame:
    """Catalogue documents in a JSON text column as nested ``categories``; malformed ones as in ``parse_csv``."""
    return _parsed(df, column, schemas.catalogue_schema(), mode, F.from_json)


def _parsed(df: DataFrame, column: str, schema: T.StructType, mode: str, parse: Callable) -> DataFrame:
    if mode not in ("PERMISSIVE", "FAILFAST"):
        raise ValueError(f"unknown mode {mode!r}: use 'PERMISSIVE' or 'FAILFAST'")
    full = schema if mode == "FAILFAST" else T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
    options = {"mode": mode} if mode == "FAILFAST" else {"mode": mode, "columnNameOfCorruptRecord": CORRUPT}
    text = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in full.fields) if parse is F.from_csv else full
    others = [F.col(f"`{c}`") for c in df.columns if c != column]
    return df.select(*others, parse(F.col(column), text, options).alias("_record")).select(
        *others, *(F.col(f"_record.`{f.name}`") for f in full.fields)
    )


def require_columns(df: DataFrame, columns: Iterable[str], name: str = "table") -> DataFrame:
    """The frame itself, or a ValueError naming the missing columns; reads no data."""
    present = {c.lower() for c in df.columns}
    missing = [c for c in columns if c.lower() not in present]
    if missing:
        raise ValueError(f"{name} lacks required column(s): {', '.join(missing)}")
    return df


def require_keys(df: DataFrame, keys: Iterable[str], name: str = "table") -> DataFrame:
    """The frame itself, or a ValueError if the key columns hold nulls or repeat."""
    keys = list(keys)
    require_columns(df, keys, name)
    missing = F.count_if(F.greatest(*[F.col(k).isNull() for k in keys], F.lit(False)))
    empty = df.agg(missing).first()[0]
    if empty:
        raise ValueError(f"{name}: {empty} row(s) without {', '.join(keys)}")
    repeated = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("copies")).filter(F.col("copies") > 1).count()
    if repeated:
        raise ValueError(f"{name}: {repeated} repeated value(s) of {', '.join(keys)}")
    return df


def require_some(df: DataFrame, condition: Column, what: str) -> DataFrame:
    """The rows that meet the condition, or a ValueError if there are none."""
    kept = df.filter(condition)
    if kept.isEmpty():
        raise ValueError(f"no {what} found")
    return kept


def to_table_columns(df: DataFrame, table: str) -> DataFrame:
    """Exactly the declared columns of a table, in declared order."""
    names = schemas.schema(table).fieldNames()
    return require_columns(df, names, table).select(*names)


def blank_to_null(df: DataFrame, columns: Iterable[str], sentinel: str = "Not Applicable") -> DataFrame:
    """Turn the text sentinel for 'no value' into null, keeping the other values."""
    return df.withColumns({c: F.nullif(F.col(c), F.lit(sentinel)) for c in columns})
