"""Summaries of a table: distributions, means, nulls and duplicates."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larder.functions.money import mean, percent, ratio


def value_shares(df: DataFrame, column: str, places: int = 2) -> DataFrame:
    """(column, rows, share_pct): how often each value occurs; nulls are left out."""
    counted = df.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("rows"))
    total = counted.agg(F.sum("rows")).scalar()
    return counted.withColumn("share_pct", percent(F.col("rows"), total, places))


def distributions(df: DataFrame, columns: Sequence[str], places: int = 2) -> DataFrame:
    """(column_name, value, rows, share_pct) for several columns in one pass.

    Rows are unpivoted to (column, value) and combined map-side, so the shuffle
    carries distinct values, not rows.
    """
    long = df.select(*[F.col(c).cast("string").alias(c) for c in columns]).unpivot([], list(columns), "column_name", "value")
    counted = long.filter(F.col("value").isNotNull()).groupBy("column_name", "value").agg(F.count(F.lit(1)).alias("rows"))
    totals = counted.groupBy("column_name").agg(F.sum("rows").alias("_total"))
    return (
        counted.join(totals, "column_name")
        .withColumn("share_pct", percent(F.col("rows"), F.col("_total"), places))
        .drop("_total")
    )


def means(df: DataFrame, columns: Sequence[str], by: Sequence[str] = (), places: int = 2) -> DataFrame:
    """Count, sum and mean of numeric columns, overall or per group."""
    measures: list[Column] = [F.count(F.lit(1)).alias("rows")]
    for c in columns:
        measures += [F.sum(c).alias(f"{c}_sum"), mean(F.col(c), places).alias(f"{c}_mean")]
    return (df.groupBy(*by) if by else df).agg(*measures)


def gaps_and_repeats(df: DataFrame, keys: Mapping[str, Sequence[str]]) -> DataFrame:
    """(measure, found): nulls over all columns, repeated rows, and surplus rows of each named key.

    Surplus counts every occurrence after the first.
    """
    nulls = df.agg(
        F.coalesce(F.sum(reduce(lambda a, b: a + b, [F.col(c).isNull().cast("bigint") for c in df.columns])), F.lit(0)).alias(
            "found"
        )
    ).select(F.lit("nulls").alias("measure"), "found")

    def surplus(name: str, columns: Sequence[str]) -> DataFrame:
        copies = df.groupBy(*columns).agg(F.count(F.lit(1)).alias("_copies"))
        extra = copies.agg(F.coalesce(F.sum(F.col("_copies") - 1), F.lit(0)).alias("found"))
        return extra.select(F.lit(name).alias("measure"), "found")

    parts = [nulls, surplus("repeated rows", df.columns), *[surplus(n, c) for n, c in keys.items()]]
    return reduce(DataFrame.unionByName, parts)


def top_values(df: DataFrame, column: str, n: int) -> DataFrame:
    """The ``n`` most frequent values; equal counts in order of value."""
    counted = df.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("rows"))
    return counted.orderBy(F.desc("rows"), column).limit(n)


def counts_by_attribute(df: DataFrame, key: str, dimension: DataFrame, attribute: str) -> DataFrame:
    """(attribute, members, rows, rows_per_member): rows per attribute of a joined dimension.

    Rows are counted per key first, so the join sees one row per key.
    """
    per_key = df.groupBy(key).agg(F.count(F.lit(1)).alias("_rows"))
    return (
        per_key.join(dimension.select(key, attribute), key, "left")
        .groupBy(attribute)
        .agg(
            F.count(F.lit(1)).alias("members"),
            F.sum("_rows").alias("rows"),
            mean(F.col("_rows"), 2).alias("rows_per_member"),
        )
    )


def return_summary(returns: DataFrame, lines: DataFrame, statuses: Sequence[str] = ("Approved", "Rejected", "Pending")) -> DataFrame:
    """One row: returns, their share of all lines, share per status, refund mean and sum."""
    line_count = lines.agg(F.count(F.lit(1))).scalar()
    return (
        returns.agg(
            F.count(F.lit(1)).alias("total_returns"),
            *[F.count_if(F.col("return_status") == s).alias(f"_{s}") for s in statuses],
            mean(F.col("refund_amount"), 2).alias("average_refund"),
            F.sum("refund_amount").alias("total_refund"),
        )
        .withColumn("return_rate_pct", percent(F.col("total_returns"), line_count))
        .withColumns({f"{s.lower()}_pct": percent(F.col(f"_{s}"), F.col("total_returns")) for s in statuses})
        .drop(*[f"_{s}" for s in statuses])
    )


def line_summary(lines: DataFrame) -> DataFrame:
    """One row: lines, orders with lines, lines per order, mean price and discount, total value."""
    return lines.agg(
        F.count(F.lit(1)).alias("total_lines"),
        F.countDistinct("order_id").alias("orders"),
        mean(F.col("final_item_price"), 2).alias("average_final_price"),
        mean(F.col("item_discount"), 2).alias("average_discount"),
        F.sum("final_item_price").alias("total_value"),
    ).withColumn("lines_per_order", ratio(F.col("total_lines"), F.col("orders"), 2))
