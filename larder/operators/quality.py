"""Data-quality checks: each returns the violating rows, so an empty result is a pass.

Row rules are filters. Rules that look at a parent first reduce the parent to one
row per key, so a repeated key on both sides cannot multiply rows. Conditions on
null values count as violated where the rule says "must be", as a comparison with
a missing value is not a confirmation.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larder.functions.money import close_to


def unless(condition: Column) -> Column:
    """True where ``condition`` is false or unknown."""
    return ~F.coalesce(condition, F.lit(False))


def violating(df: DataFrame, rule: Column) -> DataFrame:
    return df.filter(unless(rule))


# --- keys and completeness -------------------------------------------------------------


def repeated_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Key values (one or several columns, nulls equal) that occur more than once, with their count."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("copies")).filter(F.col("copies") > 1)


def repeated_rows(df: DataFrame) -> DataFrame:
    """Rows equal in every column, with their count."""
    return repeated_keys(df, df.columns)


def incomplete_rows(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows with a null in any of the columns."""
    return df.filter(reduce(lambda a, b: a | b, [F.col(c).isNull() for c in columns]))


def null_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column_name, nulls) for every column, in one pass over the data."""
    counted = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    return counted.unpivot([], list(columns), "column_name", "nulls")


def row_count(df: DataFrame, expected: int) -> DataFrame:
    """One row (expected, found) if the table does not have exactly the expected number of rows."""
    return df.agg(F.lit(expected).cast("bigint").alias("expected"), F.count(F.lit(1)).alias("found")).filter(
        F.col("found") != F.col("expected")
    )


# --- references ------------------------------------------------------------------------


def orphans(df: DataFrame, columns: Sequence[str], ref: DataFrame, ref_columns: Sequence[str] | None = None) -> DataFrame:
    """Rows whose (composite) key has no match in ``ref``; rows with a null key are orphans too."""
    ref_columns = ref_columns or columns
    known = ref.select(*[F.col(r).alias(c) for c, r in zip(columns, ref_columns)]).distinct()
    return df.join(known, list(columns), "left_anti")


def parent_state(df: DataFrame, key: str, parent: DataFrame, column: str, allowed: Sequence) -> DataFrame:
    """Rows whose parent row is in another state than the allowed ones."""
    bad = parent.filter(unless(F.col(column).isin(*allowed))).select(key).distinct()
    return df.join(bad, key, "left_semi")


def disagreeing(df: DataFrame, key: str, column: str, ref: DataFrame) -> DataFrame:
    """Rows whose ``column`` differs from that of their ``ref`` row (one row per key), shown as ``expected``."""
    known = ref.select(key, F.col(column).alias("expected"))
    return df.join(known, key).filter(unless(F.col(column) == F.col("expected")))


def early_dates(df: DataFrame, key: str, date: str, ref: DataFrame, ref_date: str) -> DataFrame:
    """Rows dated before their parent row (one per key)."""
    return df.join(ref.select(key, ref_date), key).filter(F.col(date) < F.col(ref_date))


# --- values ----------------------------------------------------------------------------


def outside_domain(df: DataFrame, column: str, values: Sequence) -> DataFrame:
    return violating(df, F.col(column).isin(*values))


def outside_range(df: DataFrame, column: str, low, high) -> DataFrame:
    return violating(df, F.col(column).between(low, high))


def negative(df: DataFrame, *columns: str, or_zero: bool = False) -> DataFrame:
    """Rows where any column is below zero (or not above it)."""
    tests = [(F.col(c) <= 0) if or_zero else (F.col(c) < 0) for c in columns]
    return df.filter(reduce(lambda a, b: a | b, tests))


def fractional(df: DataFrame, column: str) -> DataFrame:
    """Rows whose value is not a whole number."""
    return violating(df, F.col(column) == F.floor(column))


def present_when(df: DataFrame, condition: Column, column: str) -> DataFrame:
    """Rows that hold a value where the condition demands none."""
    return df.filter(condition & F.col(column).isNotNull())


def comparison(df: DataFrame, left: str, operator: str, right: str) -> DataFrame:
    """Rows that fail ``left operator right``; works for numbers and for dates."""
    a, b = F.col(left), F.col(right)
    rules = {"<": a < b, "<=": a <= b, ">": a > b, ">=": a >= b, "==": a == b}
    return violating(df, rules[operator])


def too_frequent(df: DataFrame, column: str, limit: int) -> DataFrame:
    """Values that occur more than ``limit`` times, with their count."""
    return df.groupBy(column).agg(F.count(F.lit(1)).alias("occurrences")).filter(F.col("occurrences") > limit)


def outside_type_bounds(
    df: DataFrame, kind: str, bounds: Mapping[str, Mapping[str, tuple]], equal: Mapping[str, Mapping[str, object]] | None = None
) -> DataFrame:
    """Rows outside the closed bounds of their type; an unknown type violates.

    ``bounds`` is {type: {column: (low, high)}}; ``equal`` is {type: {column: value}}.
    """
    ok = F.lit(False)
    for name, limits in bounds.items():
        rule = F.col(kind) == name
        for column, (low, high) in limits.items():
            rule = rule & F.col(column).between(low, high)
        for column, value in (equal or {}).get(name, {}).items():
            rule = rule & (F.col(column) == F.lit(value))
        ok = ok | rule
    return violating(df, ok)


# --- arithmetic and reconciliation -----------------------------------------------------


def wrong_line_totals(df: DataFrame, gross: Column, discount: str, final: str, atol: float = 1e-8) -> DataFrame:
    """Lines where gross - discount is not the final price, within numeric tolerance."""
    expected = F.round(gross - F.col(discount), 2)
    return violating(df, close_to(expected, F.round(F.col(final), 2), atol))


def unreconciled(
    parents: DataFrame, key: str, total: str, lines: DataFrame, amount: str, tolerance: float = 0.011
) -> DataFrame:
    """Parents whose lines do not add up, each with the rule it breaks.

    Lines are summed per key before they meet the parents. A parent without
    lines and lines without a parent are reported under rules of their own.
    """
    sums = lines.groupBy(key).agg(F.round(F.sum(amount), 2).alias("line_total"))
    both = parents.select(key, total).join(sums, key, "full_outer")
    rule = (
        F.when(F.col("line_total").isNull(), "without lines")
        .when(F.col(total).isNull(), "without parent")
        .when(F.abs(F.col("line_total") - F.col(total)) > F.lit(str(tolerance)).cast("decimal(10,4)"), "total differs")
    )
    return both.withColumn("rule", rule).filter(F.col("rule").isNotNull())


def above_parent_value(
    df: DataFrame, keys: Sequence[str], value: str, parent: DataFrame, limit: str, atol: float = 0.01
) -> DataFrame:
    """Rows whose value exceeds that of any parent row with the same keys, beyond tolerance.

    The tolerance grows with the limit, so the smallest limit per key decides.
    """
    least = parent.groupBy(*keys).agg(F.min(limit).alias("_limit"))
    within = (F.col(value) < F.col("_limit")) | close_to(F.col(value), F.col("_limit"), atol)
    return df.join(least, list(keys)).filter(unless(within)).drop("_limit")


def wrong_for_status(df: DataFrame, status: str, rules: Mapping[str, Column]) -> DataFrame:
    """Rows that break the rule of their status; statuses without a rule pass."""
    broken = [(F.col(status) == name) & unless(rule) for name, rule in rules.items()]
    return df.filter(reduce(lambda a, b: a | b, broken))


def refunds_off_line_value(
    returns: DataFrame, keys: Sequence[str], lines: DataFrame, status: str = "return_status", atol: float = 0.01
) -> DataFrame:
    """Returns whose refund does not follow from their status.

    Pending and rejected returns refund exactly nothing; an approved return
    refunds the value of its line. Several lines may share a key: then the
    refund must fit the smallest and the largest of their values.
    """
    span = lines.groupBy(*keys).agg(F.min("final_item_price").alias("_low"), F.max("final_item_price").alias("_high"))
    refund = F.col("refund_amount")
    matched = F.col("_low").isNull() | (close_to(refund, F.col("_low"), atol) & close_to(refund, F.col("_high"), atol))
    joined = returns.join(span, list(keys), "left")
    return wrong_for_status(
        joined, status, {"Pending": refund == 0, "Rejected": refund == 0, "Approved": matched}
    ).drop("_low", "_high")


def outside_assortment(
    stock: DataFrame, eligible: DataFrame, group: str, kind: str, shares: Mapping[str, tuple], default: tuple
) -> DataFrame:
    """Groups that stock too few or too many of the rows they may stock.

    ``eligible`` has one row per group: its type and ``eligible`` count. The
    bounds are the whole part of the type's share of that count.
    """
    low = F.lit(str(default[0])).cast("decimal(9,6)")
    high = F.lit(str(default[1])).cast("decimal(9,6)")
    for name, (lo, hi) in shares.items():
        low = F.when(F.col(kind) == name, F.lit(str(lo)).cast("decimal(9,6)")).otherwise(low)
        high = F.when(F.col(kind) == name, F.lit(str(hi)).cast("decimal(9,6)")).otherwise(high)
    counted = stock.groupBy(group).agg(F.count(F.lit(1)).alias("stocked"))
    return (
        eligible.filter(F.col("eligible") > 0)
        .join(counted, group, "left")
        .select(
            group,
            kind,
            "eligible",
            F.coalesce("stocked", F.lit(0)).alias("stocked"),
            F.floor(F.col("eligible") * low).cast("bigint").alias("at_least"),
            F.floor(F.col("eligible") * high).cast("bigint").alias("at_most"),
        )
        .filter(~F.col("stocked").between(F.col("at_least"), F.col("at_most")))
    )


# --- report ----------------------------------------------------------------------------


def report(table: str, df: DataFrame, row_rules: Mapping[str, Column], set_rules: Mapping[str, DataFrame]) -> DataFrame:
    """(table_name, rule, violations), one row per rule.

    All row rules of a table are counted in one pass; each set rule adds the
    count of its own violating rows.
    """
    parts = []
    if row_rules:
        names = list(row_rules)
        counted = df.agg(*[F.count_if(unless(row_rules[n])).alias(n) for n in names])
        parts.append(counted.unpivot([], names, "rule", "violations"))
    for name, bad in set_rules.items():
        parts.append(bad.agg(F.lit(name).alias("rule"), F.count(F.lit(1)).alias("violations")))
    joined = reduce(DataFrame.unionByName, [p.select("rule", "violations") for p in parts])
    return joined.select(F.lit(table).alias("table_name"), "rule", "violations")
