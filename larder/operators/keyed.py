"""Many rules on orders, their lines and their returns in a few keyed passes.

``quality`` has a plan per rule, each with its own scan. Here all rules on lines and orders share one scan of either table:
lines are added up per (order, product), which also takes a large order apart, then per order, where they meet the
orders; every rule is a conditional count on the way. Returns meet their orders once. Counts are those of the
rules of ``quality``; where several orders share a key, a return is early if it is dated before any of them.
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larder.operators.quality import unless


def with_unknown(df: DataFrame, column: str, ref: DataFrame, ref_column: str, name: str) -> DataFrame:
    """``df`` with a column that is true where ``column`` has no match in ``ref``; a null key has none."""
    known = ref.select(F.col(ref_column).alias("_known")).distinct()
    joined = df.join(known, F.col(column) == F.col("_known"), "left")
    return joined.withColumn(name, F.col("_known").isNull()).drop("_known")


def counted(sums: DataFrame, rules: Mapping[tuple[str, str], str]) -> DataFrame:
    """(table_name, rule, violations) of the one row of ``sums``; ``rules`` names the column of each."""
    rows = [
        F.struct(
            F.lit(table).alias("table_name"),
            F.lit(rule).alias("rule"),
            F.coalesce(F.col(column), F.lit(0)).cast("bigint").alias("violations"),
        )
        for (table, rule), column in rules.items()
    ]
    return sums.select(F.inline(F.array(*rows)))


def orders_and_lines(
    orders: DataFrame,
    lines: DataFrame,
    order_rules: Mapping[str, Column],
    line_rules: Mapping[str, Column],
    order_refs: Mapping[str, tuple[str, DataFrame]],
    product_refs: Mapping[str, DataFrame],
    key: str = "order_id",
    product: str = "product_id",
    total: str = "total_order_value",
    amount: str = "final_item_price",
    tolerance: str = "0.011",
) -> DataFrame:
    """Counts of all rules on orders and on lines.

    ``order_rules`` and ``line_rules`` hold for each row; ``order_refs`` is {rule: (column, reference)} and ``product_refs``
    {rule: reference} for keys that must be known. Three rules are always there: ``order_id unique``,
    ``product once per order`` and ``lines add up`` (an order without lines, lines without an order, or another total).
    """
    rules: dict[tuple[str, str], str] = {}

    def named(table: str, rule: str) -> str:
        return rules.setdefault((table, rule), f"_{len(rules)}")

    line_columns = {named("order_details", rule): F.count_if(unless(c)) for rule, c in line_rules.items()}
    pairs = lines.groupBy(key, product).agg(
        F.count(F.lit(1)).alias("_n"), F.sum(amount).alias("_amount"), *[c.alias(n) for n, c in line_columns.items()]
    )
    unknown = [named("order_details", rule) for rule in product_refs]
    for name, ref in zip(unknown, product_refs.values(), strict=True):
        pairs = with_unknown(pairs, product, ref, product, name)
    repeated = named("order_details", "product once per order")
    per_order = pairs.groupBy(key).agg(
        F.round(F.sum("_amount"), 2).alias("_line_total"),
        F.count_if(F.col("_n") > 1).alias(repeated),
        *[F.sum(n).alias(n) for n in line_columns],
        *[F.sum(F.when(F.col(n), F.col("_n")).otherwise(0)).alias(n) for n in unknown],
    )
    of_lines = [repeated, *line_columns, *unknown]

    of_orders = {named("orders", rule): unless(c) for rule, c in order_rules.items()}
    sold = orders.select("*", *[c.alias(n) for n, c in of_orders.items()])
    for rule, (column, ref) in order_refs.items():
        name = named("orders", rule)
        sold = with_unknown(sold, column, ref, column, name)
        of_orders[name] = F.col(name)
    sold = sold.select(key, F.col(total).alias("_total"), F.lit(1).alias("_order"), *of_orders)
    off = (
        F.col("_line_total").isNull()
        | F.col("_total").isNull()
        | (F.abs(F.col("_line_total") - F.col("_total")) > F.lit(tolerance).cast("decimal(10,4)"))
    )
    unique, add_up = named("orders", "order_id unique"), named("orders", "lines add up")
    per_key = (
        sold.join(per_order, key, "full_outer")
        .groupBy(key)
        .agg(
            F.sum("_order").alias("_copies"),
            F.count_if(off).alias(add_up),
            *[F.count_if(F.col(n)).alias(n) for n in of_orders],
            *[F.max(n).alias(n) for n in of_lines],  # one row of lines a key, beside each copy of its order
        )
    )
    sums = per_key.agg(
        F.count_if(F.col("_copies") > 1).alias(unique), *[F.sum(n).alias(n) for n in (add_up, *of_orders, *of_lines)]
    )
    return counted(sums, rules)


def returns_of_orders(
    returns: DataFrame,
    orders: DataFrame,
    allowed: tuple[str, ...] = ("Delivered",),
    key: str = "order_id",
    status: str = "order_status",
    placed: str = "order_timestamp",
) -> DataFrame:
    """Counts of ``return_id unique``, ``order delivered`` and ``return after order``."""
    parents = orders.groupBy(key).agg(
        F.max(unless(F.col(status).isin(*allowed))).alias("_wrong"), F.max(placed).alias("_placed")
    )
    per_return = (
        returns.join(parents, key, "left")
        .groupBy("return_id")
        .agg(
            F.count(F.lit(1)).alias("_copies"),
            F.count_if(F.col("_wrong")).alias("_wrong"),
            F.count_if(F.col("return_date") < F.col("_placed")).alias("_early"),
        )
    )
    sums = per_return.agg(
        F.count_if(F.col("_copies") > 1).alias("_copies"), F.sum("_wrong").alias("_wrong"), F.sum("_early").alias("_early")
    )
    rules = {"return_id unique": "_copies", "order delivered": "_wrong", "return after order": "_early"}
    return counted(sums, {("returns", rule): column for rule, column in rules.items()})


def together(*reports: DataFrame) -> DataFrame:
    return reduce(DataFrame.unionByName, reports)
