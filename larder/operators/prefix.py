"""Ordered running totals and ranks that never put a whole group into one task.

A window without PARTITION BY (or over one hot key) sorts everything in a single
task. Here the sort key is cut into nested ``levels`` - coarse buckets first -
such that each bucket holds a bounded number of finer buckets. Totals are rolled
up level by level, prefix sums are taken inside each bucket, and offsets flow
back down by equi-joins on the bucket. Buckets are pure functions of the sort
key: no sampling, so a recomputed task always lands in the same place.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

BUCKET_BITS = 22
# Characters of a text id per level of its trie, and levels.
LEVEL_CHARACTERS, TEXT_LEVELS = 2, 3


def level_columns(key: Column, depth: int = 2) -> list[Column]:
    """Nested buckets of a whole-number key, coarse to fine; the last is the key."""
    return [F.shiftright(key, BUCKET_BITS * d) for d in range(depth - 1, 0, -1)] + [key]


def id_buckets(df: DataFrame, column: str) -> Column:
    """A coarse bucket of a whole-number id that agrees with the id's own order: its high bits."""
    kind = df.schema[column].dataType
    if not isinstance(kind, T.IntegralType):
        raise TypeError(f"{column}: whole numbers have buckets, not {kind.simpleString()}; see id_levels")
    return F.shiftright(F.col(column).cast("bigint"), BUCKET_BITS)


def common_prefix(df: DataFrame, column: str) -> Column:
    """Number of characters with which all values of a text column begin: those that the least and the greatest share."""
    ends = df.agg(F.min(column).alias("a"), F.max(column).alias("z"))
    differs = F.expr(
        """CASE WHEN least(length(a), length(z)) > 0 THEN
            filter(sequence(1, least(length(a), length(z))), i -> substring(a, i, 1) <> substring(z, i, 1))
            ELSE cast(array() AS array<int>) END"""
    )
    shared = F.coalesce(F.array_min(differs) - 1, F.least(F.length("a"), F.length("z")))
    return F.coalesce(ends.select(shared.alias("n")).scalar(), F.lit(0))


def id_levels(df: DataFrame, column: str) -> list[Column]:
    """Nested buckets of an id, coarse to fine, that agree with the id's own order.

    Whole numbers have their high bits. Texts have a trie below the prefix that all of them share
    (found in the plan): each level adds ``LEVEL_CHARACTERS`` characters, so a bucket has at most as many
    buckets below it as there are such strings, however long the shared prefix is.
    """
    kind = df.schema[column].dataType
    if isinstance(kind, T.IntegralType):
        return [id_buckets(df, column)]
    if not isinstance(kind, T.StringType):
        raise TypeError(f"{column}: ids are whole numbers or strings, not {kind.simpleString()}")
    start = common_prefix(df, column)
    return [F.col(column).substr(start + 1 + LEVEL_CHARACTERS * k, F.lit(LEVEL_CHARACTERS)) for k in range(TEXT_LEVELS)]


def attach(left: DataFrame, right: DataFrame, keys: Sequence[str], column: str) -> DataFrame:
    """``left`` with one more column from ``right``, which has one row per key; nulls match nulls."""
    a, b = left.alias("a"), right.alias("b")
    same = F.lit(True)
    for key in keys:
        same = same & F.col(f"a.{key}").eqNullSafe(F.col(f"b.{key}"))
    return a.join(b, same).select("a.*", F.col(f"b.{column}"))


def exclusive_totals(
    cells: DataFrame,
    group: Sequence[str],
    levels: Sequence[str],
    value: str,
    out: str = "before",
    descending: bool = False,
) -> DataFrame:
    """Add ``out``: the sum of ``value`` over the cells of the group that sort earlier.

    ``cells`` must hold one row per (group, levels).
    """
    group, levels = list(group), list(levels)
    zero = F.lit(0)
    outer_keys = group + levels[:-1]
    by = F.col(levels[-1]).desc() if descending else F.col(levels[-1])
    local = Window.partitionBy(*outer_keys).orderBy(by).rowsBetween(Window.unboundedPreceding, -1)
    if len(levels) == 1:
        return cells.withColumn(out, F.coalesce(F.sum(value).over(local), zero))
    outer = cells.groupBy(*outer_keys).agg(F.sum(value).alias(value))
    offset = f"_offset{len(levels)}"
    offsets = exclusive_totals(outer, group, levels[:-1], value, offset, descending).select(*outer_keys, offset)
    return (
        attach(cells, offsets, outer_keys, offset)
        .withColumn(out, F.col(offset) + F.coalesce(F.sum(value).over(local), zero))
        .drop(offset)
    )


def running_total(df: DataFrame, key: Column, value: str, out: str, depth: int = 2) -> DataFrame:
    """Running sum of ``value`` in ascending order of a whole-number key, peers included.

    Rows with equal keys share one total, as in a RANGE frame up to the current
    row. Equal keys are merged before the sums and matched back afterwards.
    """
    names = [f"_level{i}" for i in range(depth)]
    keyed = df.withColumn(names[-1], key)
    merged = keyed.groupBy(names[-1]).agg(F.sum(value).alias("_amount"))
    leveled = merged.select(
        *[c.alias(n) for n, c in zip(names[:-1], level_columns(F.col(names[-1]), depth))], names[-1], "_amount"
    )
    totals = exclusive_totals(leveled, [], names, "_amount").select(
        names[-1], (F.col("before") + F.col("_amount")).alias(out)
    )
    return keyed.join(totals, names[-1]).select(*df.columns, out)


def ordered_rank(
    df: DataFrame,
    group: Sequence[str],
    levels: Sequence[Column],
    order: Sequence[Column],
    out: str = "rank",
    descending: bool = False,
) -> DataFrame:
    """1-based row number within the group, for groups of any size.

    ``levels`` are bucket expressions that agree with ``order``: rows of an
    earlier bucket sort before rows of a later one. ``descending`` turns the
    order of the buckets; ``order`` states its own directions.
    """
    names = [f"_bucket{i}" for i in range(len(levels))]
    keyed = df.select("*", *[c.alias(n) for n, c in zip(names, levels)])
    keys = [*group, *names]
    cells = keyed.groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows"))
    offsets = exclusive_totals(cells, group, names, "_rows", descending=descending).select(*keys, "before")
    local = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    ranked = attach(keyed, offsets, keys, "before").withColumn(out, (F.col("before") + local).cast("bigint"))
    return ranked.select(*df.columns, out)


def sequence_number(df: DataFrame, key: str, out: str = "sequence") -> DataFrame:
    """1-based position of each row in ascending order of a unique id."""
    return ordered_rank(df, [], id_levels(df, key), [F.col(key)], out)
