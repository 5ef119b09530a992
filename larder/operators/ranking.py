"""Top-k within groups."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


# Spark limits window groups on the map side up to this rank (its default threshold).
MAP_SIDE_RANK = 1000
SPLITS = 256


def top_rows(df: DataFrame, by: Sequence[str], order: Sequence[Column], k: int, rank: str = "rank") -> DataFrame:
    """The first ``k`` rows of each group; ``order`` must be total.

    Spark cuts every group to ``k`` rows on the map side (WindowGroupLimit), so
    the task that ranks a group sees k rows per upstream task, not the group.
    Beyond the rank up to which Spark does so, each group is split by hash and
    the parts are cut to ``k`` rows first.
    """
    if k > MAP_SIDE_RANK:
        part = F.pmod(F.xxhash64(*df.columns), F.lit(SPLITS))
        parted = df.withColumn("_part", part)
        within = F.row_number().over(Window.partitionBy(*by, "_part").orderBy(*order))
        df = parted.withColumn("_within", within).filter(F.col("_within") <= k).drop("_part", "_within")
    position = F.row_number().over(Window.partitionBy(*by).orderBy(*order))
    return df.withColumn(rank, position).filter(F.col(rank) <= k)


def top_values(df: DataFrame, by: Sequence[str], value: str, k: int, rank: str = "rank") -> DataFrame:
    """Rows holding one of the ``k`` highest distinct values of their group (ties kept).

    Any number of rows may tie, so rows are never gathered per group: the best
    values are found among distinct values, and rows are matched against that
    short list of at most k entries per group.
    """
    distinct = df.select(*by, value).distinct()
    best = top_rows(distinct, by, [F.col(value).desc_nulls_first()], k, rank)
    left, right = df.alias("l"), best.alias("r")
    same = [F.col(f"l.{c}").eqNullSafe(F.col(f"r.{c}")) for c in [*by, value]]
    condition = same[0]
    for clause in same[1:]:
        condition = condition & clause
    return left.join(right, condition).select("l.*", F.col(f"r.{rank}"))
