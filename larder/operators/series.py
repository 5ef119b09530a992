"""Windows over calendar series (one row per month or day, so bounded by the calendar)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def _calendar(by: Sequence[str], time: str):
    """Ascending time with a missing time last, as in PostgreSQL."""
    return Window.partitionBy(*by).orderBy(F.asc_nulls_last(time))


def with_previous(series: DataFrame, time: str, value: str, out: str, by: Sequence[str] = ()) -> DataFrame:
    """Value of the preceding period that is present in the series."""
    return series.withColumn(out, F.lag(value).over(_calendar(by, time)))


def with_running_sum(series: DataFrame, time: str, value: str, out: str) -> DataFrame:
    frame = _calendar((), time).rangeBetween(Window.unboundedPreceding, Window.currentRow)
    return series.withColumn(out, F.sum(value).over(frame))


def with_moving_mean(series: DataFrame, time: str, value: str, rows: int, out: str, places: int = 2) -> DataFrame:
    """Mean over the last ``rows`` rows of the series; missing days are not filled in."""
    from larder.functions.money import ratio

    frame = _calendar((), time).rowsBetween(1 - rows, Window.currentRow)
    return series.withColumn(out, ratio(F.sum(value).over(frame), F.count(value).over(frame), places))
