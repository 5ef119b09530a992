"""How a plan becomes a registered query on the test tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from larder.sources.files import Period
from larder.sources.testdata import TestTables

Query = Callable[[SparkSession, str], DataFrame]


def present(df: DataFrame) -> DataFrame:
    """Decimals as doubles (at most six decimals), for engines without a common decimal type."""
    shown = []
    for field in df.schema.fields:
        column = F.col(f"`{field.name}`")
        if isinstance(field.dataType, T.DecimalType):
            column = (F.round(column, 6) if field.dataType.scale > 6 else column).cast("double")
        shown.append(column.alias(field.name))
    return df.select(*shown)


def bind(plan: Callable[..., DataFrame], period: Period | None = None, **params) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return present(plan(TestTables(spark, sf_dir, period=period), **params))

    run.__name__, run.__doc__ = plan.__name__, plan.__doc__
    return run
