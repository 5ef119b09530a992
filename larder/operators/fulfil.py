"""Allocation of stock to demand, bans by trailing counts, and daily cutoffs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from larder.operators.prefix import attach, exclusive_totals

#: Units of a group's cumulative axis in which supply meets demand at a time, and ids of a coarse bucket (a power of two).
STRETCH, ID_BITS = 256, 22
#: Rows of a group, both sides together, up to which one task takes it whole.
GROUP_ROWS = 1 << 16


def _intervals(df: DataFrame, keys: Sequence[str], first: str, id_: str, quantity: str) -> DataFrame:
    """Rows with the stretch [_from, _to) of their group's units that they cover, in order of (``first``, ``id_``)."""
    levels = {"_month": F.date_trunc("month", first), "_day": F.col(first), "_ids": F.shiftright(id_, ID_BITS), "_id": F.col(id_)}
    leveled = df.filter(F.col(quantity) > 0).select("*", *(c.alias(n) for n, c in levels.items()))
    before = exclusive_totals(leveled, keys, list(levels), quantity, "_from").drop(*levels)
    return before.withColumn("_to", F.col("_from") + F.col(quantity)).withColumn(
        "_stretch", F.explode(F.sequence(F.floor(F.col("_from") / STRETCH), F.floor((F.col("_to") - 1) / STRETCH)))
    )


def first_expired_first_out(
    supply: DataFrame,
    demand: DataFrame,
    keys: Sequence[str],
    batch: str = "batch_id",
    expiry: str = "expiry_date",
    request: str = "request_id",
    day: str = "day",
    quantity: str = "quantity",
    group_rows: int = GROUP_ROWS,
) -> DataFrame:
    """(keys, batch, request, quantity): units of batches given to requests, earliest expiry to earliest request.

    Batches of a group are laid end to end in order of (expiry, batch), requests in order of (day, request); ids
    are unique whole numbers, days are dates, quantities whole numbers above zero (others take no part). Where a batch and
    a request cover the same units, these units go from one to the other; what exceeds the other side stays.

    Groups of up to ``GROUP_ROWS`` rows are shuffled once and swept by windows. In larger ones (at most one for so many rows)
    both orders are prefix sums level by level, and the stretches are cut into pieces of bounded length in which few batches
    and requests can meet, so a group of any size is spread over tasks and no batch meets all requests.
    """
    named = [(F.lit(0), batch, expiry, supply), (F.lit(1), request, day, demand)]
    sides = [
        df.select(*keys, side.alias("_side"), F.col(id_).alias("_id"), F.col(first).alias("_first"), F.col(quantity).alias("_quantity"))
        .filter("_quantity > 0")
        .dropna(subset=list(keys))
        for side, id_, first, df in named
    ]
    rows = sides[0].unionByName(sides[1])
    large = F.broadcast(rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows")).filter(F.col("_rows") > group_rows).select(*keys))
    small = _swept(rows.join(large, list(keys), "left_anti").repartition(*keys), keys, batch, request)
    spread = _met(supply.join(large, list(keys), "left_semi"), demand.join(large, list(keys), "left_semi"), keys, batch, expiry, request, day, quantity)
    return small.unionByName(spread).withColumnRenamed("_units", quantity)


def _swept(rows: DataFrame, keys: Sequence[str], batch: str, request: str) -> DataFrame:
    """(keys, batch, request, _units) of rows that lie together by ``keys``: what begins last on each side covers the units up to
    where the next row of either side begins, as far as it reaches."""
    earlier = Window.partitionBy(*keys, "_side").orderBy("_first", "_id").rowsBetween(Window.unboundedPreceding, -1)
    begun = rows.withColumn("_from", F.coalesce(F.sum("_quantity").over(earlier), F.lit(0)))
    along = Window.partitionBy(*keys).orderBy("_from", "_side")
    entry = F.struct(F.col("_id").alias("id"), (F.col("_from") + F.col("_quantity")).alias("end"))
    last = [F.last(F.when(F.col("_side") == side, entry), ignorenulls=True).over(along.rowsBetween(Window.unboundedPreceding, 0)) for side in (0, 1)]
    held = begun.select(*keys, "_from", F.lead("_from").over(along).alias("_next"), last[0].alias("_batch"), last[1].alias("_request"))
    units = F.least("_next", "_batch.end", "_request.end") - F.col("_from")
    return (
        held.filter(F.col("_batch").isNotNull() & F.col("_request").isNotNull())
        .select(*keys, F.col("_batch.id").alias(batch), F.col("_request.id").alias(request), units.alias("_units"))
        .filter("_units > 0")
        .groupBy(*keys, batch, request)
        .agg(F.sum("_units").cast("bigint").alias("_units"))
    )


def _met(
    supply: DataFrame, demand: DataFrame, keys: Sequence[str], batch: str, expiry: str, request: str, day: str, quantity: str
) -> DataFrame:
    """(keys, batch, request, _units) by stretches that batches and requests share."""
    left = _intervals(supply.select(*keys, batch, expiry, quantity), keys, expiry, batch, quantity)
    right = _intervals(demand.select(*keys, request, day, quantity), keys, day, request, quantity)
    right = right.select(*keys, request, "_stretch", F.col("_from").alias("_since"), F.col("_to").alias("_until"))
    start = F.greatest("_from", "_since", F.col("_stretch") * STRETCH)
    end = F.least("_to", "_until", (F.col("_stretch") + 1) * STRETCH)
    met = left.join(right, [*keys, "_stretch"]).withColumn("_units", end - start).filter("_units > 0")
    return met.groupBy(*keys, batch, request).agg(F.sum("_units").cast("bigint").alias("_units"))


def banned_since(events: DataFrame, key: str, day: Column, times: int = 2, days: int = 30) -> DataFrame:
    """(key, banned_since, within_days): the first day on which a key has ``times`` events in the trailing ``days`` days.

    Events are merged per key and day on the map side, so what a window holds of one key is bounded by the calendar.
    """
    daily = events.filter(F.col(key).isNotNull()).groupBy(key, day.alias("_day")).agg(F.count(F.lit(1)).alias("_events"))
    number = F.datediff("_day", F.lit("1970-01-01").cast("date"))
    trailing = Window.partitionBy(key).orderBy("_number").rangeBetween(-(days - 1), 0)
    counted = daily.filter(F.col("_day").isNotNull()).withColumn("_number", number)
    return (
        counted.withColumn("_within", F.sum("_events").over(trailing))
        .filter(F.col("_within") >= times)
        .groupBy(key)
        .agg(F.min(F.struct("_day", "_within")).alias("_first"))
        .select(key, F.col("_first._day").alias("banned_since"), F.col("_first._within").alias("within_days"))
    )


def daily_cutoff(
    orders: DataFrame, limits: DataFrame, store: str, moment: str, order: str, limit: str = "limit"
) -> DataFrame:
    """(store, day, orders, last_order, last_at): per store and day the order with which the store's limit is reached.

    Days that do not reach the limit are not there. ``limits`` has one row per store. Orders are counted per minute, the minute in
    which a day crosses its limit follows from these counts, and only that minute's orders are ranked.
    """
    timed = orders.select(
        store, F.col(order).alias("_order"), F.col(moment).alias("_at"), F.col(moment).cast("date").alias("day")
    ).withColumn("_minute", F.date_trunc("minute", "_at"))
    minutes = timed.groupBy(store, "day", "_minute").agg(F.count(F.lit(1)).alias("_n"))
    of_day = Window.partitionBy(store, "day")
    upto = F.sum("_n").over(of_day.orderBy("_minute"))
    counted = minutes.withColumns({"_upto": upto, "orders": F.sum("_n").over(of_day)})
    crossing = (
        attach(counted, limits, [store], limit)
        .filter((F.col("_upto") >= F.col(limit)) & (F.col("_upto") - F.col("_n") < F.col(limit)))
        .select(store, "day", "_minute", "orders", (F.col(limit) - F.col("_upto") + F.col("_n")).alias("_nth"))
    )
    nth = F.row_number().over(Window.partitionBy(store, "day", "_minute").orderBy("_at", "_order"))
    return (
        timed.join(crossing, [store, "day", "_minute"])
        .withColumn("_place", nth)
        .filter(F.col("_place") == F.col("_nth"))
        .select(store, "day", "orders", F.col("_order").alias("last_order"), F.col("_at").alias("last_at"))
    )
