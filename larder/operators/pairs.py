"""Most frequent item pairs across baskets."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BLOCK_ITEMS = 500
#: Tasks among which the cells are dealt before they become pairs. Adaptive execution sizes tasks by the bytes that they read,
#: but a task's table of pairs is many times as large.
TASKS = 256
# A cell of a basket's grid as one number: row part, then column part.
PART_BITS = 20


def _cells(lines: DataFrame, basket: str, item: str, block_items: int, tasks: int) -> DataFrame:
    """(basket, item, copies, part, cell): the items of each basket in the cells of its grid.

    A basket of up to ``block_items`` lines is one cell. The items of a wider one are cut by hash into parts of about
    ``block_items``; the cell (p, q) with p <= q holds the parts p and q.
    """
    # at most rows / block_items baskets
    parts = F.ceil(F.count(F.lit(1)) / block_items).cast("int")
    wide = lines.groupBy(basket).agg(parts.alias("parts")).filter("parts > 1")
    # the join may take the session's number of tasks, but adaptive execution does not merge them again
    merged = lines.repartition(tasks, basket).join(wide, basket, "left").groupBy(basket, item).agg(
        F.count(F.lit(1)).alias("copies"), F.coalesce(F.max("parts"), F.lit(1)).alias("parts")
    )
    placed = merged.withColumn("part", F.pmod(F.xxhash64(item), "parts").cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.col("parts") - 1))
    met = placed.select(basket, item, "copies", "part", other.alias("other"))
    cell = F.shiftleft(F.least("part", "other").cast("bigint"), PART_BITS) + F.greatest("part", "other")
    return met.select(basket, item, "copies", "part", cell.alias("cell"))


def frequent_pairs(
    lines: DataFrame,
    basket: str,
    item: str,
    k: int,
    block_items: int = BLOCK_ITEMS,
    tasks: int = TASKS,
    **_earlier_parameters: int,
) -> DataFrame:
    """(item_a, item_b, times) of the ``k`` pairs found most often; of equal counts the smaller items come first.

    ``times`` counts line pairs of one basket, so repeated lines multiply: they are merged first, and their counts
    multiply instead.

    The items of a cell are one array of at most about twice ``block_items``, in which each meets those behind it; a pair of two
    parts meets in their cell alone. So a basket of any width is spread over tasks, and an ordinary one is a
    single array: no join of baskets with themselves. Pairs are added up on the map side before they move.

    Cells are dealt evenly among ``tasks`` tasks, whose tables of pairs hold so much less each.
    """
    entry = F.struct(F.col(item).alias("item"), "copies", "part")
    cells = (
        _cells(lines, basket, item, block_items, tasks)
        .groupBy(basket, "cell")
        .agg(F.sort_array(F.collect_list(entry)).alias("items"))
        .filter(F.size("items") > 1)
    )
    one = cells.repartition(tasks, basket, "cell").select("cell", "items", F.posexplode("items").alias("at", "a"))
    two = one.select("cell", "a", F.explode(F.expr("slice(items, at + 2, size(items))")).alias("b"))
    # both of one part meet in that part's own cell, not in those it shares
    row, column = F.shiftright("cell", PART_BITS), F.col("cell").bitwiseAND((1 << PART_BITS) - 1)
    pairs = two.filter((row == column) | (F.col("a.part") != F.col("b.part")))
    counted = pairs.groupBy(F.col("a.item").alias("item_a"), F.col("b.item").alias("item_b")).agg(
        F.sum(F.col("a.copies") * F.col("b.copies")).alias("times")
    )
    return counted.orderBy(F.desc("times"), "item_a", "item_b").limit(k)
