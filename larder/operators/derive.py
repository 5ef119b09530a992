"""Derivations that look at more than one row, or change the row set."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from larder.functions.catalogue import PERISHABLE_STORAGE
from larder.functions.money import cents
from larder.operators.prefix import attach, exclusive_totals, id_levels, ordered_rank
from larder.operators.ranking import MAP_SIDE_RANK, top_rows

HASH_BITS = 52
# An order up to this many lines is left to one task's window.
GROUP_ROWS = 1_000_000
# Draws of a weighted sample per unit of its histogram, and cells that one coarse cell holds.
DRAW_CELLS, COARSE_CELLS = 65536, 1024


# --- discount allocation ---------------------------------------------------------------


def _proportional(amount: Column, part: Column, whole: Column) -> Column:
    quotient = (amount.cast("decimal(18,2)") * part.cast("decimal(14,2)")).cast("decimal(24,4)") / F.nullif(
        whole.cast("decimal(18,2)"), F.lit(0).cast("decimal(18,2)")
    )
    return F.bround(quotient, 2).cast("decimal(14,2)")


def _hand_out(missing: Column, lines: Column, position: Column) -> Column:
    """Whole cents of one line when ``missing`` cents go round the lines in order of position."""
    each = F.floor(F.abs(missing) / lines)
    rest = F.abs(missing) - each * lines
    return F.signum(missing.cast("double")).cast("bigint") * (each + F.when(position <= rest, 1).otherwise(0))


def _settle(rows: DataFrame, subtotal: str, keep: list[str]) -> DataFrame:
    """Final price and discount per line from the rounded share and the cents still missing."""
    missing = cents(F.col("_target") - (F.col("_gross") - F.col("_shared")))
    extra = (_hand_out(missing, F.col("_lines"), F.col("_position")).cast("decimal(14,0)") / 100).cast("decimal(14,2)")
    final = (F.col(subtotal) - F.col("_share") + extra).cast("decimal(14,2)")
    return rows.select(
        *keep, (F.col(subtotal) - final).cast("decimal(14,2)").alias("item_discount"), final.alias("final_item_price")
    )


def allocate_discount(
    lines: DataFrame,
    targets: DataFrame,
    order: str,
    item: str,
    subtotal: str,
    target: str,
    ties: Sequence[str] = (),
    group_rows: int = GROUP_ROWS,
) -> DataFrame:
    """Spread each order's discount over its lines so that the lines add up to ``target`` exactly.

    A line's share is proportional to its subtotal and rounded to cents; the
    cents still missing go to the lines in descending order of (subtotal, item,
    ties), one each, round after round. Lines equal in all of these get the same shares in any order.

    Both routes are always in the plan. An order's lines are handled by windows over the order, which need a
    single shuffle; orders with more than ``group_rows`` lines, if the data has any, are told apart by their
    count and ranked through buckets that hold no order in one task. Copies of one line
    are one cell there, with their number, so ``ties`` should tell the lines of an order apart (a line number).
    """
    keep = lines.columns
    goal = targets.select(order, F.col(target).alias("_target"))
    # at most rows / group_rows keys
    large = lines.groupBy(order).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > group_rows).select(order)

    whole = Window.partitionBy(order)
    ranked = whole.orderBy(*[F.col(c).desc() for c in (subtotal, item, *ties)])
    shared = (
        lines.join(large, order, "left_anti")
        .join(goal, order)
        # ranked first: the sort by order and subtotal then serves all windows
        .withColumn("_position", F.row_number().over(ranked))
        .withColumn("_gross", F.sum(subtotal).over(whole))
        .withColumn("_lines", F.count(F.lit(1)).over(whole))
        .withColumn("_share", _proportional(F.col("_gross") - F.col("_target"), F.col(subtotal), F.col("_gross")))
        .withColumn("_shared", F.sum("_share").over(whole))
    )

    many = lines.join(large, order, "left_semi")
    totals = many.groupBy(order).agg(F.sum(subtotal).alias("_gross"), F.count(F.lit(1)).alias("_lines"))
    shares = totals.join(goal, order)
    share = _proportional(F.col("_gross") - F.col("_target"), F.col(subtotal), F.col("_gross"))
    # equal lines are one cell; the cells of an order are in one order by (subtotal, item, ties)
    cell = list(dict.fromkeys([order, subtotal, item, *ties]))
    cells = many.groupBy(*cell).agg(F.count(F.lit(1)).alias("_copies")).join(shares, order).withColumn("_share", share)
    spread = cells.groupBy(order).agg(F.sum(F.col("_share") * F.col("_copies")).alias("_shared"))
    whole_cents = cents(F.col(subtotal))
    levels = [F.shiftright(whole_cents, 20), whole_cents, *id_levels(lines, item), F.col(item), *map(F.col, ties)]
    names = [f"_level{i}" for i in range(len(levels))]
    leveled = cells.select("*", *[c.alias(n) for n, c in zip(names, levels)])
    before = exclusive_totals(leveled, [order], names, "_copies", "_before", descending=True).drop(*names)
    placed = before.join(spread, order)
    # a copy's place among its equals: any order gives the same rows
    copy = Window.partitionBy(*cell).orderBy(F.lit(1))
    return _settle(shared, subtotal, keep).unionByName(
        _settle(
            many.withColumn("_copy", F.row_number().over(copy))
            .join(placed.drop("_copies"), cell)
            .withColumn("_position", F.col("_before") + F.col("_copy")),
            subtotal,
            keep,
        )
    )


# --- joins and filters -----------------------------------------------------------------


def returnable_lines(lines: DataFrame, orders: DataFrame) -> DataFrame:
    """Lines of delivered orders, with the order's timestamp."""
    delivered = orders.filter(F.col("order_status") == "Delivered").select("order_id", "order_timestamp")
    return lines.join(delivered, "order_id")


def cold_chain_eligible(pairs: DataFrame, stores: DataFrame, products: DataFrame) -> DataFrame:
    """(store, product) pairs a store may hold: cooled goods only where there is cooling."""
    cooling = stores.select("store_id", "temperature_control")
    storage = products.select("product_id", "storage_type")
    needs = F.coalesce(F.col("storage_type").isin(PERISHABLE_STORAGE), F.lit(False))
    has = F.coalesce(F.col("temperature_control"), F.lit(False))
    return pairs.join(storage, "product_id").join(cooling, "store_id").filter(has | ~needs)


# --- catalogue -------------------------------------------------------------------------


def flatten_catalogue(documents: DataFrame) -> DataFrame:
    """One row per brand, item, type, variant, flavour and size of a nested catalogue.

    An empty or missing list of types, variants or flavours yields one null;
    without brands, items or sizes there is no product.
    """
    return (
        documents.select(F.explode("categories").alias("c"))
        .select(F.col("c.category_name").alias("category"), F.explode("c.sub_categories").alias("s"))
        .select(
            "category",
            F.col("s.sub_category_name").alias("sub_category"),
            F.col("s.storage_type").alias("storage_type"),
            F.col("s.gst_percentage").alias("gst_percentage"),
            F.col("s.base_shelf_life_days").alias("shelf_life_days"),
            F.col("s.items").alias("_items"),
            F.explode("s.brands").alias("_brand"),
        )
        .select("*", F.explode("_items").alias("_item"))
        .select("*", F.explode_outer("_item.types").alias("type"))
        .select("*", F.explode_outer("_item.variants").alias("variant"))
        .select("*", F.explode_outer("_item.flavours").alias("flavour"))
        .select("*", F.explode("_item.sizes").alias("_size"))
        .select(
            "category",
            "sub_category",
            F.col("_brand.name").alias("brand"),
            F.col("_brand.tier").alias("brand_tier"),
            F.col("_item.item_name").alias("item"),
            "type",
            "variant",
            "flavour",
            F.col("_size.unit").alias("unit"),
            F.col("_size.value").alias("size"),
            F.col("_size.price_range.min").alias("price_min"),
            F.col("_size.price_range.max").alias("price_max"),
            "storage_type",
            "gst_percentage",
            "shelf_life_days",
        )
    )


def first_of_each(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The first row of every key combination (nulls equal) in the stated order."""
    return top_rows(df, keys, order, 1, "_first").drop("_first")


def with_unique_sku(df: DataFrame, base: str, key: str, out: str = "sku") -> DataFrame:
    """Number repeated base SKUs: the first, by the unique ``key``, keeps it, later ones get -1, -2, ..."""
    ranked = ordered_rank(df, [base], id_levels(df, key), [F.col(key)], "_nth")
    numbered = F.concat_ws("-", F.col(base), (F.col("_nth") - 1).cast("string"))
    return ranked.withColumn(out, F.when(F.col("_nth") == 1, F.col(base)).otherwise(numbered)).drop("_nth")


# --- samples ---------------------------------------------------------------------------


def hashed(key: Column, seed: int) -> Column:
    """A pseudo-random whole number below 2^52, the same for a key on every engine that has md5."""
    digest = F.md5(F.concat_ws(":", F.lit(str(seed)), key.cast("string")).cast("binary"))
    return F.conv(F.substring(digest, 1, HASH_BITS // 4), 16, 10).cast("bigint")


def quota_sample(
    df: DataFrame, stratum: str, key: str, total: int, weights: Mapping[str, float], default: float = 0.05, seed: int = 42
) -> DataFrame:
    """A random sample of floor(total * weight) rows per stratum, or all rows of a smaller one; ``key`` is unique."""
    sizes = {name: int(total * weight) for name, weight in weights.items()}
    quota = F.lit(int(total * default))
    for name, size in sizes.items():
        quota = F.when(F.col(stratum) == name, size).otherwise(quota)
    largest = max([int(total * default), *sizes.values()])
    drawn = df.withColumn("_draw", hashed(F.col(key), seed))
    order = [F.col("_draw"), F.col(key)]
    if largest <= MAP_SIDE_RANK:
        ranked = top_rows(drawn, [stratum], order, max(largest, 1), "_nth")
    else:
        ranked = ordered_rank(drawn, [stratum], [F.shiftright("_draw", HASH_BITS - 22)], order, "_nth")
    return ranked.filter(F.col("_nth") <= quota).drop("_draw", "_nth")


def weighted_sample(
    df: DataFrame, group: str, key: str, weight: Column, share: Column, seed: int = 42
) -> DataFrame:
    """Weighted sample without replacement of floor(share * rows) rows per group.

    Each row draws -ln(u) / weight and the smallest draws win, which equals
    picking rows one by one with probability proportional to weight. ``key`` is
    unique within a group, and ``share`` the same for all its rows. Rows whose
    weight is zero, negative or missing count for the size of the sample and are never drawn. Only rows of the one
    cell of the draws' histogram in which a group's cut falls are ranked; smaller draws are kept as they are.
    """
    uniform = (hashed(F.concat_ws(":", F.col(group), F.col(key)), seed) + F.lit(0.5)) / F.lit(float(2**HASH_BITS))
    drawn = (
        df.withColumns({"_weight": weight.cast("double"), "_share": share})
        .filter("_weight > 0")
        .withColumn("_draw", -F.ln(uniform) / F.col("_weight"))
    )
    # the cut of each group: the cell of the histogram of draws in which the last row of the sample lies
    cells = (
        drawn.withColumn("_cell", F.floor(F.col("_draw") * DRAW_CELLS).cast("bigint"))
        .groupBy(group, "_cell")
        .agg(F.count(F.lit(1)).alias("_count"))
        .select("*", F.floor(F.col("_cell") / COARSE_CELLS).alias("_coarse"))
    )
    placed = exclusive_totals(cells, [group], ["_coarse", "_cell"], "_count", "_before")
    # rows of any weight count for the size
    sizes = df.groupBy(group).agg(F.floor(F.count(F.lit(1)) * F.max(share)).cast("bigint").alias("_size"))
    crossed = (F.col("_before") < F.col("_size")) & (F.col("_before") + F.col("_count") >= F.col("_size"))
    cuts = (
        attach(placed, sizes, [group], "_size")
        .groupBy(group)
        .agg(
            F.max("_size").alias("_size"),
            F.max(F.when(crossed, F.struct("_cell", (F.col("_size") - F.col("_before")).alias("_left")))).alias("_cut"),
        )
        # a sample larger than what can be drawn takes all of it
        .select(group, F.when(F.col("_size") > 0, F.coalesce("_cut._cell", F.lit(2**62))).otherwise(-1).alias("_last"), "_cut._left")
    )
    ends = cuts.select(group, F.struct("_last", "_left").alias("_end"))
    cut = attach(drawn, ends, [group], "_end").select(
        "*", "_end._last", "_end._left", F.floor(F.col("_draw") * DRAW_CELLS).cast("bigint").alias("_cell")
    )
    within = F.row_number().over(Window.partitionBy(group).orderBy("_draw", key))
    border = cut.filter(F.col("_cell") == F.col("_last")).withColumn("_nth", within).filter(F.col("_nth") <= F.col("_left"))
    return cut.filter(F.col("_cell") < F.col("_last")).select(*df.columns).union(border.select(*df.columns))
