"""Product and category revenue, baskets and product pairs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larder.functions.money import cents, mean, percent, ratio
from larder.operators.pairs import frequent_pairs
from larder.operators.prefix import running_total
from larder.operators.ranking import top_rows
from larder.sources.retail import RetailTables


def _all_sales(t: RetailTables) -> DataFrame:
    """Units and revenue per product id of the lines, lines without product being one group."""
    return t.order_details.groupBy("product_id").agg(
        F.sum("quantity").alias("quantity_sold"), F.sum("final_item_price").alias("revenue")
    )


def _sales(t: RetailTables) -> DataFrame:
    """Units and revenue per sold product id, before any product attribute is known.

    Lines without product are left out here, as the joins to products would do:
    with the same filter on every use, Spark scans and shuffles the lines once.
    """
    return t.order_details.filter(F.col("product_id").isNotNull()).groupBy("product_id").agg(
        F.sum("quantity").alias("quantity_sold"), F.sum("final_item_price").alias("revenue")
    )


def product_revenue(t: RetailTables, *attributes: str) -> DataFrame:
    return _sales(t).join(t.products.select("product_id", *attributes), "product_id")


def top_products(t: RetailTables, k: int = 10) -> DataFrame:
    return (
        product_revenue(t, "product_name")
        .orderBy(F.desc_nulls_first("quantity_sold"), "product_name", "product_id")
        .limit(k)
        .select("product_name", "quantity_sold")
    )


def above_average(t: RetailTables) -> DataFrame:
    """Products above the mean revenue of all product groups, that of lines without product included."""
    sales = _all_sales(t).select("product_id", F.col("revenue").alias("product_revenue"))
    average = sales.agg(mean(F.col("product_revenue"))).scalar()
    known = t.products.filter(F.col("product_id").isNotNull())
    # a struct is never null: no null filter is derived for the sales, so the mean and the join share one aggregate
    key = F.struct("product_id").alias("_key")
    return (
        sales.filter(F.col("product_revenue") > average)
        .select("product_revenue", key)
        .join(known.select("product_id", "product_name", "category", key), "_key")
        .select("product_id", "product_name", "category", "product_revenue")
        .orderBy(F.desc("product_revenue"), "product_id")
    )


def best_in_category(t: RetailTables) -> DataFrame:
    sold = product_revenue(t, "product_name", "category").withColumnRenamed("product_name", "product")
    order = [F.col("revenue").desc_nulls_first(), F.col("product"), F.col("product_id")]
    return top_rows(sold, ["category"], order, 1).select("category", "product", "revenue")


def pareto(t: RetailTables, pct: float = 80) -> DataFrame:
    """Products within the first ``pct`` percent of revenue, best sellers first.

    The running sum goes bucket by bucket of the revenue, so no task holds all products.
    """
    sold = product_revenue(t, "product_name").select("product_id", "product_name", "revenue").filter(F.col("revenue").isNotNull())
    total = sold.agg(F.sum("revenue")).scalar()
    share_limit = F.lit(str(pct)).cast("decimal(9,4)")
    return (
        running_total(sold, -cents(F.col("revenue")), "revenue", "running_revenue")
        .withColumn("_total", total)
        .filter(F.col("running_revenue") * 100 <= F.col("_total") * share_limit)
        .orderBy(F.desc("revenue"), "product_id")
        .select(
            "product_name",
            "revenue",
            "running_revenue",
            percent(F.col("running_revenue"), F.col("_total")).alias("cumulative_percentage"),
        )
    )


def penetration(t: RetailTables) -> DataFrame:
    """Share of all orders that contain each product.

    The distinct count de-duplicates on (product, order) first, which spreads a
    product found in most orders over all tasks.
    """
    orders = t.orders.agg(F.count(F.lit(1))).scalar()
    return (
        t.order_details.groupBy("product_id")
        .agg(F.countDistinct("order_id").alias("orders_containing_poduct"))
        .join(t.products.select("product_id", "product_name"), "product_id")
        .withColumn("total_orders", orders)
        .withColumn("penetration_percentage", percent(F.col("orders_containing_poduct"), F.col("total_orders")))
        .select("product_id", "product_name", "orders_containing_poduct", "total_orders", "penetration_percentage")
        .orderBy(F.desc("penetration_percentage"), "product_id")
    )


def category_share(t: RetailTables) -> DataFrame:
    by_category = (
        product_revenue(t, "category").groupBy("category").agg(F.sum("revenue").alias("category_revenue"))
    )
    total = by_category.agg(F.sum("category_revenue")).scalar()
    return (
        by_category.withColumn("total_revenue", total)
        .withColumn("revenue_contribution_percentage", percent(F.col("category_revenue"), F.col("total_revenue")))
        .orderBy(F.desc("revenue_contribution_percentage"), "category")
    )


def discount_bands(t: RetailTables, low: float = 10, high: float = 20) -> DataFrame:
    bands = ["No/Low Discount", "Medium Discount", "High Discount"]
    discount = F.col("item_discount")
    band = F.when(discount <= low, bands[0]).when(discount <= high, bands[1]).otherwise(bands[2])
    return (
        t.order_details.groupBy(band.alias("discount_band"))
        .agg(
            F.count(F.lit(1)).alias("total_line_items"),
            F.sum("quantity").alias("total_units_sold"),
            mean(F.col("quantity"), 2).alias("avg_quantity_per_item"),
            F.sum("final_item_price").alias("total_revenue"),
        )
        .orderBy(F.array_position(F.array(*map(F.lit, bands)), F.col("discount_band")))
    )


def underperformers(t: RetailTables) -> DataFrame:
    """Products that earn less than the mean of their category.

    The category mean is an aggregate joined back, not a window, so a category
    with very many products is not sorted in one task.
    """
    sold = product_revenue(t, "category", "product_name").select(
        "category", "product_id", "product_name", F.col("revenue").alias("product_revenue")
    )
    means = sold.groupBy("category").agg(mean(F.col("product_revenue")).alias("_mean"))
    revenue, average = F.col("product_revenue"), F.col("_mean")
    return (
        sold.join(means, "category")
        .filter(revenue < average)
        .orderBy("category", revenue, "product_id")
        .select(
            "category",
            "product_id",
            "product_name",
            F.round(revenue, 2).alias("product_revenue"),
            F.round(average, 2).alias("category_avg_revenue"),
            F.round(revenue - average, 2).alias("difference_from_average"),
        )
    )


def _known_lines(t: RetailTables) -> DataFrame:
    """(order_id, product_id) of the lines whose product exists."""
    lines = t.order_details.select("order_id", "product_id").filter(
        F.col("order_id").isNotNull() & F.col("product_id").isNotNull()
    )
    known = t.products.select("product_id")
    return lines.join(known, "product_id", "left_semi").select("order_id", "product_id")


def product_pairs(t: RetailTables, k: int = 10) -> DataFrame:
    """The pairs found most often in one order; ranked by id before the names are joined."""
    names = t.products.select("product_id", "product_name")
    first = names.select(F.col("product_id").alias("item_a"), F.col("product_name").alias("product_1"))
    second = names.select(F.col("product_id").alias("item_b"), F.col("product_name").alias("product_2"))
    top = (
        frequent_pairs(_known_lines(t), "order_id", "product_id", k)
        .orderBy(F.desc("times"), "item_a", "item_b")
        .limit(k)
    )
    return (
        top.join(first, "item_a")
        .join(second, "item_b")
        .orderBy(F.desc("times"), "item_a", "item_b")
        .select("product_1", "product_2", F.col("times").alias("times_bought_together"))
    )


def basket_sizes(t: RetailTables, small: int = 3, medium: int = 6) -> DataFrame:
    bands = ["Small Basket", "Medium Basket", "Large Basket"]
    baskets = (
        t.order_details.groupBy("order_id")
        .agg(F.count("product_id").alias("products"), F.sum("final_item_price").alias("amount"))
        .join(t.orders.select("order_id"), "order_id", "left_semi")
    )
    size = F.col("products")
    band = (
        F.when(size.between(1, small), bands[0]).when(size.between(small + 1, medium), bands[1]).otherwise(bands[2])
    )
    return (
        baskets.groupBy(band.alias("basket_type"))
        .agg(
            F.count("order_id").alias("total_orders"),
            mean(F.col("products"), 2).alias("avg_products_per_order"),
            mean(F.col("amount"), 2).alias("avg_order_value"),
        )
        .orderBy(F.array_position(F.array(*map(F.lit, bands)), F.col("basket_type")))
    )


def average_basket(t: RetailTables) -> DataFrame:
    baskets = t.order_details.groupBy("order_id").agg(F.sum("quantity").alias("units"))
    return baskets.agg(ratio(F.sum("units"), F.count("units")).alias("average_basketsize"))
