"""Derivations on the test tables; random inputs of a real business are ordinary columns here."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larder.functions import catalogue as cat
from larder.functions import loyalty, ordering, stocking
from larder.functions.money import money
from larder.operators import derive, fulfil
from larder.operators.prefix import sequence_number
from larder.registered.binding import Query, bind
from larder.registered.quality import stored_products, typed_stores
from larder.sources import files, schemas
from larder.sources.testdata import TestTables

VELOCITIES = {"SMALL": "Fast", "MEDIUM": "Medium", "LARGE": "Slow", "PROMO": "Fast"}
STOCKS = {"SMALL": 120, "MEDIUM": 61, "LARGE": 47, "STANDARD": 99}
QUOTA_WEIGHTS = {"SMALL": 0.08, "MEDIUM": 0.15, "LARGE": 0.18}


def pick(index, *values):
    return F.element_at(F.array(*[F.lit(v) for v in values]), (index + 1).cast("int"))


def trips(t: TestTables) -> DataFrame:
    """Deliveries made of events: every input of the order derivations as a column."""
    key = F.col("event_id")
    return t.raw("events").select(
        "event_id",
        "ts",
        ((50 + key * 7 % 751).cast("decimal(14,0)") / 100).cast("decimal(4,2)").alias("km"),
        pick(key % 4, "Clear", "Cloudy", "Rain", "Heavy Rain").alias("weather"),
        ordering.peak_hour(F.col("ts")).alias("peak_hour"),
        ordering.yes_no(key % 12 == 0).alias("festival"),
        money(F.col("value")).alias("basket"),
        (key % 97).cast("decimal(14,2)").alias("coupon"),
        F.when(key % 20 < 15, "Delivered").when(key % 20 < 18, "Cancelled").otherwise("Failed").alias("status"),
        pick(key % 5, "UPI", "Credit Card", "Debit Card", "Cash on Delivery", "Wallet").alias("method"),
        (key % 5 + 1).cast("int").alias("base_rating"),
        (8 + key % 38).cast("int").alias("actual"),
    )


def delivery_slots(t: TestTables) -> DataFrame:
    return trips(t).select("event_id", ordering.delivery_slot(F.col("ts")).alias("delivery_slot"))


def peak_flags(t: TestTables) -> DataFrame:
    return trips(t).select("event_id", "peak_hour")


def _estimated():
    return ordering.estimated_minutes(F.col("km"), F.col("weather"), F.col("peak_hour"), F.col("festival"))


def _fee():
    return ordering.delivery_fee(F.col("km"), F.col("weather"), F.col("peak_hour"))


def delivery_minutes(t: TestTables) -> DataFrame:
    return trips(t).select("event_id", "km", "weather", _estimated().alias("estimated_minutes"))


def delivery_fees(t: TestTables) -> DataFrame:
    return trips(t).select("event_id", "km", "weather", _fee().alias("delivery_fee"))


def order_totals(t: TestTables) -> DataFrame:
    basket, coupon = F.col("festive"), F.col("applied")
    return (
        trips(t)
        .withColumn("fee", _fee())
        .withColumn("festive", ordering.festive_basket(F.col("basket"), F.col("festival")))
        .withColumn("applied", ordering.applied_coupon(basket, F.col("fee"), F.col("coupon")))
        .select(
            "event_id",
            F.bround(coupon, 2).alias("coupon_discount"),
            ordering.order_total(basket, F.col("fee"), coupon).alias("total_order_value"),
        )
    )


def payment_statuses(t: TestTables) -> DataFrame:
    status = ordering.payment_status(F.col("status"), F.col("method"))
    return trips(t).select("event_id", "status", "method", status.alias("payment_status"))


def ratings(t: TestTables) -> DataFrame:
    rating = ordering.adjusted_rating(
        F.col("base_rating"), F.col("status"), F.col("weather"), _estimated(), F.col("actual")
    )
    return trips(t).select("event_id", "status", rating.alias("customer_delivery_rating"))


def discount_allocation(t: TestTables) -> DataFrame:
    """Nine tenths of every order's gross value, spread over its lines."""
    lines = t.order_details.select("order_id", "product_id", "line_number", "gross")
    target = F.round(F.sum("gross") * F.lit("0.9").cast("decimal(2,1)"), 2).cast("decimal(18,2)")
    targets = lines.groupBy("order_id").agg(target.alias("target"))
    return derive.allocate_discount(lines, targets, "order_id", "product_id", "gross", "target", ["line_number"])


def returnable(t: TestTables) -> DataFrame:
    columns = ["order_id", "product_id", "line_number", "order_timestamp"]
    return derive.returnable_lines(t.order_details, t.orders).select(*columns)


def refunds(t: TestTables) -> DataFrame:
    status = pick(F.col("product_id") % 3, "Approved", "Rejected", "Pending")
    return (
        derive.returnable_lines(t.order_details, t.orders)
        .withColumn("return_status", status)
        .select(
            "order_id",
            "product_id",
            "return_status",
            ordering.refund_amount(F.col("final_item_price"), F.col("return_status")).alias("refund_amount"),
        )
    )


def return_dates(t: TestTables) -> DataFrame:
    moved = ordering.return_date(F.col("order_timestamp"), (F.col("product_id") % 4).cast("int"))
    return derive.returnable_lines(t.order_details, t.orders).select("order_id", "product_id", moved.alias("return_date"))


def reorder_levels(t: TestTables) -> DataFrame:
    category = F.col("category")
    return t.products.select(
        "product_id",
        "category",
        stocking.velocity(category, VELOCITIES).alias("velocity"),
        stocking.reorder_level(category, VELOCITIES, STOCKS).alias("reorder_level"),
    )


def stock_statuses(t: TestTables) -> DataFrame:
    status = stocking.stock_status(F.col("current_stock"), F.col("reorder_level"))
    return t.inventory.select("store_id", "product_id", "current_stock", status.alias("status"))


def batch_ids(t: TestTables) -> DataFrame:
    numbered = sequence_number(t.orders.select("order_id", "order_timestamp"), "order_id")
    batch = stocking.batch_id(F.col("order_timestamp"), F.col("sequence"))
    return numbered.select("order_id", "sequence", batch.alias("batch_id"))


def cold_chain(t: TestTables) -> DataFrame:
    pairs = t.inventory.select("store_id", "product_id", "last_restock_date")
    attributes = t.products.select("product_id", "category", F.col("size").alias("shelf_life_days"))
    perishable = cat.is_perishable(F.col("storage_type"), F.col("category"))
    remaining = (50 + F.col("product_id") % 46).cast("decimal(4,0)") / 100
    expiry = stocking.expiry_date(perishable, F.col("last_restock_date"), F.col("shelf_life_days"), remaining)
    return (
        derive.cold_chain_eligible(pairs, typed_stores(t), stored_products(t))
        .join(attributes, "product_id")
        .select("store_id", "product_id", "storage_type", expiry.alias("expiry_date"))
    )


def catalogue_documents(t: TestTables) -> DataFrame:
    """Nested catalogues made of the parts: one document per part, of bounded size whatever the table's."""
    words = F.split("product_name", " ")
    flavours = F.when(words[0] == "red", F.array(F.lit("plain"), F.lit("spiced"))).otherwise(F.array())

    def size(value):
        prices = F.struct(value.cast("decimal(14,2)").alias("min"), (value * 2).cast("decimal(14,2)").alias("max"))
        return F.struct(F.lit("pc").alias("unit"), value.cast("decimal(10,2)").alias("value"), prices.alias("price_range"))

    item = F.struct(
        words[1].alias("item_name"),
        F.array().cast("array<string>").alias("types"),
        F.array(words[0]).alias("variants"),
        flavours.cast("array<string>").alias("flavours"),
        F.array(size(F.col("size")), size(F.col("size") + 50)).alias("sizes"),
    )
    brands = F.array(*[F.struct(b.alias("name"), F.lit("Popular").alias("tier")) for b in (F.col("brand"), F.lit("House"))])
    section = F.struct(
        F.concat(F.lit("size "), F.col("size")).alias("sub_category_name"),
        F.lit("Ambient").alias("storage_type"),
        F.lit(5).alias("gst_percentage"),
        F.col("size").alias("base_shelf_life_days"),
        brands.alias("brands"),
        F.array(item).alias("items"),
    )
    return t.products.select(
        "product_id",
        F.array(F.struct(F.col("category").alias("category_name"), F.array(section).alias("sub_categories"))).alias("categories"),
    )


def parsed_catalogue(t: TestTables) -> DataFrame:
    """The same documents from JSON text; every 50th is cut off and yields nothing."""
    text = F.to_json(F.struct("categories"))
    broken = F.when(F.col("product_id") % 50 == 0, F.substring(text, 1, 60)).otherwise(text)
    documents = catalogue_documents(t).select(broken.alias("text"))
    return derive.flatten_catalogue(files.parse_catalogue(documents, "text"))


def parsed_orders(t: TestTables) -> DataFrame:
    """Orders from CSV records; every 40th has a word for its value and is kept as it came."""
    value = F.when(F.col("order_id") % 40 == 0, "unknown").otherwise(F.col("total_order_value").cast("string"))
    fields = {
        "order_id": F.col("order_id"),
        "customer_id": F.col("customer_id"),
        "store_id": F.concat(F.lit('"DS, '), F.col("store_id"), F.lit('"')),
        "rider_id": F.lit(""),
        "order_timestamp": F.date_format("order_timestamp", "yyyy-MM-dd'T'HH:mm:ss"),
        "payment_method": F.col("payment_method"),
        "order_status": F.col("order_status"),
        "total_order_value": value,
    }
    names = schemas.schema("orders").fieldNames()
    record = F.concat_ws(",", *[fields.get(n, F.lit("")).cast("string") for n in names])
    parsed = files.parse_csv(t.orders.select(F.col("order_id").alias("line"), record.alias("record")), "record", "orders")
    return parsed.select(
        "line",
        F.when(F.col(files.CORRUPT).isNull(), F.col("store_id")).alias("store_id"),
        F.when(F.col(files.CORRUPT).isNull(), F.col("order_timestamp")).alias("order_timestamp"),
        F.when(F.col(files.CORRUPT).isNull(), F.col("total_order_value")).alias("total_order_value"),
        F.col(files.CORRUPT).isNotNull().alias("corrupt"),
    )


def text_batch_ids(t: TestTables) -> DataFrame:
    """Sequence numbers of zero-padded text ids that share a prefix of twelve characters."""
    text = F.concat(F.lit("ORDER-BATCH-"), F.lpad(F.col("order_id").cast("string"), 10, "0"))
    return sequence_number(t.orders.select(text.alias("order_key")), "order_key")


def allocations(t: TestTables) -> DataFrame:
    """Shipped lines as batches, open ones as requests, allocated first expired first out."""
    line = F.col("l_orderkey") * 8 + F.col("l_linenumber")
    rows = t.raw("lineitem").select(
        F.col("l_suppkey").alias("store_id"),
        (F.col("l_partkey") % 20).alias("shelf"),
        line.cast("bigint").alias("line"),
        F.to_date("l_shipdate").alias("day"),
        F.col("l_quantity").cast("bigint").alias("quantity"),
        "l_linestatus",
    )
    # a line number can come twice in an order
    rows = rows.groupBy("store_id", "shelf", "line", "l_linestatus").agg(
        F.min("day").alias("day"), F.sum("quantity").alias("quantity")
    )
    supply = rows.filter("l_linestatus = 'F'").withColumnsRenamed({"line": "batch_id", "day": "expiry_date"})
    demand = rows.filter("l_linestatus = 'O'").withColumnsRenamed({"line": "request_id"})
    return fulfil.first_expired_first_out(supply, demand, ["store_id", "shelf"])


def bans(t: TestTables) -> DataFrame:
    """Customers with two cancelled orders in thirty days."""
    cancelled = t.orders.filter("order_status = 'Cancelled'")
    return fulfil.banned_since(cancelled, "customer_id", F.col("order_timestamp").cast("date"))


def cutoffs(t: TestTables) -> DataFrame:
    """Ten stores of events with capacities of their own: the event that reaches nine tenths of a day's capacity."""
    events = t.raw("events").select("event_id", "ts", (F.col("user_id") % 10).alias("store_id"))
    limits = events.sparkSession.range(10).select(
        F.col("id").alias("store_id"), F.ceil((F.lit(20) + F.col("id") * 3) * 9 / 10).cast("bigint").alias("limit")
    )
    return fulfil.daily_cutoff(events, limits, "store_id", "ts", "event_id")


def flat_catalogue(t: TestTables) -> DataFrame:
    return derive.flatten_catalogue(catalogue_documents(t))


def first_combinations(t: TestTables) -> DataFrame:
    keys = ["category", "brand", "product_name", "size"]
    return derive.first_of_each(t.products, keys, [F.col("product_id")]).select("product_id", *keys)


def skus(t: TestTables) -> DataFrame:
    variant = F.when(F.col("product_id") % 4 > 0, F.col("category"))
    base = cat.sku_base(F.col("brand"), F.col("product_name"), variant, F.col("size"))
    return derive.with_unique_sku(t.products.withColumn("base", base), "base", "product_id").select(
        "product_id", "base", "sku"
    )


def display_names(t: TestTables) -> DataFrame:
    words = F.split("product_name", " ")
    kind = F.when(F.col("product_id") % 3 == 0, F.col("product_name")).when(F.col("product_id") % 3 == 1, "Deluxe")
    name = cat.display_name(
        F.col("brand"), words[1], kind, F.when(F.col("product_id") % 5 > 0, words[0]), F.initcap(words[0]), F.col("size"), F.lit("g")
    )
    return t.products.select("product_id", name.alias("display_name"))


def price_ladder(t: TestTables) -> DataFrame:
    key = F.col("product_id")
    discount = (key % 350).cast("decimal(9,0)") / 10
    margin = (15 + key % 20).cast("decimal(9,0)") / 100
    return (
        t.products.select("product_id", cat.retail_price(F.col("mrp") * (key % 40 + 1) / 40).alias("retail"))
        .withColumn("selling", cat.selling_price(F.col("retail"), discount))
        .withColumn("discount_percentage", cat.effective_discount(F.col("retail"), discount))
        .withColumn("cost", cat.cost_price(F.col("selling"), margin))
    )


def product_flags(t: TestTables) -> DataFrame:
    key = F.col("product_id")
    name = F.when(key % 7 == 0, F.concat("product_name", F.lit(" Mango bar"))).otherwise(F.col("product_name"))
    text = F.when(key % 3 == 0, "  ").when(key % 3 == 1, F.col("product_name"))
    goods = t.products.join(stored_products(t), "product_id")
    return goods.select(
        "product_id",
        cat.is_perishable(F.col("storage_type"), F.col("category")).alias("is_perishable"),
        cat.launch_status(name, F.lit("Regular")).alias("launch_status"),
        cat.blank_to_sentinel(text).alias("type"),
    )


def customer_scores(t: TestTables) -> DataFrame:
    key, day = F.col("customer_id"), F.lit("2024-01-01").cast("date")
    persona = pick(key % 8, *loyalty.LIFETIME_BOUNDS, "Unlisted")
    return (
        t.customers.select(
            "customer_id",
            F.date_sub(day, (key % 900).cast("int")).alias("registered"),
            F.date_add(day, (key % 211).cast("int")).alias("last_order"),
            (1 + key % 25).cast("int").alias("monthly_orders"),
            (100 + key * 37 % 3000).cast("int").alias("basket"),
            persona.alias("persona"),
            pick(key % 2, "Quick Pass", "Non Member").alias("plan"),
            pick(key % 3, "Active", "Inactive", "Dormant").alias("status"),
        )
        .withColumn("tenure_months", loyalty.tenure_months(F.col("registered"), F.col("last_order")))
        .select(
            "customer_id",
            "tenure_months",
            loyalty.lifetime_value(
                F.col("tenure_months"), F.col("monthly_orders"), F.col("basket"), F.col("persona")
            ).alias("lifetime_value"),
            loyalty.loyalty_score(
                F.col("monthly_orders"), F.col("basket"), F.col("tenure_months"), F.col("plan"), F.col("status")
            ).alias("loyalty_score"),
        )
    )


def age_ranges(t: TestTables) -> DataFrame:
    key = F.col("customer_id")
    low, high = (18 + key % 30).cast("string"), (50 + key % 20).cast("string")
    text = (
        F.when(key % 3 == 0, F.concat_ws("-", low, high))
        .when(key % 3 == 1, F.concat(F.concat_ws("-", low, high), F.lit("+")))
        .otherwise(F.concat(low, F.lit("+")))
    )
    least, most = loyalty.age_bounds(F.col("age_group"))
    return t.customers.select("customer_id", text.alias("age_group")).select(
        "*", least.alias("age_min"), most.alias("age_max")
    )


def percent_texts(t: TestTables) -> DataFrame:
    key = F.col("customer_id")
    text = F.when(key % 4 == 0, "all of it").otherwise(
        F.concat(F.lit("keep "), key % 50, F.lit("-"), key % 50 + 25, F.lit("% of items"))
    )
    least, most = stocking.percent_range(F.col("rule"))
    return t.customers.select("customer_id", text.alias("rule")).select(
        "*", least.alias("share_min"), most.alias("share_max"), stocking.percent_value(F.col("rule")).alias("share")
    )


def quota_samples(t: TestTables) -> DataFrame:
    sample = derive.quota_sample(t.products, "category", "product_id", 1000, QUOTA_WEIGHTS)
    return sample.select("product_id", "category")


def weighted_samples(t: TestTables) -> DataFrame:
    weight = F.when(F.col("product_id") % 3 == 0, 1.4).otherwise(1.0)
    share = pick(F.col("store_id") % 3, "0.55", "0.70", "0.85").cast("decimal(3,2)")
    return derive.weighted_sample(t.inventory.select("store_id", "product_id"), "store_id", "product_id", weight, share)


def derived() -> dict[str, Query]:
    plans = {
        "t01_delivery_slot": delivery_slots,
        "t02_peak_hour": peak_flags,
        "t03_delivery_minutes": delivery_minutes,
        "t04_delivery_fee": delivery_fees,
        "t05_order_total": order_totals,
        "t06_payment_status": payment_statuses,
        "t07_rating": ratings,
        "t08_discount_allocation": discount_allocation,
        "t09_return_eligibility": returnable,
        "t10_refund_amount": refunds,
        "t11_return_date": return_dates,
        "t12_reorder_level": reorder_levels,
        "t13_stock_status": stock_statuses,
        "t14_batch_id": batch_ids,
        "t15_cold_chain_expiry": cold_chain,
        "t16_flat_catalogue": flat_catalogue,
        "t17_first_combination": first_combinations,
        "t18_unique_sku": skus,
        "t19_display_name": display_names,
        "t20_price_ladder": price_ladder,
        "t21_product_flags": product_flags,
        "t22_customer_scores": customer_scores,
        "t23_age_range": age_ranges,
        "f16_percent_text": percent_texts,
        "io1_csv_parse": parsed_orders,
        "io4_catalogue_parse": parsed_catalogue,
        "t14_text_batch_id": text_batch_ids,
        "b1_first_expired_first_out": allocations,
        "b2_cash_on_delivery_ban": bans,
        "b3_daily_cutoff": cutoffs,
        "t24_quota_sample": quota_samples,
        "t25_weighted_sample": weighted_samples,
    }
    return {name: bind(plan) for name, plan in plans.items()}
