"""Declared schemas of the eight retail tables and of the nested catalogue.

Column names are matched case-insensitively, so files with Title_Case headers
load as they are. Nothing is ever inferred from data.
"""

from __future__ import annotations

from pyspark.sql import types as T

# Column names and order of the tables' interchange files.
_TABLES = {
    "customers": """
        customer_id string, customer_name string, gender string, age int, age_group string,
        customer_persona string, occupation string, monthly_income int, city string, area string,
        pincode string, residential_type string, preferred_payment_method string, membership string,
        registration_date date, last_order_date date, preferred_order_time string,
        preferred_category string, average_basket_value int, average_orders_per_month int,
        lifetime_value int, loyalty_score int, cod_eligible boolean, customer_status string""",
    "products": """
        product_id string, sku string, product_name string, brand string, brand_tier string,
        category string, sub_category string, item string, type string, variant string,
        flavour string, unit string, size decimal(10,2), mrp decimal(14,2),
        selling_price decimal(14,2), cost_price decimal(14,2), discount_percentage decimal(4,1),
        shelf_life_days int, storage_type string, gst_percentage int, is_perishable boolean,
        product_status string, average_rating decimal(2,1), launch_status string""",
    "dark_stores": """
        store_id string, store_name string, city string, area string, pincode string,
        store_type string, service_radius_km decimal(3,1), storage_capacity int,
        temperature_control boolean, daily_order_capacity int, current_status string""",
    "riders": """
        rider_id string, rider_name string, store_id string, rider_status string,
        average_rating decimal(2,1), average_delivery_time_min decimal(3,1)""",
    "orders": """
        order_id string, customer_id string, store_id string, rider_id string,
        order_timestamp timestamp_ntz, delivery_slot string, payment_method string,
        payment_status string, order_status string, cancellation_reason string,
        delivery_fee decimal(14,2), coupon_discount decimal(14,2), estimated_delivery_time int,
        actual_delivery_time int, delivery_distance_km decimal(4,2), total_order_value decimal(14,2),
        weather_condition string, peak_hour string, festival_flag string, order_source string,
        customer_delivery_rating int""",
    "order_details": """
        order_detail_id string, order_id string, product_id string, quantity int,
        selling_price decimal(14,2), item_discount decimal(14,2), final_item_price decimal(14,2)""",
    "returns": """
        return_id string, order_id string, product_id string, return_date timestamp_ntz,
        return_reason string, refund_amount decimal(14,2), return_status string""",
    "inventory": """
        inventory_id string, store_id string, product_id string, current_stock int,
        reorder_level int, last_restock_date date, next_restock_date date, batch_id string,
        expiry_date string, inventory_status string""",
}

# Keys and nesting of the catalogue document.
CATALOGUE = """
    categories array<struct<
        category_name: string,
        sub_categories: array<struct<
            sub_category_name: string, storage_type: string, gst_percentage: int, base_shelf_life_days: int,
            brands: array<struct<name: string, tier: string>>,
            items: array<struct<
                item_name: string, types: array<string>, variants: array<string>, flavours: array<string>,
                sizes: array<struct<unit: string, value: decimal(10,2),
                                    price_range: struct<min: decimal(14,2), max: decimal(14,2)>>>>>>>>>
"""

TABLE_NAMES = tuple(_TABLES)


def schema(table: str) -> T.StructType:
    return T.StructType.fromDDL(_TABLES[table])


def catalogue_schema() -> T.StructType:
    return T.StructType.fromDDL(CATALOGUE)
