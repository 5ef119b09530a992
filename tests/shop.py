"""A tiny, valid set of retail tables to bend in tests."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal as D

from larder.sources import schemas
from larder.sources.retail import RetailTables

NA = "Not Applicable"


def day(text: str) -> dt.date:
    return dt.date.fromisoformat(text)


def moment(text: str) -> dt.datetime:
    return dt.datetime.fromisoformat(text)


def customer(i: int, **changes):
    row = dict(
        customer_id=f"C{i:06d}", customer_name=f"Person {i}", gender="F", age=30, age_group="26-35",
        customer_persona="Parent", occupation="Teacher", monthly_income=50000, city="Bengaluru", area="Hebbal",
        pincode="560024", residential_type="Flat", preferred_payment_method="UPI", membership="Quick Pass",
        registration_date=day("2024-01-01"), last_order_date=day("2025-05-01"), preferred_order_time="18:00-22:00",
        preferred_category="Snacks", average_basket_value=500, average_orders_per_month=4, lifetime_value=40000,
        loyalty_score=70, cod_eligible=True, customer_status="Active",
    )
    return {**row, **changes}


def product(i: int, **changes):
    row = dict(
        product_id=f"P{i:06d}", sku=f"SKU-{i}", product_name=f"Brand Item {i}", brand="Brand", brand_tier="Popular",
        category="Snacks", sub_category="Chips", item=f"Item {i}", type=NA, variant=NA, flavour=NA, unit="g",
        size=D("90.00"), mrp=D("100.00"), selling_price=D("90.00"), cost_price=D("60.00"),
        discount_percentage=D("10.0"), shelf_life_days=120, storage_type="Ambient", gst_percentage=5,
        is_perishable=False, product_status="Available", average_rating=D("4.3"), launch_status="Regular",
    )
    return {**row, **changes}


def store(i: int, kind: str, **changes):
    size = {"Micro": (D("2.5"), 1500, 700), "Large": (D("6.0"), 3000, 2000)}[kind]
    row = dict(
        store_id=f"DS{i:03d}", store_name=f"Store {i}", city="Bengaluru", area=f"Area {i}", pincode=f"56000{i}",
        store_type=kind, service_radius_km=size[0], storage_capacity=size[1], temperature_control=True,
        daily_order_capacity=size[2], current_status="Active",
    )
    return {**row, **changes}


def rider(i: int, s: int, **changes):
    row = dict(rider_id=f"RID{i:04d}", rider_name=f"Rider {i}", store_id=f"DS{s:03d}", rider_status="Active",
               average_rating=D("4.5"), average_delivery_time_min=D("15.0"))
    return {**row, **changes}


def order(i: int, c: int, when: str, total: str, **changes):
    row = dict(
        order_id=f"ORD{i:07d}", customer_id=f"C{c:06d}", store_id="DS001", rider_id="RID0001",
        order_timestamp=moment(when), delivery_slot="06:00 PM - 07:00 PM", payment_method="UPI", payment_status="Paid",
        order_status="Delivered", cancellation_reason=None, delivery_fee=D("10.00"), coupon_discount=D("0.00"),
        estimated_delivery_time=20, actual_delivery_time=22, delivery_distance_km=D("3.20"),
        total_order_value=D(total), weather_condition="Clear", peak_hour="Yes", festival_flag="No",
        order_source="App", customer_delivery_rating=5,
    )
    return {**row, **changes}


def line(i: int, o: int, p: int, quantity: int, price: str, discount: str = "0.00", **changes):
    row = dict(order_detail_id=f"OD{i:08d}", order_id=f"ORD{o:07d}", product_id=f"P{p:06d}", quantity=quantity,
               selling_price=D(price), item_discount=D(discount), final_item_price=D(price) * quantity - D(discount))
    return {**row, **changes}


def returned(i: int, o: int, p: int, when: str, refund: str, status: str = "Approved", **changes):
    row = dict(return_id=f"RET{i:07d}", order_id=f"ORD{o:07d}", product_id=f"P{p:06d}", return_date=moment(when),
               return_reason="Expired Product", refund_amount=D(refund), return_status=status)
    return {**row, **changes}


def stock(i: int, s: int, p: int, **changes):
    row = dict(inventory_id=f"INV{i:06d}", store_id=f"DS{s:03d}", product_id=f"P{p:06d}", current_stock=100,
               reorder_level=75, last_restock_date=day("2025-03-20"), next_restock_date=day("2025-03-24"),
               batch_id=f"B250320{i:04d}", expiry_date=NA, inventory_status="In Stock")
    return {**row, **changes}


def valid_rows() -> dict[str, list[dict]]:
    return {
        "customers": [customer(1), customer(2), customer(3, membership="Non Member")],
        "products": [product(i) for i in range(1, 5)],
        "dark_stores": [store(1, "Micro"), store(2, "Large")],
        "riders": [rider(1, 1), rider(2, 2), rider(3, 2, rider_status="On Leave")],
        "orders": [
            order(1, 1, "2025-04-01T18:30:00", "180.00"),
            order(2, 2, "2025-04-02T09:00:00", "85.00"),
            order(3, 1, "2025-06-15T20:00:00", "90.00", order_status="Cancelled", cancellation_reason="Out of Stock",
                  customer_delivery_rating=None, payment_status="Refunded"),
        ],
        "order_details": [line(1, 1, 1, 1, "90.00"), line(2, 1, 2, 1, "90.00"), line(3, 2, 1, 1, "90.00", "5.00"),
                          line(4, 3, 3, 1, "90.00")],
        "returns": [returned(1, 1, 2, "2025-04-02T18:30:00", "90.00"),
                    returned(2, 2, 1, "2025-04-02T09:00:00", "0.00", "Rejected")],
        "inventory": [stock(1, 1, 1), stock(2, 1, 2, current_stock=10, inventory_status="Low Stock"),
                      stock(3, 2, 1), stock(4, 2, 2), stock(5, 2, 3, current_stock=0, inventory_status="Out of Stock")],
    }


class Shop(RetailTables):
    """Retail tables from rows in memory; tables not given are the valid ones."""

    def __init__(self, spark, **tables):
        super().__init__(spark, "")
        self.rows = {**valid_rows(), **tables}

    def _table(self, name, timestamp=None):
        schema = schemas.schema(name)
        rows = [tuple(r[c] for c in schema.fieldNames()) for r in self.rows[name]]
        return self.spark.createDataFrame(rows, schema)
