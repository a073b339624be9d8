"""Source table schemas, agreed status words and the keys declared on each table."""

from __future__ import annotations

from pyspark.sql.types import (
    BooleanType,
    DecimalType,
    IntegerType,
    StringType,
    StructType,
    TimestampNTZType,
    TimestampType,
)

# Column names and types of the ten source tables.
_COLUMNS = {
    "inventory.product": "product_id string, sku string, product_name string, category string, "
    "unit_price decimal(10,2), active_flag boolean",
    "inventory.store": "store_id string, store_name string, location string, active_flag boolean",
    "inventory.inventory": "inventory_id string, product_id string, store_id string, "
    "on_hand_quantity int, reserved_quantity int, available_to_sell int, updated_at timestamp",
    "inventory.inventory_movement": "movement_id string, product_id string, store_id string, "
    "movement_type string, quantity_change int, source_system string, source_reference_id string, "
    "movement_timestamp timestamp",
    "ecommerce.customer": "customer_id string, customer_name string, email string",
    "ecommerce.online_order": "order_id string, customer_id string, fulfilment_store_id string, "
    "order_status string, order_total decimal(10,2), created_at timestamp_ntz, updated_at timestamp_ntz",
    "ecommerce.order_item": "order_item_id string, order_id string, product_id string, quantity int, "
    "unit_price decimal(10,2), line_amount decimal(10,2)",
    "ecommerce.reservation": "reservation_id string, order_id string, product_id string, store_id string, "
    "quantity int, reservation_status string, created_at timestamp_ntz, expires_at timestamp_ntz, "
    "released_at timestamp_ntz",
    "pos.pos_transaction": "transaction_id string, store_id string, transaction_timestamp timestamp_ntz, "
    "transaction_status string, rejection_reason string, total_amount decimal(10,2)",
    "pos.pos_transaction_item": "transaction_item_id string, transaction_id string, product_id string, "
    "quantity int, unit_price decimal(10,2), line_amount decimal(10,2)",
}

_TYPES = {
    "string": StringType(),
    "int": IntegerType(),
    "boolean": BooleanType(),
    "decimal(10,2)": DecimalType(10, 2),
    "timestamp": TimestampType(),
    "timestamp_ntz": TimestampNTZType(),
}


def _schema(columns: str) -> StructType:
    schema = StructType()
    for column in columns.split(", "):
        name, kind = column.split(" ")
        schema = schema.add(name, _TYPES[kind])
    return schema


SOURCES: dict[str, StructType] = {name: _schema(columns) for name, columns in _COLUMNS.items()}

# Status words agreed with the source owners.
ORDER_STATUSES = ("CONFIRMED", "CANCELLED", "COLLECTED", "READY_FOR_COLLECTION")
RESERVATION_STATUSES = ("ACTIVE", "CANCELLED", "COLLECTED", "EXPIRED")
POS_STATUSES = ("COMPLETED", "BLOCKED")
POS_REASONS = ("RESERVED_STOCK", "OUT_OF_STOCK", "NONE")

# Movement types that touch a reservation reference.
ONLINE_RESERVATION = "ONLINE_RESERVATION"
RESERVATION_RELEASE = "RESERVATION_RELEASE"
RESERVATION_COLLECTION = "RESERVATION_COLLECTION"
POS_SALE = "POS_SALE"

# staged name -> (source table, source system)
STAGED = {
    "stg_products": ("inventory.product", "INVENTORY"),
    "stg_stores": ("inventory.store", "INVENTORY"),
    "stg_inventory": ("inventory.inventory", "INVENTORY"),
    "stg_customers": ("ecommerce.customer", "ECOMMERCE"),
    "stg_online_orders": ("ecommerce.online_order", "ECOMMERCE"),
    "stg_order_items": ("ecommerce.order_item", "ECOMMERCE"),
    "stg_reservations": ("ecommerce.reservation", "ECOMMERCE"),
    "stg_pos_transactions": ("pos.pos_transaction", "POS"),
    "stg_pos_items": ("pos.pos_transaction_item", "POS"),
}

# Staged columns whose name differs from the source column.
STAGED_RENAMES = {"stg_inventory": {"available_to_sell": "source_available_to_sell"}}
