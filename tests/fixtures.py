"""Small invented source tables: a clean set and one faulty row per cleaning rule."""

from __future__ import annotations

from datetime import datetime
from decimal import Decimal

from shelfwise.sources.schemas import SOURCES

D = Decimal
DAY = datetime(2025, 5, 10, 9, 30)


def clean_rows() -> dict[str, list[tuple]]:
    return {
        "inventory.product": [
            ("P001", "SKU-A", "Paper Lamp", "Lighting", D("12.50"), True),
            ("P002", "SKU-B", "Oak Stool", "Seating", D("80.00"), True),
            ("P003", "SKU-C", "Wool Rug", "Textiles", D("45.25"), False),
        ],
        "inventory.store": [("S001", "Harbour", "North", True), ("S002", "Mill Lane", "South", True)],
        "inventory.inventory": [
            ("I001", "P001", "S001", 2, 2, 0, DAY),
            ("I002", "P002", "S001", 5, 1, 4, DAY),
            ("I003", "P001", "S002", 7, 0, 7, DAY),
        ],
        "inventory.inventory_movement": [
            ("M1", "P001", "S001", "ONLINE_RESERVATION", -2, "ECOMMERCE", "R001", DAY),
            ("M2", "P002", "S001", "ONLINE_RESERVATION", -1, "ECOMMERCE", "R002", DAY),
            ("M3", "P001", "S002", "POS_SALE", -1, "POS", "T001", DAY),
        ],
        "ecommerce.customer": [("C001", "Ines Vale", "ines@x.test"), ("C002", "Tom Reed", "tom@x.test")],
        "ecommerce.online_order": [
            ("O001", "C001", "S001", "CONFIRMED", D("25.00"), DAY, DAY),
            ("O002", "C002", "S001", "READY_FOR_COLLECTION", D("80.00"), DAY, DAY),
            ("O003", "C002", "S002", "CANCELLED", D("45.25"), DAY, DAY),
        ],
        "ecommerce.order_item": [
            ("OI001", "O001", "P001", 2, D("12.50"), D("25.00")),
            ("OI002", "O002", "P002", 1, D("80.00"), D("80.00")),
            ("OI003", "O003", "P001", 1, D("45.25"), D("45.25")),
        ],
        "ecommerce.reservation": [
            ("R001", "O001", "P001", "S001", 2, "ACTIVE", DAY, None, None),
            ("R002", "O002", "P002", "S001", 1, "ACTIVE", DAY, None, None),
            ("R003", "O003", "P001", "S002", 1, "CANCELLED", DAY, None, DAY),
        ],
        "pos.pos_transaction": [
            ("T001", "S002", DAY, "COMPLETED", "NONE", D("12.50")),
            ("T002", "S001", DAY, "BLOCKED", "RESERVED_STOCK", D("0.00")),
        ],
        "pos.pos_transaction_item": [
            ("TI001", "T001", "P001", 1, D("12.50"), D("12.50")),
            ("TI002", "T002", "P001", 1, D("12.50"), D("12.50")),
        ],
    }


def faulty_rows() -> dict[str, list[tuple]]:
    rows = clean_rows()
    rows["inventory.product"] += [(None, "SKU-X", "No Id", "Misc", D("1.00"), True)]
    rows["inventory.store"] += [(None, "Nowhere", "East", True)]
    rows["ecommerce.customer"] += [
        ("C001", "Ines Vale", "ines@x.test"),
        ("C001", "Ines Vale", "ines@x.test"),
        (None, "Nameless", "n@x.test"),
        (None, "Nameless", "n@x.test"),
    ]
    rows["ecommerce.online_order"] += [
        ("O010", "C404", "S001", "confirmed", D("1.00"), DAY, DAY),
        ("O011", "C001", "S404", " Confirmed", D("1.00"), DAY, DAY),
        ("O012", "C001", "S001", "collected ", D("1.00"), DAY, DAY),
    ]
    rows["ecommerce.order_item"] += [
        ("OI010", "O001", "P404", -5, D("1.00"), D("1.00")),
        ("OI011", "O001", None, 1, D("1.00"), D("1.00")),
        ("OI012", "O010", "P001", -1, D("1.00"), D("1.00")),
        ("OI013", "O001", "P001", 1, D("-1.00"), D("1.00")),
        ("OI014", "O010", "P001", 1, D("1.00"), D("1.00")),
        ("OI015", "O012", "P001", 0, D("1.00"), D("9.00")),
    ]
    rows["ecommerce.reservation"] += [
        ("R010", "O001", "P404", "S404", 1, "ACTIVE", DAY, None, None),
        ("R011", "O001", "P001", "S404", 1, "ACTIVE", DAY, None, None),
        ("R012", "O011", "P001", "S001", 1, "ACTIVE", DAY, None, None),
        ("R013", "O012", "P003", "S002", 1, " collected", DAY, None, None),
    ]
    rows["pos.pos_transaction"] += [
        ("T010", "S404", DAY, "pending", None, D("0.00")),
        ("T011", "S404", DAY, "COMPLETED", None, D("0.00")),
        ("T012", "S001", DAY, " approved ", " none ", D("80.00")),
        ("T013", "S001", DAY, "Rejected", "out_of_stock", D("0.00")),
    ]
    rows["pos.pos_transaction_item"] += [
        ("TI010", "T010", "P001", 1, D("1.00"), D("1.00")),
        ("TI011", "T012", "P404", 2, D("1.00"), D("2.00")),
        ("TI012", "T012", "P001", -1, D("1.00"), D("1.00")),
        ("TI013", "T012", "P002", 1, D("80.00"), D("80.00")),
        ("TI014", "T013", "P002", 1, D("80.00"), D("80.00")),
    ]
    rows["inventory.inventory"] += [
        ("I010", "P404", "S001", 4, 0, 4, DAY),
        ("I011", "P001", "S404", -1, 0, -1, DAY),
        ("I012", "P003", "S001", -1, 0, -1, DAY),
        ("I013", "P003", "S002", 1, -1, 2, DAY),
    ]
    return rows


# (table, record_id, reason) of every row the faulty set must log
EXPECTED_REJECTS = [
    ("stg_customers", "C001", "Duplicate record removed"),
    ("stg_customers", "C001", "Duplicate record removed"),
    ("stg_customers", "Nameless", "Null customer_id"),
    ("stg_customers", None, "Duplicate record removed"),
    ("stg_inventory", "I010", "Unknown product_id or store_id"),
    ("stg_inventory", "I011", "Unknown product_id or store_id"),
    ("stg_inventory", "I012", "Negative on_hand or reserved"),
    ("stg_inventory", "I013", "Negative on_hand or reserved"),
    ("stg_online_orders", "O010", "Unknown store_id or customer_id"),
    ("stg_online_orders", "O011", "Unknown store_id or customer_id"),
    ("stg_order_items", "OI010", "Unknown product_id"),
    ("stg_order_items", "OI011", "Unknown product_id"),
    ("stg_order_items", "OI012", "Negative quantity or price"),
    ("stg_order_items", "OI013", "Negative quantity or price"),
    ("stg_order_items", "OI014", "Parent order missing"),
    ("stg_pos_items", "TI010", "Parent transaction missing"),
    ("stg_pos_items", "TI011", "Unknown product_id"),
    ("stg_pos_items", "TI012", "Negative quantity or price"),
    ("stg_pos_transactions", "T010", "PENDING (not final) - skipped this run"),
    ("stg_pos_transactions", "T011", "Unknown store_id"),
    ("stg_products", "SKU-X", "Null product_id"),
    ("stg_reservations", "R010", "Unknown product_id or store_id"),
    ("stg_reservations", "R011", "Unknown product_id or store_id"),
    ("stg_reservations", "R012", "Parent order missing"),
    ("stg_stores", "Nowhere", "Null store_id"),
]


def linked(spark, rows):
    return {name: spark.createDataFrame(rows[name], schema) for name, schema in SOURCES.items()}
