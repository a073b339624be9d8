"""Cleaning rules as tagged frames.

A tagged frame keeps every staged row and adds ``reject_reason``: the first rule the row breaks, or
NULL. It is written once, so the kept rows and the reject log always describe the same rows.

The lookup that shows whether an id is known also brings what a fact needs from it (surrogate keys,
header fields), so large tables meet each lookup once and facts need no further join.

The reasons of rejected rows are fixed values.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from shelfwise.functions.retail import date_key, line_amount, pos_reason, pos_status, standard_word
from shelfwise.sources.linked import union_all

REASON = "reject_reason"

# Extra copies are written to the log in runs of this many rows per task record.
COPIES_PER_RECORD = 10_000


def _first_reason(*rules: tuple[Column, str]) -> Column:
    return F.coalesce(*[F.when(broken, F.lit(reason)) for broken, reason in rules])


def known_ids(cleaned: DataFrame, column: str) -> DataFrame:
    """The distinct ids of a table. Write it before joining: AQE splits a hot id of a left join only
    when nothing sits between the other side's shuffle and the join."""
    return cleaned.select(F.col(column).alias("known_id")).where(F.col(column).isNotNull()).distinct()


def _look_up(df: DataFrame, column: str, known: DataFrame, flag: str, *wanted: str) -> DataFrame:
    """Add ``flag``, TRUE where ``column`` is a known id and else NULL, and the ``wanted`` columns.

    ``known`` has one row per ``known_id``, so no rows are added.
    """
    return df.join(known.select(F.col("known_id").alias(column), F.lit(True).alias(flag), *wanted), column, "left")


def _negative(*columns: str) -> Column:
    low = F.lit(False)
    for column in columns:
        low = low | (F.col(column) < 0)
    return low


def tag_customers(staged: DataFrame) -> DataFrame:
    """One row per distinct id, name and email; ``copies`` counts the rows it stands for.

    Further columns do not make a record another one. Copies collapse in the map-side aggregate, so a
    record with very many copies is never gathered.
    """
    record = ["customer_id", "customer_name", "email"]
    further = [F.first(c).alias(c) for c in staged.columns if c not in record]
    return (
        staged.groupBy(*record)
        .agg(*further, F.count(F.lit(1)).alias("copies"))
        .withColumn(REASON, _first_reason((F.col("customer_id").isNull(), "Null customer_id")))
    )


def tag_products(staged: DataFrame) -> DataFrame:
    return staged.withColumn(REASON, _first_reason((F.col("product_id").isNull(), "Null product_id")))


def tag_stores(staged: DataFrame) -> DataFrame:
    return staged.withColumn(REASON, _first_reason((F.col("store_id").isNull(), "Null store_id")))


def tag_online_orders(staged: DataFrame, stores: DataFrame, customers: DataFrame) -> DataFrame:
    tagged = staged.withColumn("order_status", standard_word("order_status"))
    tagged = _look_up(tagged, "customer_id", customers, "has_customer", "customer_key")
    tagged = _look_up(tagged, "fulfilment_store_id", stores, "has_store", "store_key")
    unknown = F.col("has_store").isNull() | F.col("has_customer").isNull()
    return _tag("stg_online_orders", staged, tagged, (unknown, "Unknown store_id or customer_id"))


def tag_pos_transactions(staged: DataFrame, stores: DataFrame) -> DataFrame:
    tagged = staged.withColumns(
        {"transaction_status": pos_status("transaction_status"), "rejection_reason": pos_reason("rejection_reason")}
    )
    tagged = _look_up(tagged, "store_id", stores, "has_store", "store_key")
    return _tag(
        "stg_pos_transactions",
        staged,
        tagged,
        (F.col("transaction_status") == "PENDING", "PENDING (not final) - skipped this run"),
        (F.col("has_store").isNull(), "Unknown store_id"),
    )


def tag_inventory(staged: DataFrame, products: DataFrame, stores: DataFrame) -> DataFrame:
    tagged = _look_up(staged, "product_id", products, "has_product", "product_key")
    tagged = _look_up(tagged, "store_id", stores, "has_store", "store_key")
    return _tag(
        "stg_inventory",
        staged,
        tagged,
        (F.col("has_product").isNull() | F.col("has_store").isNull(), "Unknown product_id or store_id"),
        (_negative("on_hand_quantity", "reserved_quantity"), "Negative on_hand or reserved"),
    )


def _tag_items(name: str, staged: DataFrame, products: DataFrame, headers: DataFrame, header_id: str, orphan: str) -> DataFrame:
    tagged = _look_up(staged, "product_id", products, "has_product", "product_key")
    tagged = _look_up(tagged, header_id, headers, "has_header", *[c for c in headers.columns if c != "known_id"])
    return _tag(
        name,
        staged,
        tagged,
        (F.col("has_product").isNull(), "Unknown product_id"),
        (_negative("quantity", "unit_price"), "Negative quantity or price"),
        (F.col("has_header").isNull(), orphan),
    ).withColumn("line_amount", F.when(F.col(REASON).isNull(), line_amount()).otherwise(F.col("line_amount")))


def tag_order_items(staged: DataFrame, products: DataFrame, orders: DataFrame) -> DataFrame:
    return _tag_items("stg_order_items", staged, products, orders, "order_id", "Parent order missing")


def tag_pos_items(staged: DataFrame, products: DataFrame, transactions: DataFrame) -> DataFrame:
    return _tag_items("stg_pos_items", staged, products, transactions, "transaction_id", "Parent transaction missing")


def tag_reservations(staged: DataFrame, products: DataFrame, stores: DataFrame, orders: DataFrame) -> DataFrame:
    tagged = staged.withColumn("reservation_status", standard_word("reservation_status"))
    tagged = _look_up(tagged, "product_id", products, "has_product", "product_key")
    tagged = _look_up(tagged, "order_id", orders, "has_header", "customer_key")
    # the few stores come last, so that what they bring is in no shuffle
    tagged = _look_up(tagged, "store_id", stores, "has_store", "store_key")
    return _tag(
        "stg_reservations",
        staged,
        tagged,
        (F.col("has_product").isNull() | F.col("has_store").isNull(), "Unknown product_id or store_id"),
        (F.col("has_header").isNull(), "Parent order missing"),
    )


# staged name -> columns its lookups add for the facts
RESOLVED = {
    "stg_online_orders": ("store_key", "customer_key"),
    "stg_pos_transactions": ("store_key",),
    "stg_inventory": ("product_key", "store_key"),
    "stg_order_items": ("product_key", "store_key", "customer_key", "date_key", "order_status"),
    "stg_pos_items": ("product_key", "store_key", "date_key", "transaction_status", "rejection_reason"),
    "stg_reservations": ("product_key", "store_key", "customer_key"),
}


def _tag(name: str, staged: DataFrame, tagged: DataFrame, *rules: tuple[Column, str]) -> DataFrame:
    return tagged.select(*staged.columns, *RESOLVED[name], _first_reason(*rules).alias(REASON))


def kept(name: str, tagged: DataFrame) -> DataFrame:
    """The cleaned rows of a staged table, with the staged columns only."""
    return tagged.where(F.col(REASON).isNull()).drop(REASON, "copies", *RESOLVED.get(name, ()))


def known_master(cleaned: DataFrame, dimension: DataFrame) -> DataFrame:
    """Ids of a cleaned master table with their surrogate keys."""
    key, natural = dimension.columns[:2]
    return cleaned.select(natural).join(dimension.select(natural, key), natural).withColumnRenamed(natural, "known_id")


# headers lines refer to -> (id, timestamp, columns taken over)
HEADERS = {
    "stg_online_orders": ("order_id", "created_at", ("store_key", "customer_key", "order_status")),
    "stg_pos_transactions": (
        "transaction_id",
        "transaction_timestamp",
        ("store_key", "transaction_status", "rejection_reason"),
    ),
}


def known_headers(name: str, tagged: DataFrame) -> DataFrame:
    """Cleaned orders or till transactions by id, with the fields their lines take over."""
    identifier, stamp, taken = HEADERS[name]
    headers = tagged.where(F.col(REASON).isNull() & F.col(identifier).isNotNull())
    return headers.select(F.col(identifier).alias("known_id"), date_key(stamp).alias("date_key"), *taken)


# staged name -> column written to the log as record_id
RECORD_ID = {
    "stg_customers": "customer_name",
    "stg_products": "sku",
    "stg_stores": "store_name",
    "stg_online_orders": "order_id",
    "stg_pos_transactions": "transaction_id",
    "stg_inventory": "inventory_id",
    "stg_order_items": "order_item_id",
    "stg_pos_items": "transaction_item_id",
    "stg_reservations": "reservation_id",
}


def rejects(name: str, tagged: DataFrame) -> DataFrame:
    log = tagged.where(F.col(REASON).isNotNull()).select(
        F.lit(name).alias("source_table"), F.col(RECORD_ID[name]).cast("string").alias("record_id"), REASON
    )
    return log.unionByName(_duplicates(name, tagged)) if "copies" in tagged.columns else log


def _duplicates(name: str, tagged: DataFrame) -> DataFrame:
    """One log row per removed copy. Runs of copies are spread out before they become rows."""
    extra = F.col("copies") - 1
    runs = tagged.where(extra > 0).select(
        F.col("customer_id").alias("record_id"),
        extra.alias("extra"),
        F.explode(F.sequence(F.lit(0).cast("bigint"), extra - 1, F.lit(COPIES_PER_RECORD).cast("bigint"))).alias("first"),
    )
    last = F.least(F.col("first") + COPIES_PER_RECORD, F.col("extra"))
    spread = runs.repartition("record_id", "first")
    return spread.select("record_id", F.explode(F.sequence(F.col("first") + 1, last)).alias("copy")).select(
        F.lit(name).alias("source_table"), "record_id", F.lit("Duplicate record removed").alias(REASON)
    )


# staged name -> (tagging function, tables it looks ids up in)
RULES: dict[str, tuple[Callable[..., DataFrame], tuple[str, ...]]] = {
    "stg_products": (tag_products, ()),
    "stg_stores": (tag_stores, ()),
    "stg_customers": (tag_customers, ()),
    "stg_online_orders": (tag_online_orders, ("stg_stores", "stg_customers")),
    "stg_pos_transactions": (tag_pos_transactions, ("stg_stores",)),
    "stg_inventory": (tag_inventory, ("stg_products", "stg_stores")),
    "stg_order_items": (tag_order_items, ("stg_products", "stg_online_orders")),
    "stg_pos_items": (tag_pos_items, ("stg_products", "stg_pos_transactions")),
    "stg_reservations": (tag_reservations, ("stg_products", "stg_stores", "stg_online_orders")),
}


def reject_log(tagged: dict[str, DataFrame]) -> DataFrame:
    return union_all(rejects(name, df) for name, df in tagged.items())
