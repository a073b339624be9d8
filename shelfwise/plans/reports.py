"""Reports, dashboard questions and operational checks."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, functions as F

from shelfwise.functions.retail import is_last_unit_conflict, stock_condition
from shelfwise.operators import day_counts
from shelfwise.sources.linked import row_counts

Tables = Mapping[str, DataFrame]
PAIR = ["product_key", "store_key"]


def latest_snapshot(dw: Tables) -> DataFrame:
    """Stock rows of the newest date; the warehouse knows where they are."""
    return dw["latest_snapshot"].drop("inventory_fact_key", "date_key")


def _named(df: DataFrame, dw: Tables) -> DataFrame:
    return df.join(dw["dim_product"].select("product_key", "product_name"), "product_key").join(
        dw["dim_store"].select("store_key", "store_name"), "store_key"
    )


def inventory_availability(dw: Tables) -> DataFrame:
    return (
        _named(latest_snapshot(dw), dw)
        .select("store_name", "product_name", "on_hand_quantity", "reserved_quantity", "available_to_sell")
        .orderBy("store_name", "product_name")
    )


def pos_conflicts(dw: Tables) -> DataFrame:
    """Blocked sale lines next to the stock of their product and store."""
    blocked = dw["fact_pos_activity"].where(F.col("transaction_status") == "BLOCKED")
    blocked = blocked.select(*PAIR, "transaction_id", "transaction_status", "rejection_reason")
    return (
        _named(blocked.join(latest_snapshot(dw), PAIR), dw)
        .select(
            "transaction_id", "store_name", "product_name", "on_hand_quantity", "reserved_quantity",
            "available_to_sell", "transaction_status", "rejection_reason",
        )
        .orderBy("store_name", "product_name", "transaction_id")
    )


def pos_summary(dw: Tables) -> DataFrame:
    completed = F.col("transaction_status") == "COMPLETED"
    return (
        dw["fact_pos_activity"]
        .groupBy("store_key")
        .agg(
            F.countDistinct(F.when(completed, F.col("transaction_id"))).alias("completed_pos_sales"),
            F.coalesce(F.sum(F.when(completed, F.col("line_amount"))), F.lit(0)).cast("decimal(38,2)").alias("pos_revenue"),
        )
    )


def orders_per_store(dw: Tables) -> DataFrame:
    return dw["fact_online_order"].groupBy("store_key").agg(F.countDistinct("order_id").alias("online_orders"))


def _with_status(status: str) -> Column:
    return F.count_if(F.col("reservation_status") == status).alias(f"{status.lower()}_reservations")


def reservation_summary(dw: Tables) -> DataFrame:
    return (
        dw["fact_reservation"]
        .groupBy("store_key")
        .agg(
            F.count(F.lit(1)).alias("reservations"),
            *[_with_status(s) for s in ("ACTIVE", "COLLECTED", "CANCELLED", "EXPIRED")],
        )
    )


def omnichannel_performance(dw: Tables) -> DataFrame:
    """One row per store. Each fact is summed per store before it meets the others, so nothing fans out."""
    counts = (
        "completed_pos_sales", "online_orders", "reservations", "active_reservations", "collected_reservations",
        "cancelled_reservations", "expired_reservations",
    )
    joined = dw["dim_store"]
    for summary in (pos_summary(dw), orders_per_store(dw), reservation_summary(dw)):
        joined = joined.join(summary, "store_key", "left")
    zero = lambda c: F.coalesce(F.col(c), F.lit(0)).alias(c)
    return joined.select("store_name", *[zero(c) for c in counts], zero("pos_revenue")).orderBy("store_name")


def omnichannel_from_days(stores: DataFrame, days: DataFrame) -> DataFrame:
    """``omnichannel_performance`` of the days whose counts are given, without reading a fact."""
    counts = (
        "completed_pos_sales", "online_orders", "reservations", "active_reservations", "collected_reservations",
        "cancelled_reservations", "expired_reservations",
    )
    value = lambda n: F.coalesce(F.max(F.when(F.col("figure") == n, F.col("value"))), F.lit(0)).alias(n)
    figures = day_counts.merged(days).groupBy("store_key").agg(*[value(n) for n in (*counts, "pos_revenue")])
    zero = lambda n: F.coalesce(F.col(n), F.lit(0))
    return (
        stores.join(figures, "store_key", "left")
        .select("store_name", *[zero(n).cast("long").alias(n) for n in counts], zero("pos_revenue").cast("decimal(38,2)").alias("pos_revenue"))
        .orderBy("store_name")
    )


def last_unit_conflicts(dw: Tables) -> DataFrame:
    """Pairs whose last physical stock is fully held, with their holds and blocked sales."""
    holds = (
        dw["fact_reservation"]
        .where(F.col("reservation_status") == "ACTIVE")
        .groupBy(*PAIR)
        .agg(F.count(F.lit(1)).alias("active_reservations"))
    )
    blocked = (
        dw["fact_pos_activity"]
        .where((F.col("transaction_status") == "BLOCKED") & (F.col("rejection_reason") == "RESERVED_STOCK"))
        .groupBy(*PAIR)
        .agg(F.countDistinct("transaction_id").alias("blocked_pos_conflicts"))
    )
    conflicts = latest_snapshot(dw).where(is_last_unit_conflict())
    return (
        _named(conflicts.join(holds, PAIR, "left").join(blocked, PAIR, "left"), dw)
        .select(
            "store_name",
            "product_name",
            "on_hand_quantity",
            "reserved_quantity",
            F.coalesce("active_reservations", F.lit(0)).alias("active_reservations"),
            F.col("available_to_sell").alias("available_units"),
            F.coalesce("blocked_pos_conflicts", F.lit(0)).alias("blocked_pos_conflicts"),
        )
        .orderBy("store_name", "product_name")
    )


def out_of_stock_warning(dw: Tables) -> DataFrame:
    """Sales refused as out of stock although units were on hand."""
    refused = dw["fact_pos_activity"].where(F.col("rejection_reason") == "OUT_OF_STOCK")
    stocked = latest_snapshot(dw).where(F.col("on_hand_quantity") > 0)
    return (
        _named(refused.select(*PAIR, "transaction_id", "rejection_reason").join(stocked, PAIR), dw)
        .select(
            "transaction_id", "store_name", "product_name", "on_hand_quantity", "available_to_sell", "rejection_reason"
        )
        .orderBy("transaction_id")
    )


# ---- questions on the linked source tables ----

STOCK = ("on_hand_quantity", "reserved_quantity", "available_to_sell")


def _no_stock_left(linked: Tables) -> DataFrame:
    empty = linked["inventory.inventory"].where(F.col("available_to_sell") == 0)
    names = linked["inventory.product"].select("product_id", "product_name")
    return empty.join(names, "product_id").select("store_id", "product_id", "product_name", *STOCK)


def conflict_check(linked: Tables) -> DataFrame:
    return (
        _no_stock_left(linked).withColumn("inventory_condition", stock_condition()).orderBy("store_id", "product_id")
    )


def fully_reserved(linked: Tables) -> DataFrame:
    return _no_stock_left(linked)


def inventory_rows(linked: Tables) -> DataFrame:
    return linked["inventory.inventory"].agg(F.count(F.lit(1)).alias("inventory_rows"))


def ats_violations(linked: Tables) -> DataFrame:
    wrong = F.col("available_to_sell") != F.col("on_hand_quantity") - F.col("reserved_quantity")
    return linked["inventory.inventory"].where(wrong)


def blocked_by_reservation(linked: Tables) -> DataFrame:
    blocked = linked["pos.pos_transaction"].where(
        (F.col("transaction_status") == "BLOCKED") & (F.col("rejection_reason") == "RESERVED_STOCK")
    )
    return (
        blocked.join(linked["pos.pos_transaction_item"].select("transaction_id", "product_id"), "transaction_id")
        .join(linked["inventory.product"].select("product_id", "product_name"), "product_id")
        .select("transaction_id", "store_id", "product_id", "product_name", "transaction_status", "rejection_reason")
    )


def operational_counts(linked: Tables) -> DataFrame:
    """Rows per source table, without the schema name, sorted."""
    counts = row_counts({name.split(".")[1]: df for name, df in linked.items()}, "table_name")
    return counts.orderBy("table_name")


# ---- dashboard: one product in one store ----


def _of_pair(df: DataFrame, product_id: str, store_id: str) -> DataFrame:
    return df.where((F.col("product_id") == product_id) & (F.col("store_id") == store_id))


def _newest(df: DataFrame, stamp: str, identifier: str, rows: int) -> DataFrame:
    return df.orderBy(F.col(stamp).desc_nulls_first(), F.col(identifier).desc_nulls_first()).limit(rows)


def stock_position(linked: Tables, product_id: str, store_id: str) -> DataFrame:
    stock = _of_pair(linked["inventory.inventory"], product_id, store_id)
    return (
        stock.join(linked["inventory.product"].select("product_id", "product_name"), "product_id")
        .join(linked["inventory.store"].select("store_id", "store_name"), "store_id")
        .select("product_name", "store_name", *STOCK)
    )


def recent_movements(linked: Tables, product_id: str, store_id: str, rows: int = 10) -> DataFrame:
    moves = _of_pair(linked["inventory.inventory_movement"], product_id, store_id)
    return _newest(moves, "movement_timestamp", "movement_id", rows).select(
        "movement_timestamp", "movement_type", "quantity_change", "source_system", "source_reference_id"
    )


def recent_orders(linked: Tables, product_id: str, store_id: str, rows: int = 10) -> DataFrame:
    holds = _of_pair(linked["ecommerce.reservation"], product_id, store_id).select(
        "order_id", "reservation_id", "reservation_status", "quantity"
    )
    orders = linked["ecommerce.online_order"].select("order_id", "customer_id", "order_status", "created_at")
    names = linked["ecommerce.customer"].select("customer_id", "customer_name")
    joined = holds.join(orders, "order_id").join(names, "customer_id").select(
        "order_id", "customer_name", "order_status", "reservation_id", "reservation_status", "quantity", "created_at"
    )
    return joined.orderBy(
        F.col("created_at").desc_nulls_first(), F.col("order_id").desc_nulls_first(), "reservation_id"
    ).limit(rows)


def recent_pos_attempts(linked: Tables, product_id: str, store_id: str, rows: int = 10) -> DataFrame:
    items = linked["pos.pos_transaction_item"].where(F.col("product_id") == product_id)
    items = items.select("transaction_id", "quantity", F.col("line_amount").alias("requested_amount"))
    tills = linked["pos.pos_transaction"].where(F.col("store_id") == store_id)
    return _newest(tills.join(items, "transaction_id"), "transaction_timestamp", "transaction_id", rows).select(
        "transaction_id", "transaction_timestamp", "transaction_status", "rejection_reason", "quantity",
        "requested_amount", "total_amount",
    )
