"""Star-schema facts from the tagged tables.

Cleaning has already brought surrogate keys and header fields to every kept row, so a fact is a
projection: no join and no shuffle. A row without a date has no calendar day and does not load.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass
from datetime import date

from pyspark.sql import DataFrame, SparkSession, functions as F

from shelfwise.functions.retail import available_to_sell, date_key
from shelfwise.operators.cleaning import REASON
from shelfwise.session import store_counted

SNAPSHOT = (
    "inventory_fact_key bigint, product_key bigint, store_key bigint, date_key int, on_hand_quantity int, "
    "reserved_quantity int, available_to_sell int"
)


def _keyed(df: DataFrame, key: str, *columns: str) -> DataFrame:
    """Add a fact key: unique within one load, like a restarted sequence but with gaps."""
    return df.where(F.col("date_key").isNotNull()).select((F.monotonically_increasing_id() + 1).alias(key), *columns)


def _kept(tagged: DataFrame) -> DataFrame:
    return tagged.where(F.col(REASON).isNull())


def fact_pos_activity(items: DataFrame) -> DataFrame:
    """One row per product line of a till attempt, completed or blocked."""
    return _keyed(
        _kept(items), "pos_fact_key", "transaction_id", "transaction_item_id", "product_key", "store_key", "date_key",
        "quantity", "unit_price", "line_amount", "transaction_status", "rejection_reason",
    )


def fact_online_order(items: DataFrame) -> DataFrame:
    """One row per product line of an online order."""
    return _keyed(
        _kept(items), "order_fact_key", "order_id", "order_item_id", "product_key", "store_key", "customer_key",
        "date_key", "quantity", "unit_price", "line_amount", "order_status",
    )


def fact_reservation(reservations: DataFrame) -> DataFrame:
    """One row per reservation; the customer comes from its order, store and date are its own."""
    return _keyed(
        _kept(reservations).withColumn("date_key", date_key("created_at")), "reservation_fact_key", "reservation_id",
        "order_id", "product_key", "store_key", "customer_key", "date_key", "quantity", "reservation_status",
    )


def fact_inventory_snapshot(inventory: DataFrame, run_date: date) -> DataFrame:
    """One row per product and store for the run date."""
    stock = _kept(inventory).withColumns(
        {"date_key": date_key(F.lit(run_date)), "available_to_sell": available_to_sell()}
    )
    return _keyed(
        stock, "inventory_fact_key", "product_key", "store_key", "date_key", "on_hand_quantity", "reserved_quantity",
        "available_to_sell",
    )


@dataclass(frozen=True)
class SnapshotDay:
    """Where the rows of one date are, and how many."""

    folder: str
    rows: int


def write_snapshot_day(day: DataFrame, folder: str) -> SnapshotDay:
    """Each write of a date has a folder of its own; what readers take for the date is the caller's choice."""
    _, counts = store_counted(day, folder, "overwrite", rows=F.count(F.lit(1)))
    return SnapshotDay(folder, counts["rows"])


def snapshot_history(
    spark: SparkSession, days: Mapping[int, SnapshotDay], first: date | None = None, last: date | None = None
) -> DataFrame:
    """The snapshot from ``first`` to ``last``, of all dates by default; a date that was replaced by nothing has no rows.

    Only the folders of these dates are listed: which they are is known from ``days``.
    """
    low, high = (int(f"{d:%Y%m%d}") if d else None for d in (first, last))
    folders = [
        day.folder
        for key, day in sorted(days.items())
        if day.rows and (low is None or key >= low) and (high is None or key <= high)
    ]
    return spark.read.schema(SNAPSHOT).parquet(*folders) if folders else spark.createDataFrame([], SNAPSHOT)


def latest_day(spark: SparkSession, days: Mapping[int, SnapshotDay]) -> DataFrame:
    """Rows of the newest date that has any; no other date is read."""
    newest = max((key for key, day in days.items() if day.rows), default=None)
    return snapshot_history(spark, {} if newest is None else {newest: days[newest]})


# fact -> (builder, staged table it is built from)
FACTS = {
    "fact_pos_activity": (fact_pos_activity, "stg_pos_items"),
    "fact_online_order": (fact_online_order, "stg_order_items"),
    "fact_reservation": (fact_reservation, "stg_reservations"),
}
