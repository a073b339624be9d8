"""Dense numbers over distributed rows, and the uniqueness check that upserts rely on."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from shelfwise.session import fresh_folder, store

# monotonically_increasing_id keeps the partition number above these bits.
_ROW_BITS = 33


def number_rows(df: DataFrame, order: list[str], number: str, start: int = 0) -> DataFrame:
    """Add ``number`` = start + 1, start + 2, ... in the given order.

    The rows are range-partitioned and written, then each partition's row count gives the offset of
    the next one. No single task sees all rows; the offsets table has one row per written partition,
    so it is small enough to broadcast whatever the data size.
    """
    slotted = (
        df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_slot", F.monotonically_increasing_id())
    )
    slotted = store(slotted, fresh_folder(df.sparkSession, f"number-{number}"))
    slotted = slotted.withColumn("_part", F.shiftright("_slot", _ROW_BITS))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        slotted.groupBy("_part")
        .agg(F.count(F.lit(1)).alias("_rows"))
        .select("_part", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_offset"))
    )
    position = F.col("_slot").bitwiseAND(F.lit((1 << _ROW_BITS) - 1))
    return (
        slotted.join(F.broadcast(offsets), "_part")
        .withColumn(number, F.lit(start) + F.col("_offset") + position + 1)
        .drop("_slot", "_part", "_offset")
    )


def duplicated(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.groupBy(*columns).agg(F.count(F.lit(1)).alias("copies")).where(F.col("copies") > 1)


def require_unique(df: DataFrame, columns: list[str], what: str) -> None:
    clash = duplicated(df, columns).limit(3).collect()
    if clash:
        raise ValueError(f"{what}: {', '.join(columns)} must be unique, found {clash}")
