"""Figures per store and day that add up over any days, distinct counts included.

Sums add up; distinct counts do not, since a sale or order may have lines on several days. So the ids themselves are
kept, as bits of their numbers: a day's ids of a store are a bit each, 64 neighbours in one word, days are merged by OR,
and the bits are counted last. Words are short because a day of a store has few ids that lie close together: a row
costs much the same with one id as with 64. Facts are read once per load; a report over some days reads the rows of these
days only.

An id is a text and a number without leading zeros ("T0070" is "T00" and 70), which names it fully. An id that does
not end in such a number, or in one of more than 18 digits, is kept as a text of its own.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from shelfwise.sources.linked import union_all

DAY_COUNTS = (
    "date_key int, store_key bigint, figure string, prefix string, bucket bigint, ids bigint, amount decimal(38,2)"
)
DISTINCT = ("completed_pos_sales", "online_orders")
# ids per word
WORD = 64
_NUMBERED = r"^(.*?)([1-9][0-9]{0,17})$"


def _ids(df: DataFrame, figure: str, column: str) -> DataFrame:
    digits = F.regexp_extract(column, _NUMBERED, 2)
    number = F.when(digits != "", digits.cast("long"))
    prefix = F.when(number.isNull(), F.col(column)).otherwise(F.regexp_extract(column, _NUMBERED, 1))
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod(number, F.lit(WORD)).cast("int"))
    return (
        df.where(F.col(column).isNotNull())
        .groupBy(
            "date_key", "store_key", F.lit(figure).alias("figure"), prefix.alias("prefix"),
            F.shiftright(number, WORD.bit_length() - 1).alias("bucket"),
        )
        .agg(F.bit_or(bit).alias("ids"))
        .withColumn("amount", F.lit(None).cast("decimal(38,2)"))
    )


def _amounts(df: DataFrame, **figures: Column) -> DataFrame:
    summed = df.groupBy("date_key", "store_key").agg(*[c.cast("decimal(38,2)").alias(n) for n, c in figures.items()])
    named = F.explode(F.array(*[F.struct(F.lit(n).alias("figure"), F.col(n).alias("amount")) for n in figures]))
    nothing = [F.lit(None).cast(kind).alias(n) for n, kind in (("prefix", "string"), ("bucket", "long"), ("ids", "long"))]
    return summed.select("date_key", "store_key", named.alias("f")).select(
        "date_key", "store_key", "f.figure", *nothing, "f.amount"
    )


def day_counts(pos: DataFrame, orders: DataFrame, reservations: DataFrame) -> DataFrame:
    """The figures of the three facts, day by day."""
    completed = F.col("transaction_status") == "COMPLETED"
    status = F.col("reservation_status")
    figures = {f"{s.lower()}_reservations": F.count_if(status == s) for s in ("ACTIVE", "COLLECTED", "CANCELLED", "EXPIRED")}
    return union_all([
        _ids(pos.where(completed), "completed_pos_sales", "transaction_id"),
        _ids(orders, "online_orders", "order_id"),
        _amounts(pos.where(completed), pos_revenue=F.sum("line_amount")),
        _amounts(reservations, reservations=F.count(F.lit(1)), **figures),
    ])


def merged(days: DataFrame) -> DataFrame:
    """store_key, figure, value over all given rows; those that an earlier version published hold bitmaps of 4 KB."""
    either, bits = (F.bitmap_or_agg, F.bitmap_count) if dict(days.dtypes)["ids"] == "binary" else (F.bit_or, F.bit_count)
    ids = days.where(F.col("figure").isin(*DISTINCT)).groupBy("store_key", "figure", "prefix", "bucket")
    # an id without a number is one
    number = F.when(F.col("bucket").isNull(), F.lit(1).cast("long")).otherwise(bits("ids").cast("long"))
    distinct = ids.agg(either("ids").alias("ids")).groupBy("store_key", "figure").agg(
        F.sum(number).cast("decimal(38,2)").alias("value")
    )
    amounts = days.where(~F.col("figure").isin(*DISTINCT)).groupBy("store_key", "figure").agg(
        F.sum("amount").cast("decimal(38,2)").alias("value")
    )
    return distinct.unionByName(amounts)
