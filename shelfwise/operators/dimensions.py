"""Dimension loads: calendar days and upserts that keep surrogate keys stable."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from shelfwise.functions.retail import date_key
from shelfwise.operators.keys import number_rows, require_unique
from shelfwise.sources.linked import union_all

SCHEMAS = {
    "dim_date": "date_key int, full_date date, day int, month string, quarter string, year int, day_of_week string",
    "dim_product": "product_key bigint, product_id string, sku string, product_name string, category string, "
    "unit_price decimal(10,2)",
    "dim_store": "store_key bigint, store_id string, store_name string, location string",
    "dim_customer": "customer_key bigint, customer_id string, customer_name string",
}
# dimension -> cleaned table it is loaded from
DIMENSION_SOURCE = {"dim_product": "stg_products", "dim_store": "stg_stores", "dim_customer": "stg_customers"}


def empty(spark: SparkSession, name: str) -> DataFrame:
    return spark.createDataFrame([], SCHEMAS[name])


def calendar(day: Column | str) -> list[Column]:
    day = F.col(day) if isinstance(day, str) else day
    return [
        date_key(day).alias("date_key"),
        day.alias("full_date"),
        F.dayofmonth(day).alias("day"),
        F.date_format(day, "MMMM").alias("month"),
        F.concat(F.lit("Q"), F.quarter(day).cast("string")).alias("quarter"),
        F.year(day).alias("year"),
        F.date_format(day, "EEEE").alias("day_of_week"),
    ]


def date_range(clean: dict[str, DataFrame], run_date: date) -> DataFrame:
    """Every day from the earliest to the latest source date, widened to hold the run date."""
    stamps = {
        "stg_pos_transactions": "transaction_timestamp",
        "stg_online_orders": "created_at",
        "stg_reservations": "created_at",
        "stg_inventory": "updated_at",
    }
    ends = union_all(
        clean[name].agg(F.min(F.to_date(c)).alias("lo"), F.max(F.to_date(c)).alias("hi")) for name, c in stamps.items()
    )
    run = F.lit(run_date)
    bounds = ends.agg(F.least(F.min("lo"), run).alias("lo"), F.greatest(F.max("hi"), run).alias("hi"))
    return bounds.select(F.explode(F.sequence("lo", "hi", F.expr("INTERVAL 1 DAY"))).alias("d")).select(*calendar("d"))


def new_dates(existing: DataFrame, incoming: DataFrame) -> DataFrame:
    """Days to append; days that are already loaded stay as they are."""
    return incoming.join(existing, "date_key", "left_anti")


def upsert(existing: DataFrame, incoming: DataFrame, name: str) -> DataFrame:
    """Insert or overwrite by natural key; rows missing from ``incoming`` and all keys are kept."""
    key, natural, *attributes = existing.columns
    incoming = incoming.select(natural, *attributes)
    require_unique(incoming, [natural], name)
    arriving = incoming.select(natural, F.struct(*attributes).alias("arriving"))
    loaded = existing.select(natural, key, F.struct(*attributes).alias("loaded"))
    merged = loaded.join(arriving, natural, "full_outer").select(
        key,
        natural,
        *[
            F.when(F.col("arriving").isNotNull(), F.col(f"arriving.{a}")).otherwise(F.col(f"loaded.{a}")).alias(a)
            for a in attributes
        ],
    )
    highest = existing.agg(F.coalesce(F.max(key), F.lit(0))).first()[0]
    fresh = number_rows(merged.where(F.col(key).isNull()).drop(key), [natural], key, highest)
    return merged.where(F.col(key).isNotNull()).unionByName(fresh)
