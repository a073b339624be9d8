"""Row counts and key bounds of parquet tables from their footers: no column is read.

Spark pushes COUNT, MIN and MAX into the footers where a table is read by its newer parquet reader and nothing stands between
scan and aggregate. The tables of a load are read by the usual one, which has bucketing and partition discovery, so the
newer one is asked for here alone. Bounds are those of whole numbers and dates in columns without nulls; a file
whose footer has no bounds (all values null, text cut short) makes Spark raise instead of answering wrongly.
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

_USUAL = "spark.sql.sources.useV1SourceList"
_PUSH = "spark.sql.parquet.aggregatePushdown"


def footer_table(spark: SparkSession, path: str) -> DataFrame:
    """A table whose plain aggregates come from footers."""
    usual = spark.conf.get(_USUAL)
    spark.conf.set(_PUSH, "true")  # read when a query is planned; no other reader knows it
    try:
        spark.conf.set(_USUAL, ",".join(name for name in usual.split(",") if name != "parquet"))
        return spark.read.parquet(path)
    finally:
        spark.conf.set(_USUAL, usual)


def _rows() -> Column:
    """Without a footer there is nothing to add up, so files without rows leave NULL, which COUNT itself never is."""
    return F.when(F.col("row_count") > 0, F.col("row_count")).otherwise(F.lit(0).cast("bigint")).alias("row_count")


def row_counts(spark: SparkSession, paths: Mapping[str, str]) -> DataFrame:
    """table_name, row_count"""
    counts = [
        footer_table(spark, path).agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("table_name"), _rows())
        for name, path in paths.items()
    ]
    return reduce(DataFrame.unionByName, counts)


def key_bounds(spark: SparkSession, paths: Mapping[str, str], keys: Mapping[str, str]) -> DataFrame:
    """table_name, row_count, least_key, greatest_key, of tables with a whole number as key; no bounds of no rows."""
    bounds = [
        footer_table(spark, path)
        .agg(F.count(F.lit(1)).alias("row_count"), F.min(keys[name]).alias("least"), F.max(keys[name]).alias("greatest"))
        .select(
            F.lit(name).alias("table_name"),
            _rows(),
            F.col("least").cast("bigint").alias("least_key"),
            F.col("greatest").cast("bigint").alias("greatest_key"),
        )
        for name, path in paths.items()
    ]
    return reduce(DataFrame.unionByName, bounds)
