"""Linking source systems and checking them against the agreed contract."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F

from shelfwise.functions.retail import standard_word
from shelfwise.session import qualified
from shelfwise.sources.schemas import ORDER_STATUSES, POS_REASONS, POS_STATUSES, RESERVATION_STATUSES, SOURCES

Linked = dict[str, DataFrame]


def link_folder(spark: SparkSession, folder: str) -> Linked:
    """Every parquet table found as ``folder/<schema>/<table>``; ``contract_check`` tells what is missing.

    Files are listed, not opened; Spark lists large folders on the executors.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet")
    try:
        paths = files.load(folder).select("path")
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return {}
        raise
    root = qualified(spark, folder)[1].toString().rstrip("/") + "/"
    parts = F.split(F.regexp_replace(F.substr("path", F.lit(len(root) + 1)), "^/+", ""), "/")
    tables = paths.where(F.size(parts) > 2).select(F.concat_ws(".", F.get(parts, F.lit(0)), F.get(parts, F.lit(1))).alias("name")).distinct()
    # one row per table
    names = sorted(row["name"] for row in tables.collect())
    return {name: spark.read.parquet(f"{folder}/{name.replace('.', '/')}") for name in names}


def link_jdbc(spark: SparkSession, urls: dict[str, str], splits: dict[str, dict] | None = None, **options: str) -> Linked:
    """Source tables read over JDBC, one URL per schema.

    ``splits`` gives the partitioned-read options of a table (``partitionColumn``, ``lowerBound``,
    ``upperBound``, ``numPartitions``); without them Spark reads the table in one task.
    """
    linked = {}
    for name in SOURCES:
        schema, table = name.split(".")
        reader = spark.read.format("jdbc").options(url=urls[schema], dbtable=table, **options)
        linked[name] = reader.options(**(splits or {}).get(name, {})).load()
    return linked


def union_all(frames: Iterable[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def row_counts(tables: Linked, label: str = "source_table") -> DataFrame:
    return union_all(df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias(label), "row_count") for name, df in tables.items())


def link_summary(linked: Linked) -> DataFrame:
    """Per source schema: which tables were linked and how many rows they hold together."""
    counted = row_counts(linked).withColumn("source", F.split_part("source_table", F.lit("."), F.lit(1)))
    name = F.split_part("source_table", F.lit("."), F.lit(2))
    return (
        counted.groupBy("source")
        .agg(
            F.count(F.lit(1)).alias("tables_linked"),
            F.array_join(F.array_sort(F.collect_list(name)), ", ").alias("tables"),
            F.sum("row_count").alias("total_rows"),
        )
        .orderBy("source")
    )


def contract_check(spark: SparkSession, linked: Linked) -> DataFrame:
    """Expected columns that the linked tables lack; no rows means that the sources match.

    ``rows_affected`` is the number of rows in the table whose column is missing.
    """
    expected = spark.createDataFrame(
        [(*name.split("."), f.name) for name, schema in SOURCES.items() for f in schema.fields],
        "table_schema string, table_name string, column_name string",
    )
    found = spark.createDataFrame(
        [(*name.split("."), column) for name, df in linked.items() for column in df.columns],
        "table_schema string, table_name string, column_name string",
    )
    homes = found.groupBy("table_name").agg(
        F.array_join(F.array_sort(F.collect_set("table_schema")), ", ").alias("found_this_table_in_schema")
    )
    expected_only = {name: df for name, df in linked.items() if name in SOURCES}
    none = spark.createDataFrame([], "source_table string, row_count bigint")
    counts = row_counts(expected_only) if expected_only else none
    counts = counts.withColumnRenamed("source_table", "expected_table")
    missing = expected.join(found, ["table_schema", "table_name", "column_name"], "left_anti")
    return (
        missing.withColumn("expected_table", F.concat_ws(".", "table_schema", "table_name"))
        .join(counts, "expected_table", "left")
        .join(homes, "table_name", "left")
        .select(
            F.when(F.col("row_count").isNull(), "MISSING TABLE").otherwise("MISSING COLUMN").alias("problem"),
            "expected_table",
            F.col("column_name").alias("expected_column"),
            "found_this_table_in_schema",
            F.coalesce("row_count", F.lit(0)).alias("rows_affected"),
        )
        .orderBy("problem", "expected_table", "expected_column")
    )


def bad_status(linked: Linked) -> DataFrame:
    """Status words outside the agreed lists, as written in the source. NULL is not reported."""
    fields = (
        ("pos.pos_transaction", "transaction_status", POS_STATUSES),
        ("pos.pos_transaction", "rejection_reason", POS_REASONS),
        ("ecommerce.online_order", "order_status", ORDER_STATUSES),
        ("ecommerce.reservation", "reservation_status", RESERVATION_STATUSES),
    )
    return union_all(
        linked[table]
        .where(~standard_word(column).isin(*words))
        .groupBy(F.col(column).alias("value"))
        .agg(F.count(F.lit(1)).alias("row_count"))
        .select(F.lit("BAD STATUS").alias("problem"), F.lit(f"{table.split('.')[0]}.{column}").alias("field"), "value", "row_count")
        for table, column, words in fields
    )
