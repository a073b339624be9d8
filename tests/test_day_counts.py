"""Counts per day, merged over days, against counting again."""

import random
from datetime import date
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from fixtures import clean_rows, linked
from shelfwise.operators import day_counts
from shelfwise.plans import load, reports
from test_publish import RUN

IDS = ["T1", "T01", "T001", "T70", "T0070", "T32768", "T32769", "T65536", "T999999999999999999", "T1000000000000000000", "T10000000000000000005", "70", "0", "", "T", "T1x", "U70", "T00"]


def facts_of(spark, seed):
    random_ = random.Random(seed)
    lines = [(random_.choice(IDS + [f"T{i}" for i in range(60)] + [None]), random_.randint(1, 4), random_.choice([20250101, 20250102, 20250103, 20250201]),
              Decimal(random_.randint(0, 900)) / 100, random_.choice(["COMPLETED", "BLOCKED"]), random_.choice(["ACTIVE", "EXPIRED", "CANCELLED", "COLLECTED", None])) for _ in range(400)]
    rows = spark.createDataFrame(lines, "transaction_id string, store_key bigint, date_key int, line_amount decimal(10,2), transaction_status string, reservation_status string")
    return {
        "fact_pos_activity": rows, "fact_online_order": rows.withColumnRenamed("transaction_id", "order_id"), "fact_reservation": rows,
        "dim_store": spark.createDataFrame([(k, f"store {k}") for k in range(1, 6)], "store_key bigint, store_name string"),
    }


@pytest.mark.parametrize("days", [[20250101, 20250102, 20250103, 20250201], [20250102], [20250101, 20250201], []])
def test_merged_days_equal_a_recount(spark, days):
    tables = facts_of(spark, len(days))
    counted = day_counts.day_counts(*[tables[n] for n in ("fact_pos_activity", "fact_online_order", "fact_reservation")])
    kept = lambda df: df.where(F.col("date_key").isin(days)) if days else df.where("false")
    again = {n: kept(df) if n.startswith("fact") else df for n, df in tables.items()}
    assert reports.omnichannel_from_days(tables["dim_store"], kept(counted)).collect() == reports.omnichannel_performance(again).collect()


def test_a_load_keeps_counts_of_its_days(spark, tmp_path):
    published = load.run(spark, linked(spark, clean_rows()), str(tmp_path), RUN)
    assert published.omnichannel().collect() == reports.omnichannel_performance(published).collect()
    assert published.omnichannel(date(2025, 5, 10), date(2025, 5, 10)).collect() == published.omnichannel().collect()
    assert {r.online_orders for r in published.omnichannel(date(2025, 5, 11)).collect()} == {0}
    plan = published.omnichannel(date(2025, 5, 11))._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(date_key,20250511)" in plan and "fact_" not in plan


def test_scattered_ids_take_a_word_each(spark):
    # 3,000 sales, one a day and store, far apart: nothing is kept beside them
    sales = spark.range(3_000).select(
        F.concat(F.lit("T"), (F.col("id") * 40_000 + 7).cast("string")).alias("transaction_id"), (F.col("id") % 5).alias("store_key"),
        (F.col("id") + 1).cast("int").alias("date_key"), F.lit(1).cast("decimal(10,2)").alias("line_amount"), F.lit("COMPLETED").alias("transaction_status"),
    )
    words = day_counts._ids(sales, "completed_pos_sales", "transaction_id")
    assert dict(words.dtypes)["ids"] == "bigint" and words.count() == 3_000
    assert {r.value for r in day_counts.merged(words).collect()} == {600}
    neighbours = sales.withColumns({"transaction_id": F.concat(F.lit("T"), (F.col("date_key") + 63).cast("string")), "date_key": F.lit(1), "store_key": F.lit(1).cast("long")})
    packed = day_counts._ids(neighbours, "completed_pos_sales", "transaction_id")
    assert packed.count() == 47 and [r.value for r in day_counts.merged(packed).collect()] == [3_000]


def test_bitmaps_of_an_earlier_version_still_merge(spark):
    rows = [(day, 1, "online_orders", "O", 1, number) for day in (1, 2) for number in (day, 5, 32_768)] + [(1, 1, "online_orders", "Ox", None, None)]
    days = spark.createDataFrame(rows, "date_key int, store_key bigint, figure string, prefix string, bucket bigint, number bigint")
    days = days.groupBy("date_key", "store_key", "figure", "prefix", "bucket").agg(F.bitmap_construct_agg(F.bitmap_bit_position("number")).alias("ids"))
    days = days.withColumn("amount", F.lit(None).cast("decimal(38,2)"))
    assert [tuple(r) for r in day_counts.merged(days).collect()] == [(1, "online_orders", Decimal("5.00"))]
