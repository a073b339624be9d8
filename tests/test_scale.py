"""Plans that have to hold on large and skewed data."""

import time

import pytest
from pyspark.sql import functions as F

from shelfwise.operators import cleaning, facts
from shelfwise.plans import quality, reports
from shelfwise.session import CLEAN_UP, store, store_counted

# Sizes that make a few thousand rows look like a skewed shuffle of a large table.
SMALL = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "32KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.shuffle.partitions": "16",
}


@pytest.fixture
def small_shuffles(spark):
    before = {key: spark.conf.get(key, None) for key in SMALL}
    for key, value in SMALL.items():
        spark.conf.set(key, value)
    yield
    for key, value in before.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_a_hot_product_is_split_while_cleaning(spark, small_shuffles, tmp_path):
    items = spark.range(0, 60_000, 1, 8).select(
        F.concat(F.lit("OI"), F.col("id").cast("string")).alias("order_item_id"),
        F.concat(F.lit("O"), (F.col("id") % 20_000).cast("string")).alias("order_id"),
        F.when(F.col("id") % 3 == 0, "P1").otherwise(F.concat(F.lit("P"), (F.col("id") % 500).cast("string"))).alias("product_id"),
        F.lit(1).alias("quantity"),
        F.lit("2.00").cast("decimal(10,2)").alias("unit_price"),
        F.lit("2.00").cast("decimal(10,2)").alias("line_amount"),
    )
    products = spark.range(500).select(F.concat(F.lit("P"), F.col("id").cast("string")).alias("product_id"))
    orders = spark.range(19_000).select(F.concat(F.lit("O"), F.col("id").cast("string")).alias("order_id"))
    key = lambda name: F.lit(1).cast("bigint").alias(name)
    products = products.select(F.col("product_id").alias("known_id"), key("product_key"))
    orders = orders.select(
        F.col("order_id").alias("known_id"), key("store_key"), key("customer_key"), F.lit(20250101).alias("date_key"),
        F.lit("CONFIRMED").alias("order_status"),
    )
    known = [store(products, f"{tmp_path}/products"), store(orders, f"{tmp_path}/orders")]
    tagged = cleaning.tag_order_items(items, *known)
    counts = {r.reject_reason: r["count"] for r in tagged.groupBy("reject_reason").count().collect()}
    assert counts == {None: 57_000, "Parent order missing": 3_000}
    tagged.write.format("noop").mode("overwrite").save()
    rows = tagged.collect()
    assert len(rows) == 60_000
    assert "skew=true" in plan_of(tagged)


def test_what_stores_bring_to_reservations_is_in_no_shuffle(spark, small_shuffles, tmp_path):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "8KB")
    text = lambda prefix, n: F.concat(F.lit(prefix), n.cast("string"))
    known = lambda prefix, rows, key: spark.range(rows).select(text(prefix, F.col("id")).alias("known_id"), F.col("id").alias(key))
    tables = [("P", 20_000, "product_key"), ("S", 3, "store_key"), ("O", 20_000, "customer_key")]
    products, stores, orders = (store(known(p, n, k).coalesce(1), f"{tmp_path}/{k}") for p, n, k in tables)
    holds = spark.range(900).select(
        text("R", F.col("id")).alias("reservation_id"), text("O", F.col("id") + 19_200).alias("order_id"),
        text("P", F.col("id") + 19_500).alias("product_id"), text("S", F.col("id") % 4).alias("store_id"),
        F.lit(" active").alias("reservation_status"),
    )
    tagged = cleaning.tag_reservations(holds, products, stores, orders)
    plan = plan_of(tagged)
    assert 0 < plan.index("BroadcastHashJoin") < plan.index("SortMergeJoin")
    for row in tagged.collect():
        n = int(row.reservation_id[1:])
        place = "Unknown product_id or store_id" if n >= 500 or n % 4 == 3 else None
        assert row.reject_reason == (place or ("Parent order missing" if n >= 800 else None))
        assert row.store_key == (n % 4 if n % 4 < 3 else None) and row.reservation_status == "ACTIVE"


def test_shuffles_are_compressed_with_zstandard(spark):
    assert spark.sparkContext.getConf().get("spark.io.compression.codec") == "zstd"


def test_shuffles_behind_a_stored_table_leave_the_disk(spark, tmp_path):
    blocks = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def shuffles():
        files = blocks.getAllFiles()
        names = {files.apply(i).getName() for i in range(files.size())}
        return {name for name in names if name.startswith("shuffle_")}

    before, setting = shuffles(), spark.conf.get(CLEAN_UP, None)
    counts = spark.range(0, 10_000, 1, 4).groupBy((F.col("id") % 100).alias("k")).count()
    stored, seen = store_counted(counts, f"{tmp_path}/counted", rows=F.count(F.lit(1)))
    again = store(stored.join(counts.select("k"), "k"), f"{tmp_path}/joined")
    # Spark removes them in the background
    for _ in range(100):
        if shuffles() <= before:
            break
        time.sleep(0.1)
    assert shuffles() <= before and spark.conf.get(CLEAN_UP, None) == setting
    assert seen == {"rows": 100} and again.count() == 100


def test_latest_snapshot_reads_one_date(spark, tmp_path):
    days = {}
    for day, rows in ((20250101, 10), (20250102, 7), (20250103, 0)):
        frame = spark.range(rows).select(
            F.col("id").alias("inventory_fact_key"), F.col("id").alias("product_key"), F.lit(1).cast("bigint").alias("store_key"),
            F.lit(day).alias("date_key"), F.lit(1).alias("on_hand_quantity"), F.lit(0).alias("reserved_quantity"),
            F.lit(1).alias("available_to_sell"),
        )
        days[day] = facts.write_snapshot_day(frame, f"{tmp_path}/{day}")
    latest = reports.latest_snapshot({"latest_snapshot": facts.latest_day(spark, days)})
    assert latest.count() == 7
    assert {path.split("/")[-2] for path in latest.inputFiles()} == {"20250102"}
    assert facts.snapshot_history(spark, days).count() == 17


def test_rules_scan_each_table_twice(spark):
    from fixtures import clean_rows, linked

    tables = linked(spark, clean_rows())
    plan = plan_of(quality.violations(tables))
    scans = plan.count("Scan ExistingRDD") + plan.count("LocalTableScan")
    # one scan of each table for its rows and one for its keys, and the list of rules
    assert scans <= 2 * len(tables) + 1
    # all keys and references meet in one shuffle
    assert plan.count("Exchange hashpartitioning") == 1


def test_keys_of_several_texts_are_told_apart(spark):
    rows = [("1", "a", "b/c"), ("2", "a/b", "c"), ("3", "a", "b/c"), ("4", None, "c"), ("5", None, "c")]
    pairs = spark.createDataFrame(rows, "inventory_id string, product_id string, store_id string")
    moved = spark.createDataFrame([("m1", "a", "b/c"), ("m2", "a/b/", "c"), ("m3", "x", None)], "movement_id string, product_id string, store_id string")
    found = quality.key_violations({"inventory.inventory": pairs, "inventory.inventory_movement": moved}).collect()
    assert sorted(tuple(r) for r in found) == [
        ("inventory.inventory", "UNIQUE (product_id, store_id)", "a/b/c"),
        ("inventory.inventory_movement", "(product_id, store_id) REFERENCES inventory.inventory", "a/b//c"),
    ]


@pytest.mark.parametrize("unknown", [[], [0], [-7, 32_768, 32_769, 70_001, 10**12]])
def test_surrogate_references_travel_as_bitmaps(spark, unknown):
    known = spark.range(1, 70_001).select(F.col("id").alias("product_key"))
    used = spark.range(0, 300_000, 1, 4).select((F.col("id") % 32_767 + 1).alias("product_key"))
    used = used.union(spark.createDataFrame([(k,) for k in [*unknown, *unknown]] + [(None,)], "product_key long"))
    known = known.where(~F.col("product_key").isin([k for k in unknown if k <= 70_000] or [-1]))
    tables = {"fact_pos_activity": used, "dim_product": known}
    found = quality.surrogate_violations(tables)
    assert sorted(int(r.record_id) for r in found.collect()) == unknown
    bits = quality.key_bitmaps(used.where("product_key <= 70000 and product_key > 0"), ["product_key"])
    rows = bits.collect()
    # however many rows there are: a bitmap per 32,768 keys of the dimension
    assert len(rows) <= 3 and all(len(r["keys"]) == 4096 for r in rows)


def test_status_check_reads_only_the_status(spark, tmp_path):
    from fixtures import clean_rows, linked
    from shelfwise.sources.linked import bad_status

    tables = {}
    for name, df in linked(spark, clean_rows()).items():
        df.write.parquet(f"{tmp_path}/{name}")
        tables[name] = spark.read.parquet(f"{tmp_path}/{name}")
    plan = plan_of(bad_status(tables))
    assert "ReadSchema: struct<order_status:string>" in plan
    assert "ReadSchema: struct<reservation_status:string>" in plan


def test_checks_shuffle_what_they_count_and_read_stock_once(spark, tmp_path):
    from fixtures import faulty_rows, linked
    from shelfwise.plans.warehouse import Warehouse
    from test_publish import RUN

    sources = linked(spark, faulty_rows())
    dw = Warehouse(spark, sources, RUN, str(tmp_path))
    stock = sources["inventory.inventory"]
    summed = stock.groupBy("product_id", "store_id").agg(*[F.max_by(c, "updated_at").alias(c) for c in stock.columns if c not in ("product_id", "store_id")])
    view = {**sources, "inventory.inventory": summed.select(*stock.columns)}
    checks = quality.qa_checks(dw, view)
    assert "max_by" not in plan_of(checks)
    assert sorted(map(tuple, checks.collect())) == sorted(map(tuple, quality.qa_checks(dw, sources).collect()))
    plan = plan_of(quality.stock_against_activity(dw))
    assert "(reservation_status" in plan and "Filter" in plan and "CANCELLED)" in plan
    booked = {(r.product_key, r.store_key): r for r in quality.stock_against_activity(dw).collect()}
    assert len(booked) == dw["latest_snapshot"].count()
    assert sum(r.active_holds or 0 for r in booked.values()) == 2 and sum(r.cancelled_holds or 0 for r in booked.values()) == 1
    assert sum(r.blocked_reserved or 0 for r in booked.values()) == 1 and sum(r.out_of_stock or 0 for r in booked.values()) == 1
