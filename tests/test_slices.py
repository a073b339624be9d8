"""How requests reach their slices: numbered in place, and without a second shuffle for hot and cold pairs."""

from datetime import datetime, timedelta

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from shelfwise.operators import stock
from shelfwise.operators.shelf import Shelf
from shelfwise.plans.warehouse import Run, Warehouse

START = datetime(2025, 1, 1)


def hold(pair, n):
    return f"H{pair}-{n}", START + timedelta(minutes=n), "RESERVE", f"P{pair}", "S001", 1, f"R{pair}-{n}"


def frames(spark, sizes):
    requests = [hold(pair, n) for pair, rows in sizes.items() for n in range(rows)]
    schema = "request_id string, request_ts timestamp, kind string, product_id string, store_id string, quantity int, reference string"
    shelves = [(f"P{pair}", "S001", 5, 0) for pair in sizes]
    inventory = spark.createDataFrame(shelves, "product_id string, store_id string, on_hand_quantity int, reserved_quantity int")
    return spark.createDataFrame(requests, schema), inventory


def test_requests_know_whether_their_pair_is_hot(spark):
    requests, inventory = frames(spark, {1: 12, 2: 2, 3: 3})
    decided = stock.adjudicate(requests, inventory, slice_rows=3)
    plan = decided._jdf.queryExecution().optimizedPlan().toString()
    assert "LeftAnti" not in plan
    served = {r.product_id: (r.n, r.served) for r in decided.groupBy("product_id").agg(
        F.count("*").alias("n"), F.count_if("success").alias("served")).collect()}
    assert served == {"P1": (12, 5), "P2": (2, 2), "P3": (3, 3)}


def test_only_pairs_that_go_on_keep_their_ledger(spark, monkeypatch):
    written = {}
    real = stock.store
    monkeypatch.setattr(stock, "store", lambda df, path, *a: written.setdefault(path.rsplit("/", 1)[1], real(df, path, *a)))
    requests, inventory = frames(spark, {1: 12, 2: 70})
    # free stock never runs out for the first pair, and the other one is tried slice by slice
    inventory = inventory.withColumn("on_hand_quantity", F.when(F.col("product_id") == "P1", 100).otherwise(5))
    back = requests.where("product_id = 'P2'").withColumns({
        "request_id": F.concat(F.lit("L"), "request_id"), "kind": F.lit("RELEASE"),
        "request_ts": F.col("request_ts") + F.expr("INTERVAL 150 SECONDS"),
    })
    decided = stock.adjudicate(requests.unionByName(back), inventory, slice_rows=3)
    assert decided.count() == 12 + 140
    later = [df for name, df in written.items() if name.startswith("ledger-") and name != "ledger-0"]
    assert later and all(df.where("product_id = 'P1'").isEmpty() for df in later)


@pytest.mark.parametrize("with_ledger", [False, True])
def test_a_few_short_slices_are_walked_in_one_wave(spark, monkeypatch, with_ledger):
    """A scarce shelf whose goods come back: every slice depends on the one before."""
    written, real = [], stock.store
    monkeypatch.setattr(stock, "store", lambda df, path, *a: written.append(path.rsplit("/", 1)[1]) or real(df, path, *a))
    requests, inventory = frames(spark, {1: 6, 2: 6, 3: 2})
    back = requests.where("product_id <> 'P3'").withColumns({
        "request_id": F.concat(F.lit("L"), "request_id"), "kind": F.lit("RELEASE"),
        "request_ts": F.col("request_ts") + F.expr("INTERVAL 150 SECONDS"),
    })
    inventory = inventory.withColumn("on_hand_quantity", F.lit(2))
    # what is booked already is neither booked again nor counted twice
    booked = [("P1", "S001", "ONLINE_RESERVATION", -1, "ECOMMERCE", "R1-1")] if with_ledger else []
    schema = "product_id string, store_id string, movement_type string, quantity_change int, source_system string, source_reference_id string"
    ledger = spark.createDataFrame(booked, schema) if with_ledger else None
    decided = stock.adjudicate(requests.unionByName(back), inventory, ledger, slice_rows=3).collect()
    assert len(decided) == 26
    assert [name for name in written if name.startswith("decided-")] == ["decided-0"]
    shelves, ledgers = {pair: Shelf(2, 0) for pair in ("P1", "P2", "P3")}, {"R1-1": (1, 1, False, None)} if with_ledger else {}
    for row in sorted(decided, key=lambda r: (r.request_ts, r.request_id)):
        shelf = shelves[row.product_id]
        if row.reference in ledgers and row.product_id == "P1":
            shelf.learn(row.reference, *ledgers[row.reference])
        expected = shelf.decide(row.kind, row.quantity, row.reference)
        assert (row.success, row.reason, row.error, row.applied) == (expected.success, expected.reason, expected.error, expected.applied)


def test_runs_number_rows_across_batches():
    batch = lambda *pairs: pa.RecordBatch.from_arrays([pa.array([p for p, _ in pairs]), pa.array([s for _, s in pairs])], names=stock.PAIR)
    batches = [batch(("a", "x"), ("a", "x"), ("a", "y")), batch(("a", "y"), ("a", "y")), batch(), batch(("a", "y"), ("b", "y"), ("b", "y"))]
    found = [b.column("_nth").to_pylist() for b in stock._runs(iter(batches[:2] + batches[3:]))]
    assert found == [[0, 1, 0], [1, 2], [3, 0, 1]]


def test_line_tables_are_compressed_with_zstandard_and_lookups_as_before(spark, tmp_path):
    dw = Warehouse(spark, {}, Run(START.date(), START), str(tmp_path))
    ids = spark.range(1_000).select(F.concat(F.lit("OI-"), F.col("id").cast("string")).alias("order_item_id"))
    for name in ("tagged_stg_order_items", "known_stg_products"):
        assert dw._write(name, ids).count() == 1_000
    codecs = {name: {".zstd." in f.name for f in (tmp_path / "work" / name).glob("*.parquet")} for name in dw._written}
    assert codecs == {"tagged_stg_order_items": {True}, "known_stg_products": {False}}
