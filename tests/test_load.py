"""Cleaning, dimension keys, facts and publishing on small invented tables."""

from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from fixtures import DAY, EXPECTED_REJECTS, clean_rows, faulty_rows, linked
from shelfwise.operators import cleaning, dimensions
from shelfwise.operators.keys import number_rows
from shelfwise.plans import load, quality, reports
from shelfwise.plans.warehouse import Run, Warehouse, latest_log
from shelfwise.sources.linked import bad_status, contract_check, link_folder, link_summary
from shelfwise.sources.schemas import STAGED

RUN = Run(date(2025, 5, 12), datetime(2025, 5, 12, 4))


@pytest.fixture(scope="module")
def faulty(spark, tmp_path_factory):
    return Warehouse(spark, linked(spark, faulty_rows()), RUN, str(tmp_path_factory.mktemp("faulty")))


def test_every_fault_is_logged_once(faulty):
    log = sorted((tuple(r) for r in faulty.reject_log().collect()), key=str)
    assert log == sorted(EXPECTED_REJECTS, key=str)


def test_a_log_alone_carries_no_more_than_it_needs(spark, tmp_path):
    dw = Warehouse(spark, linked(spark, faulty_rows()), RUN, str(tmp_path))
    log = dw.reject_log(alone=True)
    assert sorted((tuple(r) for r in log.collect()), key=str) == sorted(EXPECTED_REJECTS, key=str)
    lines = {"tagged_stg_reservations", "tagged_stg_order_items", "tagged_stg_pos_items", "tagged_stg_inventory"}
    assert lines.isdisjoint(dw._written) and {"tagged_stg_online_orders", "tagged_stg_customers"} <= set(dw._written)
    steps = log._jdf.queryExecution().optimizedPlan().toString().splitlines()
    steps = [step for step in steps if "LogicalRDD" not in step and "Relation" not in step]
    assert any("Join LeftOuter" in step for step in steps)
    assert not any(column in step for step in steps for column in ("expires_at", "line_amount", "product_key"))
    # what is written already is what the log describes
    dw.tagged("stg_reservations")
    assert "/tagged_stg_reservations" in "".join(dw.reject_log(alone=True).inputFiles())


def test_kept_and_rejected_rows_add_up(faulty):
    for name in STAGED:
        rejected = cleaning.rejects(name, faulty.tagged(name)).count()
        assert faulty[name].count() + rejected == faulty.staged(name).count(), name


def test_cleaned_words_and_amounts(faulty):
    tills = {r.transaction_id: (r.transaction_status, r.rejection_reason) for r in faulty["stg_pos_transactions"].collect()}
    assert tills == {
        "T001": ("COMPLETED", None),
        "T002": ("BLOCKED", "RESERVED_STOCK"),
        "T012": ("COMPLETED", None),
        "T013": ("BLOCKED", "OUT_OF_STOCK"),
    }
    item = faulty["stg_order_items"].where("order_item_id = 'OI015'").first()
    assert (item.quantity, item.line_amount) == (0, Decimal("0.00"))


def test_very_many_copies_become_log_rows(spark, monkeypatch):
    monkeypatch.setattr(cleaning, "COPIES_PER_RECORD", 7)
    copies = spark.range(100).select(
        F.lit("C1").alias("customer_id"), F.lit("Ann").alias("customer_name"), F.lit("a@x").alias("email"),
        F.lit("ECOMMERCE").alias("source_system"), F.lit(DAY).alias("extracted_at"),
    )
    tagged = cleaning.tag_customers(copies)
    assert cleaning.kept("stg_customers", tagged).count() == 1
    assert cleaning.rejects("stg_customers", tagged).count() == 99


def test_bad_words_are_listed_as_written(spark):
    found = {(r.field, r.value): r.row_count for r in bad_status(linked(spark, faulty_rows())).collect()}
    assert found == {
        ("pos.transaction_status", "pending"): 1,
        ("pos.transaction_status", " approved "): 1,
        ("pos.transaction_status", "Rejected"): 1,
    }


def test_contract_and_link_summary(spark):
    tables = linked(spark, clean_rows())
    assert contract_check(spark, tables).count() == 0
    assert [tuple(r) for r in link_summary(tables).collect()][2] == ("pos", 2, "pos_transaction, pos_transaction_item", 4)
    tables["ecommerce.inventory"] = tables.pop("inventory.inventory")
    tables["pos.pos_transaction"] = tables["pos.pos_transaction"].drop("store_id")
    problems = contract_check(spark, tables).collect()
    assert tuple(problems[0]) == ("MISSING COLUMN", "pos.pos_transaction", "store_id", "pos", 2)
    assert {(r.problem, r.found_this_table_in_schema, r.rows_affected) for r in problems[1:]} == {("MISSING TABLE", "ecommerce", 0)}
    assert len(problems) == 8


def test_rows_are_numbered_without_gaps(spark):
    rows = spark.range(1000).select(F.concat(F.lit("K"), (F.col("id") * 7919 % 1000).cast("string")).alias("k"))
    numbered = number_rows(rows, ["k"], "n", 50).orderBy("k").collect()
    assert [r.n for r in numbered] == list(range(51, 1051))


def stores(spark, rows):
    return spark.createDataFrame(rows, "store_id string, store_name string, location string")


def test_upsert_keeps_keys_and_retired_rows(spark):
    first = dimensions.upsert(dimensions.empty(spark, "dim_store"), stores(spark, [("S2", "b", "x"), ("S9", "z", "x")]), "dim_store")
    second = dimensions.upsert(first, stores(spark, [("S2", "B", None), ("S1", "a", "y"), ("S3", "c", "y")]), "dim_store")
    assert sorted(tuple(r) for r in second.collect()) == [
        (1, "S2", "B", None),
        (2, "S9", "z", "x"),
        (3, "S1", "a", "y"),
        (4, "S3", "c", "y"),
    ]


def test_upsert_refuses_repeated_keys(spark):
    with pytest.raises(ValueError, match="store_id must be unique"):
        dimensions.upsert(dimensions.empty(spark, "dim_store"), stores(spark, [("S1", "a", "x"), ("S1", "b", "x")]), "dim_store")


def test_calendar_reaches_from_first_event_to_run_date(faulty):
    days = faulty["dim_date"].orderBy("date_key").collect()
    assert [r.date_key for r in days] == [20250510, 20250511, 20250512]
    assert tuple(days[0]) == (20250510, date(2025, 5, 10), 10, "May", "Q2", 2025, "Saturday")


@pytest.fixture(scope="module")
def published(spark, tmp_path_factory):
    """Two runs on one day and a third two days later with changed stock."""
    out = str(tmp_path_factory.mktemp("warehouse"))
    tables = linked(spark, clean_rows())
    runs = [load.run(spark, tables, out, RUN), load.run(spark, tables, out, RUN)]
    rows = clean_rows()
    rows["inventory.product"] = [("P000", "SKU-0", "Tin Cup", "Kitchen", Decimal("3.00"), True), *rows["inventory.product"]]
    rows["inventory.inventory"][2] = ("I003", "P001", "S002", 6, 0, 6, DAY)
    runs.append(load.run(spark, linked(spark, rows), out, Run(date(2025, 5, 14), datetime(2025, 5, 14, 4))))
    return out, runs


FACTS = ("fact_pos_activity", "fact_online_order", "fact_reservation")


def contents(df):
    return sorted(map(str, df.drop(*[c for c in df.columns if c.endswith("fact_key")]).collect()))


def test_a_second_run_changes_nothing_but_the_log(spark, published):
    out, (first, second, _) = published
    for name in (*load.DIMENSIONS, *FACTS, "qa_checks"):
        assert contents(first[name]) == contents(second[name]), name
    assert [v["etl_run_log"].count() for v in (first, second)] == [8, 16]
    assert second["etl_run_log"].where("run_id between 200 and 299 and step = 'DIM_DATE'").first().rows_affected == 0
    assert {r.run_id for r in latest_log(second["etl_run_log"]).collect()} == set(range(201, 209))
    assert load.current(spark, out).version == 3


def test_snapshot_history_is_kept(published):
    _, (*_, third) = published
    history = third["fact_inventory_snapshot"]
    assert {r.date_key: r["count"] for r in history.groupBy("date_key").count().collect()} == {20250512: 3, 20250514: 3}
    latest = reports.latest_snapshot(third)
    assert latest.agg(F.sum("on_hand_quantity")).first()[0] == 13


def test_new_product_does_not_move_old_keys(published):
    _, (first, _, third) = published
    keys = lambda version: {r.product_id: r.product_key for r in version["dim_product"].collect()}
    assert keys(third) == {**keys(first), "P000": 4}


def test_scoreboard_passes_on_clean_data(published):
    _, (first, *_) = published
    board = first["qa_scoreboard"].orderBy("item").collect()
    assert [(r.item, r.result, r.tests_passed, r.failed_tests) for r in board] == [
        (1, "PASS", "2 of 2", ""), (2, "PASS", "3 of 3", ""), (3, "PASS", "4 of 4", ""), (4, "PASS", "1 of 1", ""),
        (5, "PASS", "4 of 4", ""), (6, "PASS", "5 of 5", ""), (7, "PASS", "1 of 1", ""), (8, "PASS", "2 of 2", ""),
    ]


def test_reports_on_clean_data(published):
    _, (first, *_) = published
    assert [tuple(r) for r in reports.omnichannel_performance(first).collect()] == [
        ("Harbour", 0, 2, 2, 2, 0, 0, 0, Decimal("0.00")),
        ("Mill Lane", 1, 1, 1, 0, 0, 1, 0, Decimal("12.50")),
    ]
    assert [tuple(r) for r in reports.last_unit_conflicts(first).collect()] == [("Harbour", "Paper Lamp", 2, 2, 1, 0, 1)]
    assert [r.transaction_id for r in reports.pos_conflicts(first).collect()] == ["T002"]
    assert reports.out_of_stock_warning(first).count() == 0


def test_faulty_data_fails_the_right_tests(faulty):
    failed = {r.n for r in quality.qa_checks(faulty, faulty.linked).where("ok is null or not ok").collect()}
    assert failed == {8, 9, 18}


def test_broken_constraints_stop_before_publishing(spark, tmp_path):
    rows = clean_rows()
    rows["ecommerce.order_item"].append(("OI099", "O001", "P001", None, Decimal("1.00"), None))
    rows["ecommerce.order_item"].append(rows["ecommerce.order_item"][2])
    rows["ecommerce.reservation"].append(("R099", "O001", "P001", "S001", 1, None, DAY, None, None))
    warehouse = Warehouse(spark, linked(spark, rows), RUN, f"{tmp_path}/tables")
    broken = {(r.rule, r.record_id) for r in quality.violations({n: warehouse[n] for n in FACTS}).collect()}
    assert broken == {
        ("quantity IS NOT NULL", "OI099"),
        ("line_amount IS NOT NULL", "OI099"),
        ("UNIQUE (order_item_id)", "OI003"),
        ("reservation_status IS NOT NULL", "R099"),
    }
    with pytest.raises(load.LoadError):
        load.run(spark, linked(spark, rows), f"{tmp_path}/out", RUN)
    assert load.current(spark, f"{tmp_path}/out") is None


def test_repeated_order_ids_stop_the_load(spark, tmp_path):
    rows = clean_rows()
    rows["ecommerce.online_order"].append(rows["ecommerce.online_order"][0])
    with pytest.raises(ValueError, match="stg_online_orders: known_id must be unique"):
        load.run(spark, linked(spark, rows), f"{tmp_path}/out", RUN)
    assert load.current(spark, f"{tmp_path}/out") is None


def test_linked_folders_are_read_as_they_are(spark, tmp_path):
    for name, df in linked(spark, clean_rows()).items():
        df.write.parquet(f"{tmp_path}/{name.replace('.', '/')}")
    tables = link_folder(spark, str(tmp_path))
    assert contract_check(spark, tables).count() == 0
    assert tables["ecommerce.order_item"].where("product_id = 'P001'").count() == 2


def test_missing_and_misplaced_tables_stop_the_load(spark, tmp_path):
    tables = linked(spark, clean_rows())
    tables["pos.inventory_movement"] = tables.pop("inventory.inventory_movement")
    del tables["ecommerce.customer"]
    for name, df in tables.items():
        df.write.parquet(f"{tmp_path}/in/{name.replace('.', '/')}")
    with pytest.raises(load.LoadError) as stopped:
        load.main(["--sources", f"{tmp_path}/in", "--out", f"{tmp_path}/out", "--run-date", "2025-05-12"])
    assert "MISSING TABLE: ecommerce.customer.customer_id\n" in f"{stopped.value}\n"
    assert "MISSING TABLE: inventory.inventory_movement.movement_id (table found in pos)" in str(stopped.value)
    assert load.current(spark, f"{tmp_path}/out") is None
    with pytest.raises(load.LoadError, match="MISSING TABLE"):
        load.checked_sources(spark, f"{tmp_path}/nothing")


def test_main_loads_a_folder(spark, tmp_path):
    for name, df in linked(spark, clean_rows()).items():
        df.write.parquet(f"{tmp_path}/in/{name.replace('.', '/')}")
    load.main(["--sources", f"{tmp_path}/in", "--out", f"{tmp_path}/out", "--run-date", "2025-05-12"])
    assert load.current(spark, f"{tmp_path}/out").version == 1


def test_an_empty_day_clears_the_day(spark, tmp_path):
    out, rows = f"{tmp_path}/out", clean_rows()
    load.run(spark, linked(spark, rows), out, RUN)
    load.run(spark, linked(spark, rows), out, Run(date(2025, 5, 13), datetime(2025, 5, 13, 4)))
    rows["inventory.inventory"] = rows["inventory.inventory"][:0]
    last = load.run(spark, linked(spark, rows), out, Run(date(2025, 5, 13), datetime(2025, 5, 13, 5)))
    assert {r.date_key for r in last["fact_inventory_snapshot"].select("date_key").distinct().collect()} == {20250512}
    assert reports.latest_snapshot(last).count() == 3
    first = load.run(spark, linked(spark, rows), f"{tmp_path}/other", RUN)
    assert reports.latest_snapshot(first).count() == first["fact_inventory_snapshot"].count() == 0


@pytest.mark.parametrize("step", ["violations", "qa_checks", "qa_scoreboard"])
def test_a_failed_load_shows_readers_nothing(spark, tmp_path, monkeypatch, step):
    out, rows = f"{tmp_path}/out", clean_rows()
    load.run(spark, linked(spark, rows), out, RUN)
    rows["inventory.inventory"][2] = ("I003", "P001", "S002", 9, 0, 9, DAY)

    def fails(*arguments):
        raise RuntimeError("lost")

    with monkeypatch.context() as patched:
        patched.setattr(quality, step, fails)
        with pytest.raises(RuntimeError, match="lost"):
            load.run(spark, linked(spark, rows), out, RUN)
    seen = load.current(spark, out)
    assert (seen.version, seen["etl_run_log"].count()) == (1, 8)
    assert reports.latest_snapshot(seen).agg(F.max("on_hand_quantity")).first()[0] < 9
    again = load.run(spark, linked(spark, rows), out, RUN)
    assert sorted(r.run_id for r in again["etl_run_log"].collect()) == [*range(101, 109), *range(201, 209)]
    assert reports.latest_snapshot(again).agg(F.max("on_hand_quantity")).first()[0] == 9


def test_two_loads_at_once_do_not_share_a_version(spark, tmp_path, monkeypatch):
    out, tables = f"{tmp_path}/out", linked(spark, clean_rows())
    load.run(spark, tables, out, RUN)
    monkeypatch.setattr(load, "current", lambda spark, out: None)
    with pytest.raises(load.LoadError, match="another load"):
        load.run(spark, tables, out, RUN)


def test_dimensions_without_names_and_prices_are_not_published(spark, tmp_path):
    rows = clean_rows()
    rows["inventory.product"] = [(p[0], None, p[2], p[3], None, p[5]) for p in rows["inventory.product"]]
    rows["ecommerce.customer"] = [(c[0], None, c[2]) for c in rows["ecommerce.customer"]]
    with pytest.raises(load.LoadError, match="sku IS NOT NULL|unit_price IS NOT NULL|customer_name IS NOT NULL"):
        load.run(spark, linked(spark, rows), f"{tmp_path}/out", RUN)
    assert load.current(spark, f"{tmp_path}/out") is None


def test_copies_are_found_whatever_further_columns_say(spark):
    rows = [("C1", "Ann", "a@x", n, "ECOMMERCE", DAY) for n in range(3)]
    copies = spark.createDataFrame(
        rows, "customer_id string, customer_name string, email string, loyalty int, source_system string, extracted_at timestamp"
    )
    tagged = cleaning.tag_customers(copies)
    assert cleaning.kept("stg_customers", tagged).count() == 1
    assert cleaning.rejects("stg_customers", tagged).count() == 2


def test_declared_rules_find_each_fault(spark):
    found = {(r.table_name, r.rule, r.record_id) for r in quality.violations(linked(spark, faulty_rows())).collect()}
    assert {
        ("inventory.product", "product_id IS NOT NULL", ""),
        ("inventory.inventory", "on_hand_quantity >= 0", "I012"),
        ("inventory.inventory", "(product_id) REFERENCES inventory.product", "P404"),
        ("ecommerce.customer", "UNIQUE (email)", "ines@x.test"),
        ("ecommerce.order_item", "quantity > 0", "OI015"),
        ("ecommerce.order_item", "line_amount = quantity * unit_price", "OI010"),
    } <= found
