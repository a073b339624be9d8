"""Publishing by two writers at once, folder names, dates of the snapshot, counts of the writes."""

import multiprocessing
import os
import threading
from datetime import date, datetime, timedelta

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import Row, functions as F

from fixtures import clean_rows, faulty_rows, linked
from shelfwise.operators import facts
from shelfwise.plans import load, manifest
from shelfwise.plans.warehouse import Run, Warehouse
from shelfwise.session import qualified, store_counted
from shelfwise.sources.linked import link_folder
from shelfwise.sources.schemas import SOURCES

RUN = Run(date(2025, 5, 12), datetime(2025, 5, 12, 4))


def _race(folder, writer, barrier, tries, won):
    for i in range(tries):
        barrier.wait()
        if manifest._put_by_link(f"{folder}/{i:06d}.json", f"{writer}\n".encode() * 1000):
            won.put((i, writer))


def test_two_processes_never_publish_one_version(tmp_path):
    context = multiprocessing.get_context("spawn")
    barrier, won, tries = context.Barrier(2), context.Queue(), 60
    writers = [context.Process(target=_race, args=(str(tmp_path), w, barrier, tries, won)) for w in "ab"]
    for w in writers:
        w.start()
    winners = dict(won.get(timeout=60) for _ in range(tries))
    for w in writers:
        w.join(60)
    assert won.empty() and sorted(winners) == list(range(tries))
    for i, writer in winners.items():
        assert (tmp_path / f"{i:06d}.json").read_text() == f"{writer}\n" * 1000
    assert len(os.listdir(tmp_path)) == tries  # no drafts are left


def test_rename_does_not_overwrite(spark, tmp_path):
    """The way of file systems with a name node."""
    system, path = qualified(spark, f"{tmp_path}/published/000001.json")
    assert manifest._put_by_rename(spark, system, path, b"first")
    assert not manifest._put_by_rename(spark, system, path, b"second")
    assert (tmp_path / "published/000001.json").read_bytes() == b"first"
    assert [x for x in os.listdir(tmp_path / "published") if not x.endswith(".crc")] == ["000001.json"]


def entry(version, day, rows=1, folder="v"):
    return Row(version=version, folder=f"{folder}{version}", run_date=day, started_at=datetime(2025, 1, 1), date_key=int(f"{day:%Y%m%d}"), snapshot_rows=rows)


def test_a_manifest_lists_all_loads(spark, tmp_path):
    out, days = str(tmp_path), [date(2025, 1, 1), date(2025, 1, 2), date(2025, 1, 2)]
    assert manifest.loads(spark, out) == ()
    done = []
    for i, day in enumerate(days, 1):
        done.append(entry(i, day))
        manifest.publish(spark, out, done)
    assert manifest.versions(spark, out) == [1, 2, 3]
    assert [tuple(r) for r in manifest.loads(spark, out)] == [tuple(e) for e in done]
    with pytest.raises(manifest.Taken, match="version 3"):
        manifest.publish(spark, out, done)


def test_two_whole_loads_at_once(spark, tmp_path):
    out, tables = f"{tmp_path}/out", linked(spark, clean_rows())
    load.run(spark, tables, out, RUN)
    ends, gate, publish = [], threading.Barrier(2), manifest.publish

    def together(*arguments):
        gate.wait(120)
        publish(*arguments)

    def one():
        try:
            ends.append(load.run(spark, tables, out, RUN).version)
        except load.LoadError as error:
            ends.append(str(error))

    manifest.publish = together
    try:
        both = [threading.Thread(target=one) for _ in range(2)]
        for t in both:
            t.start()
        for t in both:
            t.join(300)
    finally:
        manifest.publish = publish
    assert sorted(map(str, ends)) == ["2", "not published, another load published version 2 meanwhile"]
    assert load.current(spark, out).version == 2


def test_a_month_lists_its_own_folders(spark, tmp_path):
    start = date(2024, 1, 1)
    schema = pa.schema([("inventory_fact_key", pa.int64()), ("product_key", pa.int64()), ("store_key", pa.int64()), ("date_key", pa.int32()),
                        ("on_hand_quantity", pa.int32()), ("reserved_quantity", pa.int32()), ("available_to_sell", pa.int32())])
    entries = []
    for i in range(400):
        day = start + timedelta(days=i)
        key = int(f"{day:%Y%m%d}")
        folder = tmp_path / f"v{i + 1}"
        (folder / "fact_inventory_snapshot").mkdir(parents=True)
        pq.write_table(pa.table([[1], [1], [1], [key], [i], [0], [i]], schema=schema), folder / "fact_inventory_snapshot/part-0.parquet")
        entries.append(entry(i + 1, day, folder=f"{tmp_path}/v"))
    manifest.publish(spark, str(tmp_path), entries)
    whole = load.current(spark, str(tmp_path))
    month = whole.snapshot(date(2024, 10, 1), date(2024, 10, 31))
    assert len(month.inputFiles()) == 31
    assert month.agg(F.min("date_key"), F.max("date_key"), F.count("*")).first()[:] == (20241001, 20241031, 31)
    assert len(whole.snapshot(date(2025, 1, 1)).inputFiles()) == 34
    assert whole.snapshot(date(2026, 1, 1)).count() == 0
    assert len(whole["latest_snapshot"].inputFiles()) == 1


def test_a_write_counts_its_rows(spark, tmp_path):
    rows = spark.range(1000).withColumn("odd", F.col("id") % 2 == 1)
    stored, counts = store_counted(rows, f"{tmp_path}/t", "error", ["odd"], rows=F.count(F.lit(1)), odd=F.count_if("odd"))
    assert counts == {"rows": 1000, "odd": 500} and stored.columns == ["id"] and stored.count() == 1000
    _, counts = store_counted(rows.where("id < 0"), f"{tmp_path}/none", rows=F.count(F.lit(1)))
    assert counts == {"rows": 0}


def test_the_run_log_reads_nothing_again(spark, tmp_path):
    dw = Warehouse(spark, linked(spark, faulty_rows()), RUN, str(tmp_path))
    log = dw.run_log()
    assert log.inputFiles() == []
    by_step = {r.step: r.rows_affected for r in log.collect()}
    expected = {name.upper(): dw[source].count() for name, source in (("dim_product", "stg_products"), ("dim_store", "stg_stores"), ("dim_customer", "stg_customers"))}
    expected |= {name.upper(): dw[name].count() for name in (*facts.FACTS, "dim_date", "fact_inventory_snapshot")}
    assert by_step == expected


@pytest.fixture(scope="module")
def sources(spark, tmp_path_factory):
    """A folder named like one of its schemas."""
    root = tmp_path_factory.mktemp("sources")
    for name, df in linked(spark, clean_rows()).items():
        df.coalesce(1).write.parquet(f"{root}/inventory/{name.replace('.', '/')}")
    return root


@pytest.mark.parametrize("spelling", ["{0}/inventory", "{0}//inventory/", "{0}/x/.././inventory", "file:{0}/inventory", "{1}/inventory", "./{1}/inventory/."])
def test_folders_however_they_are_named(spark, sources, spelling):
    working = qualified(spark, ".")[1].toString().removeprefix("file:")
    tables = link_folder(spark, spelling.format(sources, os.path.relpath(sources, working)))
    assert {name: df.columns for name, df in tables.items()} == {name: schema.fieldNames() for name, schema in SOURCES.items()}
