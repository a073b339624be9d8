"""Counts and bounds from footers, and the guard of a load that rests on them."""

from datetime import date, datetime

import pytest

from fixtures import clean_rows, linked
from shelfwise.plans import load
from shelfwise.plans.warehouse import Run
from shelfwise.sources import footers


def test_no_column_is_read(spark, tmp_path, capsys):
    path = f"{tmp_path}/t"
    spark.range(5, 1005, numPartitions=3).selectExpr("id", "cast(id % 7 as int) AS k", "repeat('x', 50) AS note").write.parquet(path)
    usual = spark.conf.get("spark.sql.sources.useV1SourceList")
    bounds = footers.key_bounds(spark, {"t": path, "u": path}, {"t": "id", "u": "k"})
    assert [tuple(r) for r in bounds.collect()] == [("t", 1000, 5, 1004), ("u", 1000, 0, 6)]
    bounds.explain("formatted")
    plan = capsys.readouterr().out
    assert "PushedAggregation: [COUNT(*), MIN(id), MAX(id)]" in plan and "PushedAggregation: [COUNT(*), MIN(k), MAX(k)]" in plan
    assert "note" not in plan
    assert spark.conf.get("spark.sql.sources.useV1SourceList") == usual


def test_empty_tables_and_odd_names(spark, tmp_path):
    empty, odd = f"{tmp_path}/empty", f"{tmp_path}/odd"
    spark.range(0).write.parquet(empty)
    spark.range(3).selectExpr("id AS `count(*)`", "id AS row_count", "id AS table_name").write.parquet(odd)
    assert [tuple(r) for r in footers.row_counts(spark, {"e": empty, "o": odd}).collect()] == [("e", 0), ("o", 3)]
    bounds = footers.key_bounds(spark, {"e": empty, "o": odd}, {"e": "id", "o": "row_count"}).collect()
    assert [tuple(r) for r in bounds] == [("e", 0, None, None), ("o", 3, 0, 2)]


def test_nulls_count_as_rows(spark, tmp_path):
    spark.createDataFrame([(1, None), (None, None)], "a int, b int").coalesce(1).write.parquet(f"{tmp_path}/n")
    assert footers.row_counts(spark, {"n": f"{tmp_path}/n"}).first()["row_count"] == 2


def test_a_load_with_lost_rows_is_not_published(spark, tmp_path, monkeypatch):
    out, day = f"{tmp_path}/out", Run(date(2025, 5, 12), datetime(2025, 5, 12, 4))
    tables = linked(spark, clean_rows())
    published = load.run(spark, tables, out, day)
    assert published.version == 1

    counted = footers.row_counts
    monkeypatch.setattr(footers, "row_counts", lambda *a: counted(*a).selectExpr("table_name", "row_count - 1 AS row_count"))
    with pytest.raises(load.LoadError, match="files hold"):
        load.run(spark, tables, out, day)
    assert load.current(spark, out).version == 1
