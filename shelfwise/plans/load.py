"""The load job: check, stage, clean, load, validate, publish.

A run writes everything, the snapshot of its date and its log included, to a version folder of its own. The
last step puts the next manifest (``plans/manifest.py``); until then readers see the version before, whatever fails,
and of two loads that started from one version the first to get there wins. Readers take each date of the snapshot
from the newest version that wrote it. What only the run itself needs goes to the scratch folder of the application.
"""

from __future__ import annotations

import argparse
import uuid
from collections.abc import Mapping
from dataclasses import dataclass
from datetime import date, datetime

from pyspark.sql import DataFrame, Row, SparkSession, functions as F

from shelfwise.operators import day_counts, facts
from shelfwise.operators.dimensions import DIMENSION_SOURCE
from shelfwise.operators.facts import FACTS
from shelfwise.plans import manifest, quality, reports
from shelfwise.plans.warehouse import Run, Warehouse
from shelfwise.session import UTC, build_session, fresh_folder, store
from shelfwise.sources import footers
from shelfwise.sources.linked import bad_status, contract_check, link_folder

DIMENSIONS = ("dim_date", *DIMENSION_SOURCE)


class LoadError(RuntimeError):
    """The sources or the loaded tables are not as declared; nothing was published."""


@dataclass(frozen=True)
class Published:
    """Tables of one published version; the snapshot and the run log reach back to the versions before."""

    spark: SparkSession
    entries: tuple[Row, ...]

    @property
    def version(self) -> int:
        return self.entries[-1]["version"]

    @property
    def folder(self) -> str:
        return self.entries[-1]["folder"]

    def snapshot_days(self) -> dict[int, facts.SnapshotDay]:
        return {
            e["date_key"]: facts.SnapshotDay(f"{e['folder']}/fact_inventory_snapshot", e["snapshot_rows"])
            for e in self.entries
        }

    def snapshot(self, first: date | None = None, last: date | None = None) -> DataFrame:
        """The snapshot from one date to another, both included; no folder of another date is listed."""
        return facts.snapshot_history(self.spark, self.snapshot_days(), first, last)

    def omnichannel(self, first: date | None = None, last: date | None = None) -> DataFrame:
        """Performance per store from one date to another, from the counts per day."""
        days = self["day_counts"]
        for day, within in ((first, lambda k: F.col("date_key") >= k), (last, lambda k: F.col("date_key") <= k)):
            days = days.where(within(int(f"{day:%Y%m%d}"))) if day else days
        return reports.omnichannel_from_days(self["dim_store"], days)

    def __getitem__(self, name: str) -> DataFrame:
        if name == "fact_inventory_snapshot":
            return self.snapshot()
        if name == "latest_snapshot":
            return facts.latest_day(self.spark, self.snapshot_days())
        if name == "etl_run_log":
            return self.spark.read.parquet(*[f"{e['folder']}/{name}" for e in self.entries])
        return self.spark.read.parquet(f"{self.folder}/{name}")


def current(spark: SparkSession, out: str) -> Published | None:
    """The newest published version, if there is one."""
    entries = manifest.loads(spark, out)
    return Published(spark, entries) if entries else None


def run(spark: SparkSession, linked: Mapping[str, DataFrame], out: str, run: Run) -> Published:
    """One load. Raises ``LoadError`` before anything is published if a constraint is broken."""
    spark.conf.set("spark.sql.session.timeZone", UTC)
    last = current(spark, out)
    version = last.version + 1 if last else 1
    folder = f"{out}/versions/{version:06d}-{uuid.uuid4().hex[:8]}"
    previous = {name: last[name] for name in DIMENSIONS} if last else {}
    history = last.snapshot_days() if last else {}
    dw = Warehouse(spark, dict(linked), run, folder, previous, history, fresh_folder(spark, "load"))

    store(bad_status(dw.linked), f"{folder}/bad_status")
    log = dw.reject_log().withColumn("rejected_at", F.lit(run.started_at).cast("timestamp"))
    store(log.withColumn("reject_id", F.monotonically_increasing_id() + 1), f"{folder}/etl_reject_log")

    loaded = {name: dw[name] for name in (*DIMENSIONS, *FACTS)}
    broken = quality.violations({**loaded, "fact_inventory_snapshot": dw.snapshot_day()}).limit(5).collect()
    if broken:
        raise LoadError(f"not published, broken constraints: {broken}")

    # in order of days, so that a report over some days reads the files of these
    days = day_counts.day_counts(*[dw[name] for name in FACTS])
    store(days.repartitionByRange("date_key").sortWithinPartitions("date_key", "store_key"), f"{folder}/day_counts")

    checks = store(quality.qa_checks(dw, dw.linked), f"{folder}/qa_checks")
    store(quality.qa_scoreboard(checks), f"{folder}/qa_scoreboard")
    steps = dw.run_log().withColumn("run_id", F.lit(version) * 100 + F.col("step_no"))
    store(steps.coalesce(1), f"{folder}/etl_run_log")
    check_files(spark, folder, {r["step"].lower(): r["rows_affected"] for r in steps.collect()})
    rows = dw.snapshot_days()[dw.date_key].rows
    entry = Row(
        version=version, folder=folder, run_date=run.run_date, started_at=run.started_at, date_key=dw.date_key, snapshot_rows=rows
    )
    try:
        manifest.publish(spark, out, [*(last.entries if last else ()), entry])
    except manifest.Taken as taken:
        raise LoadError(f"not published, another load published {taken} meanwhile") from taken
    return current(spark, out)


def check_files(spark: SparkSession, folder: str, logged: Mapping[str, int]) -> None:
    """Raise ``LoadError`` unless the footers of the fact files hold as many rows as the writes have counted."""
    names = [*FACTS, "fact_inventory_snapshot"]
    found = footers.row_counts(spark, {name: f"{folder}/{name}" for name in names}).collect()
    wrong = [f"{r['table_name']}: files hold {r['row_count']} of {logged[r['table_name']]}" for r in found if r["row_count"] != logged[r["table_name"]]]
    if wrong:
        raise LoadError(f"not published, rows are lost or doubled: {'; '.join(wrong)}")


def checked_sources(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """The linked tables; raises ``LoadError`` with what is missing, and where it was found instead."""
    linked = link_folder(spark, folder)
    problems = contract_check(spark, linked).collect()
    if problems:
        lines = "\n".join(
            f"{p.problem}: {p.expected_table}.{p.expected_column}"
            + (f" (table found in {p.found_this_table_in_schema})" if p.found_this_table_in_schema else "")
            for p in problems
        )
        raise LoadError(f"the sources under {folder} are not as agreed:\n{lines}")
    return linked


def main(arguments: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(description="Load the retail warehouse from linked source tables.")
    parser.add_argument("--sources", required=True, help="folder with <schema>/<table> parquet tables")
    parser.add_argument("--out", required=True, help="warehouse folder")
    parser.add_argument("--run-date", type=date.fromisoformat, default=None)
    options = parser.parse_args(arguments)

    spark = build_session()
    linked = checked_sources(spark, options.sources)
    bad_status(linked).show(100, truncate=False)
    started = datetime.now()
    published = run(spark, linked, options.out, Run(options.run_date or started.date(), started))
    published["qa_scoreboard"].orderBy("item").show(truncate=False)


if __name__ == "__main__":
    main()
