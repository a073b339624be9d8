"""One load of the warehouse: every table is written once and later steps read it back."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass
from datetime import date, datetime

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from shelfwise.operators import cleaning, dimensions, facts
from shelfwise.operators.keys import require_unique
from shelfwise.operators.staging import stage
from shelfwise.session import UTC, shared_folder, store_counted
from shelfwise.sources.schemas import STAGED
from shelfwise.sources.star_tables import retail_sources

TABLES = ("dim_date", *dimensions.DIMENSION_SOURCE, *facts.FACTS, "fact_inventory_snapshot")


@dataclass(frozen=True)
class Run:
    """What the current clock decides in a live run, as parameters."""

    run_date: date
    started_at: datetime


class Warehouse(Mapping):
    """Tables of one run by name: ``stg_*`` cleaned, ``dim_*`` and ``fact_*`` loaded.

    A table is computed and written under ``folder`` when first asked for, together with the tables
    it needs; those that only this run needs go to ``work``. ``previous`` holds the dimensions of the
    last run, ``history`` the snapshot of earlier dates; both default to an empty warehouse.
    """

    def __init__(
        self,
        spark: SparkSession,
        linked: dict[str, DataFrame],
        run: Run,
        folder: str,
        previous: Mapping[str, DataFrame] | None = None,
        history: Mapping[int, facts.SnapshotDay] | None = None,
        work: str | None = None,
    ) -> None:
        self.spark, self.linked, self.run, self.folder = spark, linked, run, folder
        self.previous = previous or {}
        self.work = work or f"{folder}/work"
        self.history = dict(history or {})
        self._today: facts.SnapshotDay | None = None
        self._written: dict[str, DataFrame] = {}
        self._rows: dict[str, int] = {}

    def __iter__(self):
        return iter((*STAGED, *TABLES))

    def __len__(self) -> int:
        return len(STAGED) + len(TABLES)

    def __getitem__(self, name: str) -> DataFrame:
        if name in STAGED:
            return cleaning.kept(name, self.tagged(name))
        if name == "fact_inventory_snapshot":
            return facts.snapshot_history(self.spark, self.snapshot_days())
        if name == "latest_snapshot":
            return facts.latest_day(self.spark, self.snapshot_days())
        if name not in TABLES:
            raise KeyError(name)
        if name not in self._written:
            if name == "dim_date":
                self._write(name, self._build(name), F.count_if("is_new"), "is_new")
            else:
                self._write(name, self._build(name))
        return self._written[name]

    def _write(self, name: str, df: DataFrame, loaded: Column | None = None, *helpers: str) -> DataFrame:
        """Write a table without its ``helpers``; the write counts the rows that are ``loaded``, by default all."""
        # A failed attempt may have left files behind.
        folder = self.folder if name in TABLES else self.work
        counted = F.count(F.lit(1)) if loaded is None else loaded
        # Spark broadcasts by file size, so tables that are looked up keep the default, which tells more of their rows.
        compression = None if name.startswith(("dim_", "known_")) else "zstd"
        self._written[name], counts = store_counted(df, f"{folder}/{name}", "overwrite", helpers, compression, rows=counted)
        self._rows[name] = counts["rows"]
        return self._written[name]

    def source(self, name: str) -> DataFrame:
        """A copy of a linked table, so that a live source is read once."""
        label = f"source_{name}"
        return self._written[label] if label in self._written else self._write(label, self.linked[name])

    def staged(self, name: str) -> DataFrame:
        return stage(self.linked, name, self.run.started_at)

    def tagged(self, name: str) -> DataFrame:
        """Staged rows with the first cleaning rule each one breaks."""
        label = f"tagged_{name}"
        if label not in self._written:
            self._write(label, self._tag(name), F.count_if(F.col(cleaning.REASON).isNull()))
        return self._written[label]

    def _tag(self, name: str) -> DataFrame:
        rule, masters = cleaning.RULES[name]
        return rule(self.staged(name), *[self.known(m) for m in masters])

    def known(self, name: str) -> DataFrame:
        """One row per id of a cleaned table, with what rows that refer to it need."""
        label = f"known_{name}"
        if label not in self._written:
            if name in cleaning.HEADERS:
                known = self._write(label, cleaning.known_headers(name, self.tagged(name)))
                require_unique(known, ["known_id"], name)
            else:
                dimension = next(d for d, source in dimensions.DIMENSION_SOURCE.items() if source == name)
                self._write(label, cleaning.known_master(self[name], self[dimension]))
        return self._written[label]

    def reject_log(self, alone: bool = False) -> DataFrame:
        """Every rejected row of every staged table.

        Where the log is all that is asked for (``alone``), tables in which nothing else looks ids up are not written
        for it: of their rows only ids and what the rules look at go through the shuffles. A load takes the written
        tables, so that log and facts describe the same rows.
        """
        needed = {master for _, masters in cleaning.RULES.values() for master in masters}
        written = lambda name: not alone or name in needed or f"tagged_{name}" in self._written
        return cleaning.reject_log({name: self.tagged(name) if written(name) else self._tag(name) for name in STAGED})

    def _existing(self, name: str) -> DataFrame:
        return self.previous[name] if name in self.previous else dimensions.empty(self.spark, name)

    def _build(self, name: str) -> DataFrame:
        if name == "dim_date":
            loaded = self._existing(name).withColumn("is_new", F.lit(False))
            return loaded.unionByName(self.new_dates().withColumn("is_new", F.lit(True)))
        if name in dimensions.DIMENSION_SOURCE:
            return dimensions.upsert(self._existing(name), self[dimensions.DIMENSION_SOURCE[name]], name)
        build, source = facts.FACTS[name]
        return build(self.tagged(source))

    def new_dates(self) -> DataFrame:
        return dimensions.new_dates(self._existing("dim_date"), dimensions.date_range(self, self.run.run_date))

    def snapshot_days(self) -> dict[int, facts.SnapshotDay]:
        """All dates; today's rows, even if there are none, replace what the history has for today."""
        if self._today is None:
            today = facts.fact_inventory_snapshot(self.tagged("stg_inventory"), self.run.run_date)
            self._today = facts.write_snapshot_day(today, f"{self.folder}/fact_inventory_snapshot")
        return {**self.history, self.date_key: self._today}

    @property
    def date_key(self) -> int:
        return int(f"{self.run.run_date:%Y%m%d}")

    def snapshot_day(self) -> DataFrame:
        """Today's rows of the inventory snapshot."""
        return facts.snapshot_history(self.spark, {self.date_key: self.snapshot_days()[self.date_key]})

    def run_log(self) -> DataFrame:
        """Rows loaded per step, in load order, as the writes have counted them; nothing is read again."""
        counts = {}
        for name in ("dim_date", *dimensions.DIMENSION_SOURCE, *facts.FACTS):
            self[name]  # written if it was not yet
            source = dimensions.DIMENSION_SOURCE.get(name)
            counts[name] = self._rows[f"tagged_{source}" if source else name]
        counts["fact_inventory_snapshot"] = self.snapshot_days()[self.date_key].rows
        steps = [(i, name.upper(), n) for i, (name, n) in enumerate(counts.items(), 1)]
        logged = self.spark.createDataFrame(steps, "step_no int, step string, rows_affected bigint")
        return logged.withColumn("logged_at", F.lit(self.run.started_at).cast("timestamp"))


def latest_log(log: DataFrame, rows: int = 8) -> DataFrame:
    """The last entries of the run log, newest first."""
    return log.orderBy(F.col("run_id").desc()).limit(rows)


# Run parameters of the registered queries; fixed so that results can be compared.
SAMPLE_RUN = Run(date(2024, 2, 1), datetime(2024, 2, 1, 6, 0))

_opened: dict[tuple, Warehouse] = {}


def _fingerprint(spark: SparkSession, folder: str) -> tuple:
    """Number, size and last change of the input files, so that changed input is loaded again."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(f"{folder}/*.parquet")
    return tuple(files.agg(F.count("path"), F.sum("length"), F.max("modificationTime").cast("long")).first())


def sample_warehouse(spark: SparkSession, folder: str, dirty: bool = True) -> Warehouse:
    """The warehouse over the star-schema tables, shared by all queries of one application."""
    spark.conf.set("spark.sql.session.timeZone", UTC)
    key = (spark.sparkContext.applicationId, folder, dirty, _fingerprint(spark, folder))
    if key not in _opened:
        label = f"warehouse-{abs(hash(key)):x}-{len(_opened)}"
        _opened[key] = Warehouse(
            spark, retail_sources(spark, folder, dirty), SAMPLE_RUN, f"{shared_folder(spark)}/{label}"
        )
    return _opened[key]
