"""Session defaults and the shared folder for intermediate tables."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, Observation, SparkSession

# Dates of timestamps do not depend on where a job runs.
UTC = "UTC"

# Settings the jobs rely on; sizes and parallelism are left to the cluster.
SETTINGS = {
    "spark.sql.session.timeZone": UTC,
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # ids and times of lines make up most of what is shuffled; lz4 leaves them nearly twice as long
    "spark.io.compression.codec": "zstd",
    "spark.ui.enabled": "false",
}

# Spark removes the shuffle files of a statement as soon as it has ended, instead of when the driver collects garbage.
CLEAN_UP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

_local_folders: dict[str, str] = {}


def build_session(master: str | None = None, app: str = "shelfwise", **extra: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can reach, one per application.

    The cluster names it in ``spark.checkpoint.dir``. Only a local master may fall back to a
    temporary folder of this machine.
    """
    app = spark.sparkContext.applicationId
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
        base = _local_folders.setdefault(app, tempfile.mkdtemp(prefix="shelfwise-"))
    return f"{base.rstrip('/')}/shelfwise/{app}"


def fresh_folder(spark: SparkSession, label: str) -> str:
    return f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex[:12]}"


def qualified(spark: SparkSession, folder: str):
    """(file system, path) of a folder as its files are listed: absolute, without dots and repeated slashes."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    system = path.getFileSystem(spark._jsc.hadoopConfiguration())
    return system, system.makeQualified(path)


@contextmanager
def _written_once(spark: SparkSession) -> Iterator[None]:
    """What is written here is read back from its files: nothing asks for the shuffles behind it again."""
    before = spark.conf.get(CLEAN_UP, None)
    spark.conf.set(CLEAN_UP, "true")
    try:
        yield
    finally:
        spark.conf.unset(CLEAN_UP) if before is None else spark.conf.set(CLEAN_UP, before)


def store(df: DataFrame, path: str, mode: str = "error", compression: str | None = None) -> DataFrame:
    """Write a table and read it back, so later steps start from files that survive lost executors."""
    writer = df.write.mode(mode)
    with _written_once(df.sparkSession):
        (writer.option("compression", compression) if compression else writer).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def store_counted(
    df: DataFrame,
    path: str,
    mode: str = "error",
    helpers: Sequence[str] = (),
    compression: str | None = None,
    **counts: Column,
) -> tuple[DataFrame, dict[str, int]]:
    """Write a table without its ``helpers``, read it back, and return aggregates that the write itself has counted.

    The aggregates are taken in the tasks that write, of which each counts once; no scan is added.
    """
    seen = Observation()
    watched = df.observe(seen, *[value.alias(name) for name, value in counts.items()])
    return store(watched.drop(*helpers), path, mode, compression), seen.get
