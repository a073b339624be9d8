"""Which versions of a warehouse are published, and where each date of its snapshot is.

``published/000007.json`` has a line for every load up to version 7. Readers list the names, take the highest and read
that one file: what is published is known without opening a version folder, and a question about some dates is
answered from the lines before any folder of the other dates is listed.

A version is published by putting its file where there is none yet. The file is written under a name of its own and
then given its final one in a single step that fails if that name is taken: a hard link on a local or mounted file
system, a rename without overwriting elsewhere, which HDFS and other file systems with a name node do atomically. S3
has no such rename; there a commit service has to stand between loads.
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Iterable
from urllib.parse import unquote, urlparse

from py4j.protocol import Py4JJavaError
from pyspark.sql import Row, SparkSession

from shelfwise.session import qualified

LOADS = "version bigint, folder string, run_date date, started_at timestamp, date_key int, snapshot_rows bigint"
FOLDER = "published"


class Taken(RuntimeError):
    """Another load has published this version."""


def _put_by_link(path: str, data: bytes) -> bool:
    """Put a file where there is none; false if there is one."""
    draft = os.path.join(os.path.dirname(path), f".{os.path.basename(path)}-{uuid.uuid4().hex}")
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(draft, "wb") as file:
        file.write(data)
        file.flush()
        os.fsync(file.fileno())
    try:
        os.link(draft, path)
    except FileExistsError:
        return False
    finally:
        os.unlink(draft)
    return True


def _put_by_rename(spark: SparkSession, system, path, data: bytes) -> bool:
    hadoop = spark._jvm.org.apache.hadoop.fs
    draft = hadoop.Path(path.getParent(), f".{path.getName()}-{uuid.uuid4().hex}")
    stream = system.create(draft, True)
    try:
        stream.write(bytearray(data))
    finally:
        stream.close()
    kinds = getattr(hadoop, "Options$Rename")
    options = spark.sparkContext._gateway.new_array(kinds, 1)
    options[0] = kinds.NONE
    try:
        hadoop.FileContext.getFileContext(path.toUri(), spark._jsc.hadoopConfiguration()).rename(draft, path, options)
    except Py4JJavaError as error:
        if "FileAlreadyExistsException" in error.java_exception.getClass().getName():
            return False
        raise
    finally:
        system.delete(draft, False)
    return True


def put_if_absent(spark: SparkSession, target: str, data: bytes) -> bool:
    """Write a file that nobody has written yet, in one step for readers; false if somebody has."""
    system, path = qualified(spark, target)
    address = urlparse(path.toString())
    if address.scheme in ("", "file"):
        return _put_by_link(unquote(address.path), data)
    return _put_by_rename(spark, system, path, data)


def versions(spark: SparkSession, out: str) -> list[int]:
    """Published versions, by name alone."""
    system, folder = qualified(spark, f"{out}/{FOLDER}")
    if not system.exists(folder):
        return []
    names = [status.getPath().getName() for status in system.listStatus(folder)]
    return sorted(int(name.removesuffix(".json")) for name in names if name.removesuffix(".json").isdigit())


def file_of(out: str, version: int) -> str:
    return f"{out}/{FOLDER}/{version:06d}.json"


def loads(spark: SparkSession, out: str) -> tuple[Row, ...]:
    """A row per load up to the newest published one, in order."""
    found = versions(spark, out)
    if not found:
        return ()
    return tuple(spark.read.schema(LOADS).json(file_of(out, found[-1])).orderBy("version").collect())


def publish(spark: SparkSession, out: str, entries: Iterable[Row]) -> None:
    """Publish the version of the last entry; raises ``Taken`` if another load was faster."""
    rows = list(entries)
    lines = spark.createDataFrame(rows, LOADS).orderBy("version").toJSON().collect()  # a line per load
    if not put_if_absent(spark, file_of(out, rows[-1]["version"]), "".join(f"{x}\n" for x in lines).encode()):
        raise Taken(f"version {rows[-1]['version']}")
