"""Online orders and till sales taken as they come, each batch stored as a whole and once.

A micro-batch serves its forms in the order of their times and ids against the stock that the batches before it left,
and writes the rows of all tables, the ledger and the change of stock per pair to a folder of its own. One small file
put where there is none (``manifest.put_if_absent``) then makes the folder count. A batch that is replayed after a crash
finds its file and does nothing; one that crashed before leaves a folder that nobody reads.

The file carries what the next batch starts from: the highest id of each kind, so that ids go on without gaps and no
table is scanned for them, and the folders that make up the stock: a base and the changes since. Every
``fold_every`` batches the changes are folded into a new base, so a batch reads few of them however long the stream runs.

Anyone may ask for stock, rows and the newest forms while the stream runs; they see whole batches.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Mapping
from dataclasses import asdict, dataclass, field
from typing import Any

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming.query import StreamingQuery

from shelfwise.functions.retail import id_number
from shelfwise.operators import stock
from shelfwise.operators.stock import PAIR
from shelfwise.plans import manifest
from shelfwise.session import fresh_folder, store, store_counted
from shelfwise.sources.linked import union_all

FORMS = (
    "request_id string, request_ts timestamp_ntz, form string, customer_id string, store_id string, product_id string, quantity int"
)
ORDER, SALE = "ORDER", "SALE"
# Columns whose ids go on from batch to batch.
NUMBERED = (
    ("ecommerce.online_order", "order_id"),
    ("ecommerce.order_item", "order_item_id"),
    ("ecommerce.reservation", "reservation_id"),
    ("pos.pos_transaction", "transaction_id"),
    ("pos.pos_transaction_item", "transaction_item_id"),
)
ANSWERS = {"order_answers": ORDER, "sale_answers": SALE}
TABLES = (*[table for table, _ in NUMBERED], "inventory.inventory_movement", *ANSWERS, "refused")


@dataclass(frozen=True)
class Commit:
    """What a batch leaves to the next one."""

    version: int
    folder: str | None
    base: str
    changes: list[str] = field(default_factory=list)
    highest: dict[str, int] = field(default_factory=dict)
    rows: dict[str, int] = field(default_factory=dict)


def _commits(spark: SparkSession, out: str, newest_only: bool = False) -> list[Commit]:
    found = manifest.versions(spark, out)
    if newest_only:
        found = found[-1:]
    if not found:
        return []
    # one line per batch
    lines = spark.read.text([manifest.file_of(out, v) for v in found]).collect()
    return sorted((Commit(**json.loads(line["value"])) for line in lines), key=lambda c: c.version)


def _put(spark: SparkSession, out: str, commit: Commit) -> bool:
    return manifest.put_if_absent(spark, manifest.file_of(out, commit.version), f"{json.dumps(asdict(commit))}\n".encode())


def open_shop(linked: Mapping[str, DataFrame], out: str) -> None:
    """The state before the first batch: version 0, with the stock and the highest ids of the sources."""
    inventory = linked["inventory.inventory"]
    spark = inventory.sparkSession
    if manifest.versions(spark, out):
        return
    base = f"{out}/stock/{uuid.uuid4().hex}"
    stock_columns = [F.col(c).cast("long") for c in ("on_hand_quantity", "reserved_quantity")]
    store(inventory.select(*PAIR, *stock_columns), base)
    highest = {}
    for table, column in NUMBERED:
        highest[table] = int(linked[table].agg(F.max(id_number(column)).alias("n")).first()["n"] or 0)
    _put(spark, out, Commit(0, None, base, [], highest))


def _stock(spark: SparkSession, commit: Commit, pairs: DataFrame | None = None) -> DataFrame:
    """Stock per pair, of the asked pairs only if some are given; their rows are picked before anything is summed."""
    parts = [spark.read.parquet(commit.base).withColumn("is_base", F.lit(True))]
    if commit.changes:
        parts.append(spark.read.parquet(*commit.changes).withColumn("is_base", F.lit(False)))
    rows = union_all(parts)
    if pairs is not None:
        rows = rows.join(pairs.select(*PAIR).distinct(), PAIR, "left_semi")
    total = lambda c: F.sum(c).alias(c)
    # a pair without a row in the base has no stock, and nothing changes it
    return rows.groupBy(*PAIR).agg(total("on_hand_quantity"), total("reserved_quantity"), F.bool_or("is_base").alias("known")).where("known").drop("known")


def _serve(forms: DataFrame, version: int, masters: Mapping[str, DataFrame], out: str, fold_every: int, slice_rows: int) -> None:
    spark = forms.sparkSession
    (last,) = _commits(spark, out, newest_only=True)
    if last.version >= version:
        return  # replayed
    forms = store(forms, fresh_folder(spark, "forms"))
    inventory = _stock(spark, last, forms).withColumn("available_to_sell", F.col("on_hand_quantity") - F.col("reserved_quantity"))
    inventory = store(inventory.select(*PAIR, *[F.col(c).cast("int") for c in inventory.columns[2:]]), fresh_folder(spark, "asked-stock"))
    linked = {**masters, "inventory.inventory": inventory}
    for table, column in NUMBERED:
        linked[table] = spark.createDataFrame([(str(last.highest[table]),)], f"{column} string")
    orders = forms.where(F.col("form") == ORDER).drop("form")
    sales = forms.where(F.col("form") == SALE).drop("form", "customer_id")
    ordered, sold, decided = stock.serve_forms(orders, sales, linked, slice_rows)
    unknown = forms.where(~F.coalesce(F.col("form").isin(ORDER, SALE), F.lit(False)))
    refused = union_all([
        ordered["refused"].withColumn("form", F.lit(ORDER)),
        sold["refused"].withColumn("form", F.lit(SALE)),
        unknown.select("request_id", F.concat(F.lit("Unknown form "), F.coalesce("form", F.lit("<NULL>"))).alias("error"), "form"),
    ])
    rows = {table: (ordered if table in ordered else sold)[table] for table, _ in NUMBERED}
    rows["inventory.inventory_movement"] = ordered["inventory.inventory_movement"].unionByName(sold["inventory.inventory_movement"])
    rows |= {"order_answers": ordered["answers"], "sale_answers": sold["answers"], "refused": refused}
    folder, counts = f"{out}/batches/{version:09d}-{uuid.uuid4().hex[:8]}", {}
    for table, df in rows.items():
        _, counted = store_counted(df, f"{folder}/{table}", rows=F.count(F.lit(1)))
        counts[table] = counted["rows"]
    applied, kind, units = decided.where("applied"), F.col("kind"), F.col("quantity").cast("long")
    change = applied.groupBy(*PAIR).agg(
        F.sum(F.when(kind == stock.SELL, -units).otherwise(0)).alias("on_hand_quantity"),
        F.sum(F.when(kind == stock.RESERVE, units).otherwise(0)).alias("reserved_quantity"),
    )
    store(change, f"{folder}/change")
    base, changes = last.base, [*last.changes, f"{folder}/change"]
    if len(changes) >= fold_every:
        base = f"{out}/stock/{uuid.uuid4().hex}"
        store(_stock(spark, Commit(version, folder, last.base, changes)), base)
        changes = []
    # ids count up without gaps, one per row
    highest = {table: last.highest[table] + counts[table] for table, _ in NUMBERED}
    _put(spark, out, Commit(version, folder, base, changes, highest, counts))


def form_stream(spark: SparkSession, folder: str, files_per_batch: int = 8) -> DataFrame:
    """Forms as they arrive as parquet files, a limited number of files per batch."""
    return spark.readStream.schema(FORMS).option("maxFilesPerTrigger", files_per_batch).parquet(folder)


def serve(
    forms: DataFrame,
    masters: Mapping[str, DataFrame],
    out: str,
    checkpoint: str,
    fold_every: int = 50,
    slice_rows: int = stock.SLICE_ROWS,
    **trigger: Any,
) -> StreamingQuery:
    """Take forms (``FORMS``) into the tables under ``out``; ``open_shop`` comes before the first start.

    ``masters`` has ``inventory.product`` and ``ecommerce.customer``. One stream may write to ``out``: a second one
    that puts the same version finds it taken and stores nothing, but its own checkpoint goes on.
    """
    return (
        forms.writeStream.foreachBatch(lambda batch, n: _serve(batch, n + 1, masters, out, fold_every, slice_rows))
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )


def stock_now(spark: SparkSession, out: str, pairs: DataFrame | None = None) -> DataFrame:
    """Stock after the newest stored batch, of all pairs or those asked for."""
    (last,) = _commits(spark, out, newest_only=True)
    rows = _stock(spark, last, pairs)
    return rows.withColumn("available_to_sell", F.col("on_hand_quantity") - F.col("reserved_quantity"))


def availability(pairs: DataFrame, out: str) -> DataFrame:
    """Live stock for each asked pair; a pair that the shop does not carry has no answer."""
    return stock.availability(pairs, stock_now(pairs.sparkSession, out, pairs))


def stored(spark: SparkSession, out: str, table: str) -> DataFrame:
    """The rows of a table that the stream has stored, batch by batch in ``version``."""
    commits = [c for c in _commits(spark, out) if c.folder]
    kept = [c for c in commits if c.rows[table]]
    if not commits:
        raise ValueError(f"no batch is stored under {out}")
    if not kept:
        return spark.read.parquet(f"{commits[-1].folder}/{table}").withColumn("version", F.lit(0))
    whole = spark.read.parquet(*[f"{c.folder}/{table}" for c in kept])
    version = F.regexp_extract(F.input_file_name(), r"/batches/(\d+)-", 1).cast("int")
    return whole.withColumn("version", version)


def newest(spark: SparkSession, out: str, table: str, time: str, rows: int = 10) -> DataFrame:
    """The newest rows of a table by time and id.

    Later batches may hold earlier times, so all are asked; each task keeps ``rows`` of them.
    """
    identifier = dict(NUMBERED)[table]
    found = stored(spark, out, table).drop("version")
    return found.orderBy(F.col(time).desc_nulls_first(), F.col(identifier).desc_nulls_first()).limit(rows)
