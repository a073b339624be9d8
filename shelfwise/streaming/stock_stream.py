"""Stock requests decided as they arrive.

State lives per product and store: the stock, and what is known about each reference. Micro-batches
are served in arrival order, the requests inside one batch by time and id. ``request_stream`` limits
what a batch brings. The rows of a pair are sorted in runs of ``RUN_ROWS``, which go to temporary files if there
are more, so a hot pair takes time, not memory. A caller may still set ``pair_rows``, above which the query stops.

References may be forgotten ``keep_for`` after their last change. A reference that returns later counts as
new, so choose a time after which none returns; the stock itself is always kept.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from contextlib import ExitStack
from dataclasses import asdict
from datetime import timedelta
from heapq import merge
from itertools import islice
from tempfile import TemporaryFile
from typing import Any

from pyspark.sql import DataFrame, Row, SparkSession, functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.streaming.query import StreamingQuery

from shelfwise.operators.shelf import OUT_OF_STOCK, SELL, Decision, Hold, Shelf
from shelfwise.operators.stock import DECISION, PAIR, REQUEST, invalid_request, per_reference

# Keyed state with map values needs this state store.
STATE_STORE = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
}
REQUESTS = (
    "request_id string, request_ts timestamp_ntz, kind string, product_id string, store_id string, quantity int, "
    "reference string"
)
DECISIONS = (
    "request_id string, request_ts timestamp_ntz, kind string, product_id string, store_id string, quantity int, "
    "reference string, success boolean, reason string, error string, applied boolean"
)


# Requests of one pair that are sorted, and references that are remembered, in memory.
RUN_ROWS = 100_000


def in_order(rows: Iterator[Row], run_rows: int | None = None) -> Iterator[Row]:
    """Rows by time and id; more than a run of them are sorted run by run in temporary files and merged."""
    key = lambda r: (r.request_ts, r.request_id)
    run_rows = run_rows or RUN_ROWS
    run = sorted(islice(rows, run_rows), key=key)
    if len(run) < run_rows:
        yield from run
        return
    with ExitStack() as files:
        runs = []
        while run:
            file = files.enter_context(TemporaryFile())
            for row in run:
                pickle.dump(row, file, pickle.HIGHEST_PROTOCOL)
            file.seek(0)
            runs.append(_read(file, len(run)))
            run = sorted(islice(rows, run_rows), key=key)
        yield from merge(*runs, key=key)


def _read(file: Any, n: int) -> Iterator[Row]:
    for _ in range(n):
        yield pickle.load(file)


class StockKeeper(StatefulProcessor):
    """Serves the requests of one pair against its stored shelf."""

    def __init__(self, keep_for: timedelta | None = None, pair_rows: int | None = None) -> None:
        self.keep_ms = int(keep_for.total_seconds() * 1000) if keep_for else None
        self.pair_rows = pair_rows

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.stock = handle.getValueState("stock", "on_hand int, reserved int")
        held = "quantity int, balance int, closed boolean"
        self.holds = handle.getMapState("holds", "reference string", held, self.keep_ms)
        self.sales = handle.getMapState("sales", "reference string", "quantity int", self.keep_ms)

    def handleInitialState(self, key: Any, row: Row, timer: Any) -> None:
        """Opening stock, and one row per reference of the earlier ledger."""
        if row.reference is None:
            self.stock.update((row.on_hand, row.reserved))
        if row.held is not None or row.balance is not None:
            self.holds.updateValue((row.reference,), (row.held, row.balance or 0, bool(row.closed)))
        if row.sold is not None:
            self.sales.updateValue((row.reference,), (row.sold,))

    def handleInputRows(self, key: Any, rows: Iterator[Row], timer: Any) -> Iterator[Row]:
        shelf = Shelf(*self.stock.get()) if self.stock.exists() else None
        for row in in_order(self._capped(key, rows)):
            if row.error is not None:
                decision = Decision(None, error=row.error)
            elif shelf is None:
                decision = Decision(False, OUT_OF_STOCK if row.kind == SELL else None)
            else:
                self._recall(shelf, row.reference)
                decision = shelf.decide(row.kind, row.quantity, row.reference)
                if decision.applied:
                    self._keep(shelf, row.reference)
            yield Row(**{name: row[name] for name in REQUEST}, **asdict(decision))

    def _capped(self, key: Any, rows: Iterator[Row]) -> Iterator[Row]:
        for n, row in enumerate(rows, 1):
            if self.pair_rows is not None and n > self.pair_rows:
                raise ValueError(f"more than {self.pair_rows} requests of {key} in one batch; lower the batch size")
            yield row

    def _recall(self, shelf: Shelf, reference: str) -> None:
        key = (reference,)
        if len(shelf.holds) + len(shelf.sales) >= RUN_ROWS:
            # every change is in the state already
            shelf.holds.clear()
            shelf.sales.clear()
        if reference not in shelf.holds and self.holds.containsKey(key):
            shelf.holds[reference] = Hold(*self.holds.getValue(key))
        if reference not in shelf.sales and self.sales.containsKey(key):
            shelf.sales[reference] = self.sales.getValue(key)[0]

    def _keep(self, shelf: Shelf, reference: str) -> None:
        self.stock.update((shelf.on_hand, shelf.reserved))
        if reference in shelf.holds:
            hold = shelf.holds[reference]
            self.holds.updateValue((reference,), (hold.quantity, hold.balance, hold.closed))
        if reference in shelf.sales:
            self.sales.updateValue((reference,), (shelf.sales[reference],))


def opening_state(inventory: DataFrame, movements: DataFrame | None = None) -> DataFrame:
    """Rows the state starts from: one per pair, and one per reference already in the ledger."""
    stock = inventory.select(
        *PAIR, F.col("on_hand_quantity").alias("on_hand"), F.col("reserved_quantity").alias("reserved")
    )
    known = {"reference": "string", "held": "int", "balance": "int", "closed": "boolean", "sold": "int"}
    stock = stock.withColumns({name: F.lit(None).cast(kind) for name, kind in known.items()})
    if movements is None:
        return stock
    ledger = per_reference(movements).withColumns({n: F.col(n).cast("int") for n in ("held", "balance", "sold")})
    return stock.unionByName(ledger, allowMissingColumns=True)


def request_stream(spark: SparkSession, folder: str, files_per_batch: int = 8) -> DataFrame:
    """Requests as they arrive as parquet files, a limited number of files per batch."""
    reader = spark.readStream.schema(REQUESTS).option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(folder)


def decide_stream(
    requests: DataFrame,
    inventory: DataFrame,
    movements: DataFrame | None = None,
    keep_for: timedelta | None = None,
    pair_rows: int | None = None,
) -> DataFrame:
    """Decisions for a stream of RESERVE, SELL and RELEASE requests, as in the batch job."""
    asked = requests.select(*REQUEST).withColumn("error", invalid_request())
    opening = opening_state(inventory, movements).groupBy(*PAIR)
    return asked.groupBy(*PAIR).transformWithState(
        StockKeeper(keep_for, pair_rows), DECISIONS, "append", "processingTime" if keep_for else "none", opening
    )


def write_decisions(
    requests: DataFrame,
    inventory: DataFrame,
    out: str,
    checkpoint: str,
    movements: DataFrame | None = None,
    keep_for: timedelta | None = None,
    pair_rows: int | None = None,
    **trigger: Any,
) -> StreamingQuery:
    """Append decisions to parquet files; a restart from the checkpoint neither loses nor repeats any.

    Without a trigger the query takes what there is and ends. With ``keep_for`` it goes on, since Spark keeps
    looking for references whose time is up.
    """
    if keep_for and "availableNow" in trigger:
        raise ValueError("a query that forgets references does not end; choose another trigger than availableNow")
    trigger = trigger or ({"processingTime": "1 minute"} if keep_for else {"availableNow": True})
    decided = decide_stream(requests, inventory, movements, keep_for, pair_rows).select(*DECISION)
    return (
        decided.writeStream.format("parquet")
        .option("path", out)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(**trigger)
        .start()
    )
