"""Stock requests decided in bulk, and the ledger views behind them.

Requests on one product and store are served in order, and a refused request uses no stock, so a
running sum cannot decide them. Pairs are independent: Spark shuffles the requests by pair and each
task walks its sorted rows once. A pair with more than ``slice_rows`` requests is cut into slices,
so that no task ever holds a whole hot pair:

* a slice is decided from the stock and ledger that earlier slices left;
* slices that cannot exhaust the stock even if every request is accepted, and all that follow once
  nothing can be accepted any more, do not depend on each other through the stock: they are decided
  side by side in one wave;
* a few short slices, if no more are left, are walked in a row: each of their openings is what the one before leaves;
* where stock stays scarce and comes back, slices are tried side by side from guessed openings, and only those whose
  opening turns out different are decided again (``trials``).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F
from pyspark.sql.types import StructType

from shelfwise.functions.retail import MONEY, id_number, line_amount, movement_effect, shared_id
from shelfwise.operators.cleaning import known_ids
from shelfwise.operators.keys import duplicated, number_rows, require_unique
from shelfwise.operators.shelf import OUT_OF_STOCK, RELEASE, RESERVE, SELL, Shelf
from shelfwise.operators.trials import FIRST_WIDTH, GROWTH, PAIR, PRIOR, SLICE, TRIES, checked, priors, tried
from shelfwise.session import fresh_folder, store
from shelfwise.sources.linked import union_all

ORDER = ["request_ts", "request_id"]
REQUEST = ["request_id", "request_ts", "kind", *PAIR, "quantity", "reference"]
DECISION = [*REQUEST, "success", "reason", "error", "applied"]
CARRIED, MARGINS = ["slice", "trial", "wave"], ["least_on_hand", "least_spare"]
SLICE_ROWS = 200_000
# A wave costs more than a walk of this many requests, so a pair's last slices are walked in a row if they have no more.
ROW_REQUESTS = 100

# Refusals of requests that are not valid.
_QUANTITY_ERROR = {
    RESERVE: "Reservation quantity must be greater than zero",
    SELL: "Sale quantity must be greater than zero",
    RELEASE: "Release quantity must be greater than zero",
}
_REFERENCE_ERROR = {
    RESERVE: "Reservation reference is required",
    SELL: "Transaction reference is required",
    RELEASE: "Reservation reference is required",
}
# The ledger row a request writes.
_MOVEMENT = {
    RESERVE: ("ONLINE_RESERVATION", -1, "ECOMMERCE"),
    SELL: ("POS_SALE", -1, "POS"),
    RELEASE: ("RESERVATION_RELEASE", 1, "ECOMMERCE"),
}


# ---- ledger ----


def per_reference(movements: DataFrame) -> DataFrame:
    """What the ledger says about each reference of a pair."""
    online, moved = F.col("source_system") == "ECOMMERCE", F.col("movement_type")
    change = F.col("quantity_change")
    reserved = online & (moved == "ONLINE_RESERVATION")
    touched = online & moved.isin("ONLINE_RESERVATION", "RESERVATION_RELEASE", "RESERVATION_COLLECTION")
    return (
        movements.where(F.col("source_reference_id").isNotNull())
        .groupBy(*PAIR, F.col("source_reference_id").alias("reference"))
        .agg(
            F.max(F.when(reserved, -change)).alias("held"),
            F.sum(F.when(touched, movement_effect("reserved"))).cast("bigint").alias("balance"),
            F.bool_or(online & moved.isin("RESERVATION_RELEASE", "RESERVATION_COLLECTION")).alias("closed"),
            F.max(F.when((F.col("source_system") == "POS") & (moved == "POS_SALE"), -change)).alias("sold"),
        )
    )


def _folded(ledger: DataFrame | None, movements: DataFrame) -> DataFrame:
    """A ledger summary with further movements added to it."""
    added = per_reference(movements)
    if ledger is None:
        return added
    return (
        ledger.unionByName(added)
        .groupBy(*PAIR, "reference")
        .agg(
            F.max("held").alias("held"), F.sum("balance").alias("balance"), F.bool_or("closed").alias("closed"),
            F.max("sold").alias("sold"),
        )
    )


def reservation_balance(movements: DataFrame) -> DataFrame:
    """Units each reservation reference still holds."""
    known = per_reference(movements).where(F.col("balance").isNotNull())
    return known.select(*PAIR, "reference", F.col("balance").cast("bigint").alias("balance"))


def ledger_position(movements: DataFrame) -> DataFrame:
    """Stock per pair as the movements alone explain it."""
    total = lambda kind: F.sum(movement_effect(kind)).cast("bigint")
    position = movements.groupBy(*PAIR).agg(total("on_hand").alias("on_hand"), total("reserved").alias("reserved"))
    return position.withColumn("available", F.col("on_hand") - F.col("reserved"))


def availability(pairs: DataFrame, inventory: DataFrame) -> DataFrame:
    """Stock for each asked pair; pairs without an inventory row have no answer."""
    stock = inventory.select(
        *PAIR,
        F.col("on_hand_quantity").alias("out_on_hand"),
        F.col("reserved_quantity").alias("out_reserved"),
        F.col("available_to_sell").alias("out_available"),
    )
    return pairs.join(stock, PAIR)


# ---- decisions ----


def _by_kind(texts: dict[str, str]) -> Column:
    return F.coalesce(*[F.when(F.col("kind") == kind, F.lit(text)) for kind, text in texts.items()])


def invalid_request() -> Column:
    """Message for a request that is refused whatever the stock, else NULL."""
    blank = F.col("reference").isNull() | (F.btrim("reference") == "")
    return F.when(F.col("quantity").isNull() | (F.col("quantity") <= 0), _by_kind(_QUANTITY_ERROR)).when(
        blank, _by_kind(_REFERENCE_ERROR)
    )


def _margins(shelf: Shelf, kind: str, quantity: int, reference: str, applied: bool, success: bool | None) -> tuple:
    """Stock on hand at a refused sale; reserved stock that a release leaves, or that it lacks."""
    if kind == SELL:
        return (shelf.on_hand if success is False else None), None
    if kind == RELEASE:
        hold = shelf.holds.get(reference)
        if applied:
            return None, shelf.reserved
        if hold is not None and hold.balance >= quantity:
            return None, shelf.reserved - quantity
    return None, None


def _values(column: pa.Array) -> list:
    """Python values of a column; whole numbers without gaps go through numpy, which takes a fraction of the time."""
    if column.null_count or not pa.types.is_integer(column.type):
        return column.to_pylist()
    return column.to_numpy().tolist()


def _walker(carried: list[str], booked: bool):
    """Decide sorted rows; a new shelf starts at the first row of each group.

    ``carried`` columns go through; with them come the margins of the decision. ``booked`` says that the rows bring what
    an earlier ledger knows about their reference.
    """
    needed = ("_seq", "kind", "quantity", "reference", "on_hand", "reserved", *(PRIOR if booked else ()))

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shelf = Shelf(0, 0)
        for batch in batches:
            rows = zip(*[_values(batch.column(name)) for name in needed])
            results, margins = [], []
            for seq, kind, quantity, reference, on_hand, reserved, *prior in rows:
                if seq == 1:
                    shelf = Shelf(on_hand, reserved)
                if booked:
                    shelf.learn(reference, *prior)
                result = shelf.decide(kind, quantity, reference)
                results.append(result)
                if carried:
                    margins.append(_margins(shelf, kind, quantity, reference, result.applied, result.success))
            columns = [batch.column(name) for name in REQUEST] + [
                pa.array([r.success for r in results], pa.bool_()),
                pa.array([r.reason for r in results], pa.string()),
                pa.array([r.error for r in results], pa.string()),
                pa.array([r.applied for r in results], pa.bool_()),
            ]
            names = DECISION
            if carried:
                columns += [batch.column(name) for name in carried]
                columns += [pa.array([m[i] for m in margins], pa.int64()) for i in (0, 1)]
                names = [*DECISION, *carried, *MARGINS]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return walk


def _decide(rows: DataFrame, group: list[str], carried: list[str] = []) -> DataFrame:
    """Serial decisions per group. The window needs the same shuffle and order as the walk, so the
    sort after it costs nothing and rows of a group meet in one task."""
    kinds = dict(rows.dtypes)
    schema = ", ".join(f"{name} {kinds[name]}" for name in REQUEST) + ", success boolean, reason string, error string, applied boolean"
    if carried:
        schema += "".join(f", {name} {kinds[name]}" for name in carried) + "".join(f", {name} bigint" for name in MARGINS)
    ordered = rows.withColumn("_seq", F.row_number().over(Window.partitionBy(*group).orderBy(*ORDER)))
    return ordered.sortWithinPartitions(*group, *ORDER).mapInArrow(_walker(carried, set(PRIOR) <= set(kinds)), schema)


def _with_priors(rows: DataFrame, ledger: DataFrame | None) -> DataFrame:
    if ledger is None:
        none = {"held": "bigint", "balance": "bigint", "closed": "boolean", "sold": "bigint"}
        return rows.withColumns({name: F.lit(None).cast(kind) for name, kind in none.items()})
    return rows.join(ledger, [*PAIR, "reference"], "left")


def adjudicate(
    requests: DataFrame, inventory: DataFrame, movements: DataFrame | None = None, slice_rows: int = SLICE_ROWS
) -> DataFrame:
    """Decide RESERVE, SELL and RELEASE requests against the stock, in (request_ts, request_id) order.

    ``request_id`` must be unique. The result is computed when used: write it before using it twice.

    ``success`` is NULL where ``error`` says why the request is not valid. ``applied`` marks the
    requests that changed stock; a repeated reference succeeds without being applied again.
    """
    spark = requests.sparkSession
    folder = fresh_folder(spark, "adjudicate")
    stock = inventory.select(
        *PAIR, F.col("on_hand_quantity").alias("on_hand"), F.col("reserved_quantity").alias("reserved")
    )
    stock = store(stock, f"{folder}/stock")
    require_unique(stock, PAIR, "inventory")
    ledger = None if movements is None else store(per_reference(movements), f"{folder}/ledger")

    asked = requests.select(*REQUEST).withColumn("error", invalid_request())
    valid = F.col("error").isNull()
    # counted before the requests meet the stock, so that they learn with it whether their pair is hot
    sizes = asked.where(valid).groupBy(*PAIR).agg(F.count(F.lit(1)).alias("_rows"))
    hot = sizes.where(F.col("_rows") > slice_rows).join(stock.where(F.col("on_hand").isNotNull()), PAIR)
    hot = store(hot.select(*PAIR, F.lit(True).alias("hot")), f"{folder}/hot_pairs")
    is_cold = hot.isEmpty()
    marked = stock.withColumn("hot", F.lit(None).cast("boolean")) if is_cold else stock.join(hot, PAIR, "left")
    # all requests meet the ledger at once, before they are told apart
    asked = asked if ledger is None else _with_priors(asked, ledger)
    asked = store(asked.join(marked, PAIR, "left"), f"{folder}/requests")
    undecided = valid & F.col("on_hand").isNotNull()
    direct = asked.where(~undecided).select(
        *REQUEST,
        F.when(valid, F.lit(False)).alias("success"),
        F.when(valid & (F.col("kind") == SELL), F.lit(OUT_OF_STOCK)).alias("reason"),
        "error",
        F.lit(False).alias("applied"),
    )
    open_requests = asked.where(undecided)
    cold = open_requests.where(F.col("hot").isNull()).drop("error", "hot")
    decided = direct.unionByName(_decide(cold, PAIR))
    if is_cold:
        return decided
    busy = open_requests.where("hot").drop("error", "hot", "on_hand", "reserved")
    return decided.unionByName(_decide_slices(busy, stock, ledger, slice_rows, folder))


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Add ``_nth``: how many rows of the same pair come before a row in its partition, which is sorted by pair."""
    last, seen = None, 0
    for batch in batches:
        if not batch.num_rows:
            continue
        pairs = [batch.column(name) for name in PAIR]
        changed = np.zeros(batch.num_rows, dtype=bool)
        for column in pairs:
            changed[1:] |= pc.not_equal(column[1:], column[:-1]).to_numpy(zero_copy_only=False)
        starts = np.where(changed, np.arange(batch.num_rows), 0)
        nth = np.arange(batch.num_rows) - np.maximum.accumulate(starts)
        if [column[0].as_py() for column in pairs] == last:
            first_run = np.argmax(changed) if changed.any() else batch.num_rows
            nth[:first_run] += seen
        last, seen = [column[-1].as_py() for column in pairs], int(nth[-1]) + 1
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(nth, pa.int64())], names=[*batch.schema.names, "_nth"])


def _slices(busy: DataFrame, slice_rows: int, folder: str) -> DataFrame:
    """Number the requests of each pair and cut them into slices of ``slice_rows``.

    Range partitions split a pair by time, so its rows are numbered by many tasks. Few pairs lie in more than one
    partition, one per partition at most, and only those need an offset.
    """
    slotted = busy.repartitionByRange(*PAIR, *ORDER).sortWithinPartitions(*PAIR, *ORDER)
    schema = ", ".join(f"{name} {kind}" for name, kind in slotted.dtypes) + ", _nth bigint"
    slotted = slotted.mapInArrow(_runs, schema).withColumn("_part", F.spark_partition_id())
    slotted = store(slotted, f"{folder}/slots")
    before = Window.partitionBy(*PAIR).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    parts = slotted.groupBy(*PAIR, "_part").agg(F.count(F.lit(1)).alias("_rows"))
    offsets = parts.select(*PAIR, "_part", F.sum("_rows").over(before).alias("_before")).where("_before IS NOT NULL")
    offsets = store(offsets, f"{folder}/offsets")
    position = F.coalesce("_before", F.lit(0)) + F.col("_nth")
    numbered = slotted.join(F.broadcast(offsets), [*PAIR, "_part"], "left")
    numbered = numbered.withColumn("slice", F.floor(position / slice_rows).cast("bigint"))
    path, columns = f"{folder}/slices", [*busy.columns, "slice"]
    numbered.select(*columns).write.partitionBy("slice").parquet(path)
    return busy.sparkSession.read.schema(numbered.select(*columns).schema).parquet(path)


def _decide_slices(busy: DataFrame, stock: DataFrame, ledger: DataFrame | None, slice_rows: int, folder: str) -> DataFrame:
    """Decide hot pairs wave by wave, each from the next slice that is still open for it.

    Each wave is written and the next one starts from those files. What lies ahead of a pair is known
    from one summary row per slice, so a wave reads only the slices it decides. ``busy`` has brought along what the
    ledger says before any request is decided.
    """
    spark = busy.sparkSession
    opened = _slices(busy, slice_rows, folder)
    slices = opened.select(*REQUEST, "slice")
    takes, units = F.col("kind") != RELEASE, F.col("quantity").cast("bigint")
    summary = slices.groupBy(*PAIR, "slice").agg(
        F.min(F.when(takes, units)).alias("least"),
        F.coalesce(F.sum(F.when(takes, units)), F.lit(0)).alias("wanted"),
        F.count_if(~takes).alias("releases"),
        F.coalesce(F.sum(F.when(~takes, units)), F.lit(0)).alias("returned"),
    )
    summary = store(summary, f"{folder}/summary")
    ends = summary.groupBy(*PAIR).agg(F.max("slice").alias("last_slice"))
    # only what is not walked in a row may be separable
    long = store(ends.where(~_fits_a_row(F.col("last_slice") + 1, slice_rows)).select(*PAIR), f"{folder}/long_pairs")
    longest = slices.join(long, PAIR, "left_semi").groupBy(*PAIR, "reference").agg(F.count(F.lit(1)).alias("n"))
    state = stock.join(ends, PAIR).join(longest.groupBy(*PAIR).agg(F.max("n").alias("longest_reference")), PAIR, "left")
    covered = F.lit(True)
    if ledger is not None:
        ledger = store(ledger.join(long, PAIR, "left_semi"), f"{folder}/ledger-0")
        booked = ledger.groupBy(*PAIR).agg(F.sum(F.greatest("balance", F.lit(0))).alias("booked"))
        state, covered = state.join(booked, PAIR, "left"), F.col("reserved") >= F.coalesce("booked", F.lit(0))
    # Where the reserved stock covers all open references, releases never fail for lack of it.
    state = state.select(
        *PAIR,
        "on_hand",
        "reserved",
        F.coalesce(covered & (F.col("longest_reference") <= slice_rows), F.lit(False)).alias("separable"),
        F.lit(0).cast("bigint").alias("next_slice"),
        F.lit(FIRST_WIDTH).cast("bigint").alias("width"),
    )
    state = store(state, f"{folder}/state-0")

    decided: list[str] = []
    settled: list[DataFrame] = []
    tries = None
    while not state.isEmpty():
        wave = len(decided)
        numbered = {"wave": F.lit(wave)}
        plan = store(_outlook(state, summary, slice_rows), f"{folder}/plan-{wave}")
        in_row, trial = F.col("apart_by") == "row", F.col("apart_by") == "trial"
        ways = plan.groupBy(in_row.alias("row")).agg(F.min("next_slice"), F.max("until"), F.bool_or(trial)).collect()
        ways = {way: found for way, *found in ways}
        # apart from the short pairs, so that Spark sees how few the others are
        rest = store(plan.where(~in_row), f"{folder}/rest-{wave}") if True in ways else plan
        # one row per slice that is due, so a wave reads a pair's own slices only
        due = rest.withColumn("slice", F.explode(F.sequence("next_slice", "until")))
        first, last, on_trial = ways.get(False, (0, -1, False))
        near = slices.where(F.col("slice").between(first, last))
        lane = F.when(F.col("apart_by") == "reference", F.col("reference")).otherwise(F.col("slice").cast("string"))
        sure = _with_priors(near.join(due.where(~trial), SLICE).withColumn("lane", lane), ledger)
        columns = [*REQUEST, "slice", "lane", "on_hand", "reserved", *PRIOR]
        rows = sure.select(*columns, F.lit(False).alias("trial"))
        onward = rest.where(~trial & (F.col("until") < F.col("last_slice"))).select(
            *PAIR, (F.col("until") + 1).alias("next_slice"), F.lit(FIRST_WIDTH).cast("bigint").alias("width")
        )
        past = None
        if on_trial:
            oldest = tries.agg(F.min("wave")).first()[0] if tries is not None else None
            tries = tries if oldest is not None else _none(spark, TRIES)
            past = _tries_of(slices, decided, oldest)
            asked = due.where(trial)
            known = priors(near.join(asked.select(*SLICE), SLICE), past.join(tries, [*SLICE, "wave"], "left_semi"), ledger)
            known = store(known, f"{folder}/priors-{wave}")
            checks = store(checked(asked.drop("apart_by", "until"), tries, known, summary), f"{folder}/checks-{wave}")
            again = checks.where("again")
            opening = again.select(*SLICE, F.col("open_on_hand").alias("on_hand"), F.col("open_reserved").alias("reserved"))
            retried = near.join(opening, SLICE).join(known, [*SLICE, "reference"], "left")
            retried = retried.withColumn("lane", F.col("slice").cast("string"))
            rows = rows.unionByName(retried.select(*columns, F.lit(True).alias("trial")))
            # tries whose openings have come true
            final = store(checks.where("final").select(*SLICE, "wave"), f"{folder}/final-{wave}")
            settled.append(final)
            gone = F.col("next_slice") + F.col("n_final")
            further = checks.where(gone <= F.col("last_slice"))
            onward = onward.unionByName(further.select(*PAIR, gone.alias("next_slice"), F.col("next_width").alias("width")).distinct())
        parts = [_decide(rows.withColumns(numbered), [*PAIR, "lane"], CARRIED)] if False in ways else []
        if True in ways:
            short = plan.where(in_row).select(*PAIR, "next_slice", "on_hand", "reserved")
            ahead = (slices if wave else opened).where(F.col("slice").between(*ways[True][:2])).join(short, PAIR)
            ahead = ahead.where(F.col("slice") >= F.col("next_slice")).drop("next_slice")
            # requests have brought along what the ledger said before the first wave
            ahead = _with_priors(ahead, ledger) if wave else ahead
            parts.append(_decide(ahead.withColumns({"trial": F.lit(False), **numbered}), PAIR, CARRIED))
        decisions = store(union_all(parts), f"{folder}/decided-{wave}")
        decided.append(f"{folder}/decided-{wave}")

        onward = store(onward, f"{folder}/onward-{wave}")
        if onward.isEmpty():
            break
        # only pairs that go on are looked at again; final decisions of earlier waves are not read again
        left = lambda df: df.join(onward.select(*PAIR), PAIR, "left_semi")
        added = left(decisions)
        if on_trial:
            kept = checks.where("stands").select(*tries.columns)
            tries = kept.unionByName(tried(decisions.where("trial"), again, wave).select(*tries.columns))
            tries = store(tries, f"{folder}/tries-{wave}")
            added = left(decisions.where(~F.col("trial"))).unionByName(
                left(decisions.where("trial").unionByName(past)).join(final, [*SLICE, "wave"], "left_semi")
            )
        state = _moved(state.drop("next_slice", "width").join(onward, PAIR), added, "on_hand", "reserved")
        state = store(state, f"{folder}/state-{wave + 1}")
        ledger = _folded(None if ledger is None else left(ledger), movements_of(added))
        ledger = store(ledger, f"{folder}/ledger-{wave + 1}")
        summary = summary.join(onward.select(*PAIR, "next_slice"), PAIR).where(F.col("slice") >= F.col("next_slice")).drop("next_slice")
        summary = store(summary, f"{folder}/summary-{wave + 1}")
    result = spark.read.schema(decisions.schema).parquet(*decided)
    certain = result.where(~F.col("trial")).select(*DECISION)
    if not settled:
        return certain
    came_true = result.where("trial").join(union_all(settled), [*SLICE, "wave"], "left_semi")
    return certain.unionByName(came_true.select(*DECISION))


def _none(spark: SparkSession, schema: str | StructType) -> DataFrame:
    """No rows, which Spark knows when it plans: joins with them cost nothing."""
    return spark.createDataFrame([], schema).limit(0)


def _tries_of(slices: DataFrame, decided: list[str], oldest: int | None) -> DataFrame:
    """Decisions since the oldest wave that has tries, or no rows where none has."""
    spark, carried = slices.sparkSession, "success boolean, reason string, error string, applied boolean, trial boolean, wave int"
    empty = _none(spark, slices.schema).withColumns(
        {name: F.lit(None).cast(kind) for name, kind in (field.split() for field in carried.split(", "))}
        | {name: F.lit(None).cast("bigint") for name in MARGINS}
    )
    schema = empty.select(*DECISION, *CARRIED, *MARGINS).schema
    return _none(spark, schema) if oldest is None else spark.read.schema(schema).parquet(*decided[oldest:])


def _fits_a_row(slices: Column, slice_rows: int) -> Column:
    """Whether that many slices are walked in a row: as many as a first wave would try, and short."""
    return (slices <= FIRST_WIDTH) & (slices * slice_rows <= ROW_REQUESTS)


def _outlook(state: DataFrame, summary: DataFrame, slice_rows: int) -> DataFrame:
    """Which slices of each pair come next, up to ``until``, and how they may be decided.

    All that are left in a ``row``, when they are few and short; all, each ``slice`` apart, when nothing fits any more
    and nothing comes back; the longest run that cannot exhaust the stock, each ``reference`` apart; else those within reach of a ``trial``.
    """
    free = F.col("on_hand") - F.col("reserved")
    in_order = Window.partitionBy(*PAIR).orderBy("slice")
    ahead = summary.join(state, PAIR).where(F.col("slice") >= F.col("next_slice"))
    ahead = ahead.withColumn("running", F.sum("wanted").over(in_order))
    ahead = ahead.groupBy(*PAIR, "on_hand", "reserved", "separable", "next_slice", "width").agg(
        F.max("slice").alias("last_slice"),
        F.min("least").alias("least"),
        F.sum("releases").alias("releases"),
        F.max(F.when(F.col("running") <= free, F.col("slice"))).alias("enough"),
    )
    closed = (F.col("releases") == 0) & (free < F.col("least"))
    plentiful = F.col("separable") & F.col("enough").isNotNull()
    in_row = _fits_a_row(F.col("last_slice") - F.col("next_slice") + 1, slice_rows)
    reach = F.least("last_slice", F.col("next_slice") + (GROWTH + 1) * F.col("width"))
    return ahead.select(
        *PAIR,
        "on_hand",
        "reserved",
        "next_slice",
        "last_slice",
        F.when(in_row | closed, F.col("last_slice")).when(plentiful, F.col("enough")).otherwise(reach).alias("until"),
        F.when(in_row, "row").when(closed, "slice").when(plentiful, "reference").otherwise("trial").alias("apart_by"),
    )


def _moved(stock: DataFrame, decisions: DataFrame, on_hand: str, reserved: str) -> DataFrame:
    """Stock after the applied decisions, summed per pair before the join."""
    applied, quantity = decisions.where("applied"), F.col("quantity")
    change = applied.groupBy(*PAIR).agg(
        F.sum(F.when(F.col("kind") == SELL, -quantity).otherwise(0)).cast("int").alias("_on_hand"),
        F.sum(F.when(F.col("kind") == RESERVE, quantity).when(F.col("kind") == RELEASE, -quantity).otherwise(0))
        .cast("int")
        .alias("_reserved"),
    )
    return (
        stock.join(change, PAIR, "left")
        .withColumns(
            {
                on_hand: F.col(on_hand) + F.coalesce("_on_hand", F.lit(0)),
                reserved: F.col(reserved) + F.coalesce("_reserved", F.lit(0)),
            }
        )
        .drop("_on_hand", "_reserved")
    )


def stock_after(inventory: DataFrame, decisions: DataFrame) -> DataFrame:
    moved = _moved(inventory, decisions, "on_hand_quantity", "reserved_quantity")
    return moved.withColumn("available_to_sell", F.col("on_hand_quantity") - F.col("reserved_quantity"))


def movements_of(decisions: DataFrame) -> DataFrame:
    """Ledger rows of the applied decisions; the id follows from the request, so a retry repeats it."""
    kind = F.col("kind")
    of = lambda field: F.coalesce(*[F.when(kind == k, F.lit(row[field])) for k, row in _MOVEMENT.items()])
    return decisions.where("applied").select(
        F.concat(F.lit("M-"), F.sha2(F.concat_ws("|", "kind", "request_id"), 256)).alias("movement_id"),
        *PAIR,
        of(0).alias("movement_type"),
        (F.col("quantity") * of(1)).alias("quantity_change"),
        of(2).alias("source_system"),
        F.col("reference").alias("source_reference_id"),
        F.col("request_ts").alias("movement_timestamp"),
    )


# ---- orders and sales: their messages, states and reasons are fixed values, but for those about request ids ----


def _highest(tables: dict[str, DataFrame], table: str, column: str) -> Column:
    highest = tables[table].agg(F.max(id_number(column)).alias("n")).first()["n"]
    return F.lit(str(highest or 0)).cast("decimal(38,0)")


def _new_id(prefix: str, highest: Column) -> Column:
    return shared_id(prefix, (highest + F.col("n")).cast("decimal(38,0)"))


def _priced(requests: DataFrame, products: DataFrame) -> DataFrame:
    known = products.select("product_id", "unit_price").where(F.col("product_id").isNotNull())
    known = store(known, fresh_folder(requests.sparkSession, "prices"))
    require_unique(known, ["product_id"], "inventory.product")
    return requests.join(known, "product_id", "left")


def _identified(requests: DataFrame, ids: DataFrame | None = None) -> DataFrame:
    """Add ``id_error``: a request without an id of its own cannot be answered, so it is refused.

    ``ids`` are those of all requests that are answered together, if there are more.
    """
    together = requests if ids is None else ids
    repeated = duplicated(together.where(F.col("request_id").isNotNull()), ["request_id"])
    repeated = store(repeated.select("request_id", F.lit(True).alias("repeated")), fresh_folder(requests.sparkSession, "repeated"))
    blank = F.col("request_id").isNull() | (F.btrim("request_id") == "")
    return (
        requests.join(repeated, "request_id", "left")
        .withColumn(
            "id_error",
            F.when(blank, F.lit("Request id is required")).when(
                F.col("repeated"), F.lit("Request id is used more than once")
            ),
        )
        .drop("repeated")
    )


def _refused(asked: DataFrame, decided: DataFrame) -> DataFrame:
    """Requests that were not valid, as asked or when they were decided."""
    return (
        asked.where(F.col("error").isNotNull())
        .select("request_id", "error")
        .unionByName(decided.where(F.col("error").isNotNull()).select("request_id", "error"))
    )


def _booked(decided: DataFrame, numbered: DataFrame, new_id: str) -> DataFrame:
    """Ledger rows that refer to the new id instead of the request."""
    ids = numbered.select(F.col("request_id").alias("source_reference_id"), F.col(new_id).alias("_new_id"))
    moves = movements_of(decided).join(ids, "source_reference_id")
    return moves.withColumn("source_reference_id", F.col("_new_id")).drop("_new_id")


def next_shared_id(linked: dict[str, DataFrame], table: str, column: str, prefix: str) -> DataFrame:
    """The id the next row of a table gets: highest number in use plus one."""
    following = (F.coalesce(F.max(id_number(column)), F.lit(0)) + 1).cast("decimal(38,0)")
    return linked[table].agg(shared_id(prefix, following).alias("next_id")).select(F.lit(table).alias("table_name"), "next_id")


def expires_at() -> Column:
    """A hold ends a day after it was asked for."""
    return F.col("request_ts") + F.expr("INTERVAL 1 DAY")


def order_forms(requests: DataFrame, linked: dict[str, DataFrame], ids: DataFrame | None = None) -> DataFrame:
    """The requests with price and ``error``: why one is refused whatever the stock, else NULL."""
    spark = requests.sparkSession
    customers = store(known_ids(linked["ecommerce.customer"], "customer_id"), fresh_folder(spark, "known-customers"))
    customers = customers.select(F.col("known_id").alias("customer_id"), F.lit(True).alias("known"))
    asked = _priced(_identified(requests, ids), linked["inventory.product"]).join(customers, "customer_id", "left")
    error = (
        F.when(F.col("id_error").isNotNull(), F.col("id_error"))
        .when(F.col("quantity").isNull() | (F.col("quantity") <= 0), F.lit("Quantity must be greater than zero"))
        .when(F.col("known").isNull(), F.concat(F.lit("Unknown customer "), F.coalesce("customer_id", F.lit("<NULL>"))))
        .when(F.col("unit_price").isNull(), F.concat(F.lit("Unknown product "), F.coalesce("product_id", F.lit("<NULL>"))))
    )
    return store(asked.withColumn("error", error).drop("known", "id_error"), fresh_folder(spark, "orders"))


def sale_forms(requests: DataFrame, linked: dict[str, DataFrame], ids: DataFrame | None = None) -> DataFrame:
    """As ``order_forms`` for till sales, which have no customer."""
    error = F.when(F.col("id_error").isNotNull(), F.col("id_error")).when(
        F.col("quantity").isNull() | (F.col("quantity") <= 0), F.lit("Quantity must be greater than zero")
    ).when(F.col("unit_price").isNull(), F.concat(F.lit("Unknown product "), F.coalesce("product_id", F.lit("<NULL>"))))
    asked = _priced(_identified(requests, ids), linked["inventory.product"]).withColumn("error", error).drop("id_error")
    return store(asked, fresh_folder(requests.sparkSession, "sales"))


def asks(forms: DataFrame, kind: str) -> DataFrame:
    """The stock requests of valid forms."""
    valid = forms.where(F.col("error").isNull()).drop("error")
    return valid.withColumns({"kind": F.lit(kind), "reference": F.col("request_id")})


def _orders_of(asked: DataFrame, decided: DataFrame, linked: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """Rows for accepted orders, the answers, what was refused, and the ledger rows."""
    valid = asked.where(F.col("error").isNull()).drop("error")
    accepted = valid.join(decided.where("success").select("request_id"), "request_id")
    numbered = number_rows(accepted, ORDER, "n")
    numbered = numbered.select(
        "*",
        _new_id("O", _highest(linked, "ecommerce.online_order", "order_id")).alias("order_id"),
        _new_id("OI", _highest(linked, "ecommerce.order_item", "order_item_id")).alias("order_item_id"),
        _new_id("R", _highest(linked, "ecommerce.reservation", "reservation_id")).alias("reservation_id"),
        line_amount().alias("line_amount"),
    )
    short = F.format_string("Not enough available stock to reserve %d x %s at %s", "quantity", "product_id", "store_id")
    unserved = valid.join(decided.where(~F.col("success")).select("request_id"), "request_id").select(
        "request_id", short.alias("error")
    )
    return {
        "ecommerce.online_order": numbered.select(
            "order_id",
            "customer_id",
            F.col("store_id").alias("fulfilment_store_id"),
            F.lit("CONFIRMED").alias("order_status"),
            F.col("line_amount").alias("order_total"),
            F.col("request_ts").alias("created_at"),
            F.col("request_ts").alias("updated_at"),
        ),
        "ecommerce.order_item": numbered.select(
            "order_item_id", "order_id", "product_id", "quantity", "unit_price", "line_amount"
        ),
        "ecommerce.reservation": numbered.select(
            "reservation_id",
            "order_id",
            "product_id",
            "store_id",
            "quantity",
            F.lit("ACTIVE").alias("reservation_status"),
            F.col("request_ts").alias("created_at"),
            expires_at().alias("expires_at"),
            F.lit(None).cast("timestamp_ntz").alias("released_at"),
        ),
        "answers": numbered.select(
            "request_id",
            "order_id",
            "reservation_id",
            F.lit("CONFIRMED").alias("order_status"),
            F.lit("ACTIVE").alias("reservation_status"),
        ),
        "refused": _refused(asked, decided).unionByName(unserved),
        "inventory.inventory_movement": _booked(decided, numbered, "reservation_id"),
    }


def place_orders(requests: DataFrame, linked: dict[str, DataFrame], slice_rows: int = SLICE_ROWS) -> dict[str, DataFrame]:
    """Online orders for one product each: accepted only if the whole quantity can be reserved.

    Input: request_id, request_ts, customer_id, store_id, product_id, quantity. Ids count up from the
    highest in use, in request order, over accepted requests only. Output: the rows to append to each
    source table, the stock afterwards, and for every request either its ``answers`` row or why it was
    ``refused``. Requests that share an id are all refused, since no answer could be told apart.
    """
    asked = order_forms(requests, linked)
    decided = adjudicate(asks(asked, RESERVE), linked["inventory.inventory"], slice_rows=slice_rows)
    decided = store(decided, fresh_folder(requests.sparkSession, "order-holds"))
    stock = stock_after(linked["inventory.inventory"], decided)
    return {**_orders_of(asked, decided, linked), "inventory.inventory": stock}


def _sales_of(asked: DataFrame, decided: DataFrame, linked: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """Rows for all valid attempts, the answers, what was refused, and the ledger rows."""
    valid = asked.where(F.col("error").isNull()).drop("error")
    answered = decided.where(F.col("error").isNull()).select("request_id", "success", "reason")
    answered = valid.join(answered, "request_id")
    numbered = number_rows(answered, ORDER, "n")
    numbered = numbered.select(
        "*",
        _new_id("T", _highest(linked, "pos.pos_transaction", "transaction_id")).alias("transaction_id"),
        _new_id("TI", _highest(linked, "pos.pos_transaction_item", "transaction_item_id")).alias("transaction_item_id"),
        F.when(F.col("success"), "COMPLETED").otherwise("BLOCKED").alias("transaction_status"),
        # a blocked sale always has a reason
        F.when(F.col("success"), F.col("reason")).otherwise(F.coalesce("reason", F.lit(OUT_OF_STOCK))).alias("rejection_reason"),
        line_amount().alias("line_amount"),
    )
    return {
        "pos.pos_transaction": numbered.select(
            "transaction_id",
            "store_id",
            F.col("request_ts").alias("transaction_timestamp"),
            "transaction_status",
            "rejection_reason",
            F.when(F.col("success"), F.col("line_amount")).otherwise(F.lit(0)).cast(MONEY).alias("total_amount"),
        ),
        "pos.pos_transaction_item": numbered.select(
            "transaction_item_id", "transaction_id", "product_id", "quantity", "unit_price", "line_amount"
        ),
        "answers": numbered.select("request_id", "transaction_id", "transaction_status", "rejection_reason"),
        "refused": _refused(asked, decided),
        "inventory.inventory_movement": _booked(decided, numbered, "transaction_id"),
    }


def attempt_sales(requests: DataFrame, linked: dict[str, DataFrame], slice_rows: int = SLICE_ROWS) -> dict[str, DataFrame]:
    """Till sales of one product each. Every valid attempt is stored, blocked ones with total 0.00.

    Input: request_id, request_ts, store_id, product_id, quantity. Every request comes back once, in
    ``answers`` or ``refused``; those that share an id are all refused.
    """
    asked = sale_forms(requests, linked)
    decided = adjudicate(asks(asked, SELL), linked["inventory.inventory"], slice_rows=slice_rows)
    decided = store(decided, fresh_folder(requests.sparkSession, "sale-decisions"))
    stock = stock_after(linked["inventory.inventory"], decided)
    return {**_sales_of(asked, decided, linked), "inventory.inventory": stock}


def serve_forms(
    orders: DataFrame, sales: DataFrame, linked: dict[str, DataFrame], slice_rows: int = SLICE_ROWS
) -> tuple[dict[str, DataFrame], dict[str, DataFrame], DataFrame]:
    """Orders and till sales that compete for the same stock, served in the order of their times and ids.

    Returns what ``place_orders`` and ``attempt_sales`` return but for the stock, and the decisions on both.
    """
    ids = orders.select("request_id").unionByName(sales.select("request_id"))
    asked_orders, asked_sales = order_forms(orders, linked, ids), sale_forms(sales, linked, ids)
    both = [asks(asked_orders, RESERVE).select(*REQUEST), asks(asked_sales, SELL).select(*REQUEST)]
    decided = adjudicate(union_all(both), linked["inventory.inventory"], slice_rows=slice_rows)
    decided = store(decided, fresh_folder(orders.sparkSession, "form-decisions"))
    of = lambda kind: decided.where(F.col("kind") == kind)
    return _orders_of(asked_orders, of(RESERVE), linked), _sales_of(asked_sales, of(SELL), linked), decided
