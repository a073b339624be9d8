"""Registered queries over the star-schema tables.

Money comes out as double and dates as text, so results compare the same way in every engine.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import partial

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import DateType, DecimalType

from shelfwise.functions.retail import available_to_sell, pos_reason, pos_status, shared_id, standard_word
from shelfwise.operators import cleaning, day_counts, dimensions, facts, stock
from shelfwise.operators.staging import stage_all
from shelfwise.plans import quality, reports
from shelfwise.plans.warehouse import SAMPLE_RUN, Warehouse, latest_log, sample_warehouse
from shelfwise.session import fresh_folder, store
from shelfwise.sources import footers, linked
from shelfwise.sources.schemas import STAGED
from shelfwise.sources.star_tables import STORES, TABLE_KEYS

Query = Callable[[SparkSession, str], DataFrame]

# The pair the dashboard questions ask for.
PRODUCT, STORE = "P006", "S015"

# So small that many pairs are decided in several slices, and the busiest in several waves.
SMALL_SLICE = 3


def _plain(df: DataFrame) -> DataFrame:
    casts = {DecimalType: "double", DateType: "string"}
    return df.select(
        *[
            F.col(f.name).cast(casts[type(f.dataType)]).alias(f.name) if type(f.dataType) in casts else F.col(f.name)
            for f in df.schema.fields
        ]
    )


def _on_sources(build: Callable[[dict[str, DataFrame]], DataFrame], dirty: bool = True) -> Query:
    def query(spark: SparkSession, folder: str) -> DataFrame:
        return _plain(build(sample_warehouse(spark, folder, dirty).linked))

    return query


def _on_warehouse(build: Callable[[Warehouse], DataFrame], dirty: bool = True) -> Query:
    def query(spark: SparkSession, folder: str) -> DataFrame:
        return _plain(build(sample_warehouse(spark, folder, dirty)))

    return query


# ---- sources ----


def _drifted(sources: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """The sources after their owners renamed a column, dropped one and moved a table."""
    moved = dict(sources)
    moved["pos.pos_transaction"] = sources["pos.pos_transaction"].withColumnRenamed("total_amount", "amount")
    moved["ecommerce.customer"] = sources["ecommerce.customer"].drop("email")
    moved["pos.inventory_movement"] = moved.pop("inventory.inventory_movement")
    return moved


def _contract(sources: dict[str, DataFrame]) -> DataFrame:
    return linked.contract_check(next(iter(sources.values())).sparkSession, _drifted(sources))


def _staged(name: str) -> Query:
    return _on_sources(lambda s: stage_all(s, SAMPLE_RUN.started_at)[name].drop("extracted_at"))


# ---- cleaning and transforms ----


def _tagged(name: str) -> Query:
    return _on_warehouse(lambda dw: dw.tagged(name).drop("extracted_at", *cleaning.RESOLVED.get(name, ())))


def _standardised(sources: dict[str, DataFrame]) -> DataFrame:
    words = (
        ("online_order", sources["ecommerce.online_order"], "order_id", "order_status"),
        ("reservation", sources["ecommerce.reservation"], "reservation_id", "reservation_status"),
    )
    return linked.union_all(
        df.select(F.lit(name).alias("table_name"), F.col(i).alias("record_id"), standard_word(c).alias("status"))
        for name, df, i, c in words
    )


def _pos_words(sources: dict[str, DataFrame]) -> DataFrame:
    return sources["pos.pos_transaction"].select(
        "transaction_id",
        pos_status("transaction_status").alias("transaction_status"),
        pos_reason("rejection_reason").alias("rejection_reason"),
    )


def _line_amounts(dw: Warehouse) -> DataFrame:
    ids = (("stg_order_items", "order_item_id"), ("stg_pos_items", "transaction_item_id"))
    return linked.union_all(
        dw[name].select(F.lit(name).alias("source_table"), F.col(i).alias("record_id"), "line_amount") for name, i in ids
    )


def _ats(dw: Warehouse) -> DataFrame:
    return dw["stg_inventory"].select(
        "inventory_id", available_to_sell().alias("available_to_sell"), "source_available_to_sell"
    )


# ---- second runs ----


def _earlier_products(spark: SparkSession, folder: str) -> DataFrame:
    """A product dimension of an earlier run: smaller parts under old names, and withdrawn ones."""
    part = spark.read.parquet(f"{folder}/part.parquet")
    row = lambda key, prefix: (
        key.cast("bigint").alias("product_key"),
        shared_id(prefix, "p_partkey").alias("product_id"),
        F.concat(F.lit("OLD-"), F.col("p_partkey").cast("string")).alias("sku"),
        F.upper("p_name").alias("product_name"),
        F.lit("EARLIER").alias("category"),
        F.lit(1).cast("decimal(10,2)").alias("unit_price"),
    )
    loaded = part.where("p_size <= 30").select(*row(F.col("p_partkey") * 2 + 1, "P"))
    return loaded.unionByName(part.where("p_size > 45").select(*row(F.col("p_partkey") * 2 + 2, "PX")))


def _product_upsert(spark: SparkSession, folder: str) -> DataFrame:
    dw = sample_warehouse(spark, folder)
    return _plain(dimensions.upsert(_earlier_products(spark, folder), dw["stg_products"], "dim_product"))


def _store_upsert(spark: SparkSession, folder: str) -> DataFrame:
    dw, nation = sample_warehouse(spark, folder), spark.read.parquet(f"{folder}/nation.parquet")
    earlier = nation.where("n_regionkey <= 1").select(
        (F.col("n_nationkey") + 1).cast("bigint").alias("store_key"),
        shared_id("S", "n_nationkey").alias("store_id"),
        F.lower("n_name").alias("store_name"),
        F.lit("unknown").alias("location"),
    )
    return _plain(dimensions.upsert(earlier, dw["stg_stores"], "dim_store"))


def _customer_upsert(spark: SparkSession, folder: str) -> DataFrame:
    dw, customer = sample_warehouse(spark, folder), spark.read.parquet(f"{folder}/customer.parquet")
    earlier = customer.where("c_acctbal > 0").select(
        (F.col("c_custkey") + 1).alias("customer_key"),
        shared_id("C", "c_custkey").alias("customer_id"),
        F.upper("c_name").alias("customer_name"),
    )
    return _plain(dimensions.upsert(earlier, dw["stg_customers"], "dim_customer"))


def _new_dates(spark: SparkSession, folder: str) -> DataFrame:
    """Days to add to a calendar that an earlier run loaded for the orders alone."""
    dw, orders = sample_warehouse(spark, folder), spark.read.parquet(f"{folder}/orders.parquet")
    ends = orders.agg(F.min(F.to_date("o_orderdate")).alias("lo"), F.max(F.to_date("o_orderdate")).alias("hi"))
    earlier = ends.select(F.explode(F.sequence("lo", "hi")).alias("d")).select(*dimensions.calendar("d"))
    return _plain(dimensions.new_dates(earlier, dimensions.date_range(dw, SAMPLE_RUN.run_date)))


def _snapshot_replace(spark: SparkSession, folder: str, empty: bool = False) -> DataFrame:
    """Snapshot history after today's rows were written a second time, or were replaced by none."""
    today = sample_warehouse(spark, folder).snapshot_day()
    yesterday = today.withColumns({"date_key": F.lit(20240131), "on_hand_quantity": F.col("on_hand_quantity") + 1})
    wrong = {"reserved_quantity": F.lit(0), "available_to_sell": F.col("on_hand_quantity")}
    write = lambda day: facts.write_snapshot_day(day, fresh_folder(spark, "snapshot"))
    days = {20240131: write(yesterday.withColumn("available_to_sell", available_to_sell()))}
    days[20240201] = write(today.withColumns(wrong))
    days[20240201] = write(today.limit(0) if empty else today)
    return facts.snapshot_history(spark, days).drop("inventory_fact_key")


# ---- stock requests ----


def _lines(spark: SparkSession, folder: str) -> DataFrame:
    ref = F.concat_ws("-", *[F.col(c).cast("string") for c in ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")])
    return spark.read.parquet(f"{folder}/lineitem.parquet").select(
        ref.alias("ref"),
        shared_id("P", "l_partkey").alias("product_id"),
        shared_id("S", F.col("l_suppkey") % STORES).alias("store_id"),
        F.col("l_quantity").cast("int").alias("units"),
        F.col("l_shipdate").alias("ts"),
        "l_returnflag",
        "l_linestatus",
        "l_discount",
    )


def reserve_requests(spark: SparkSession, folder: str) -> DataFrame:
    """One hold per order line; some are repeated, some with another quantity, some are not valid."""
    flag, status = F.col("l_returnflag"), F.col("l_linestatus")
    ask = lambda n, units, days: F.struct(
        F.lit(n).alias("n"), units.cast("int").alias("quantity"), (F.col("ts") + F.expr(f"INTERVAL {days} DAY")).alias("request_ts")
    )
    first = F.when(F.col("l_discount") <= 0, F.lit(0)).otherwise(F.col("units"))
    again = F.when((flag == "A") & (status == "F"), ask(2, F.col("units"), 1)).when(
        (flag == "N") & (status == "F"), ask(2, F.col("units") + 1, 1)
    )
    asks = F.explode(F.array_compact(F.array(ask(1, first, 0), again)))
    return _lines(spark, folder).select("ref", "product_id", "store_id", asks.alias("a")).select(
        F.concat_ws("-", F.lit("H"), "ref", F.col("a.n").cast("string")).alias("request_id"),
        "a.request_ts",
        F.lit(stock.RESERVE).alias("kind"),
        "product_id",
        "store_id",
        "a.quantity",
        F.concat(F.lit("R"), "ref").alias("reference"),
    )


def release_requests(spark: SparkSession, folder: str) -> DataFrame:
    """Returned lines give their hold back, at once or in two halves."""
    half = F.floor((F.col("units") + 1) / 2).cast("int")
    ask = lambda n, units, days: F.struct(
        F.lit(n).alias("n"), units.alias("quantity"), (F.col("ts") + F.expr(f"INTERVAL {days} DAY")).alias("request_ts")
    )
    asks = F.when(F.col("l_linestatus") == "F", F.array(ask(1, F.col("units"), 3))).otherwise(
        F.array(ask(1, half, 3), ask(2, half, 4))
    )
    returned = _lines(spark, folder).where("l_returnflag = 'R'")
    return returned.select("ref", "product_id", "store_id", F.explode(asks).alias("a")).select(
        F.concat_ws("-", F.lit("L"), "ref", F.col("a.n").cast("string")).alias("request_id"),
        "a.request_ts",
        F.lit(stock.RELEASE).alias("kind"),
        "product_id",
        "store_id",
        "a.quantity",
        F.concat(F.lit("R"), "ref").alias("reference"),
    )


def sale_requests(spark: SparkSession, folder: str) -> DataFrame:
    """One sale per event; a shopper who buys the same product again repeats the reference."""
    events = spark.read.parquet(f"{folder}/events.parquet")
    product_no = F.regexp_extract("props", r"\d+", 0).cast("int")
    reference = F.concat_ws("-", F.lit("T"), F.col("user_id").cast("string"), product_no.cast("string"))
    return events.select(
        shared_id("E", "event_id").alias("request_id"),
        F.col("ts").alias("request_ts"),
        F.lit(stock.SELL).alias("kind"),
        shared_id("P", product_no).alias("product_id"),
        shared_id("S", F.col("user_id") % STORES).alias("store_id"),
        (F.col("event_id") % 4).cast("int").alias("quantity"),
        F.when((F.col("event_type") == "signup") & (F.col("value") < 1), F.lit(" ")).otherwise(reference).alias("reference"),
    )


def order_requests(spark: SparkSession, folder: str) -> DataFrame:
    events = spark.read.parquet(f"{folder}/events.parquet")
    return events.select(
        shared_id("E", "event_id").alias("request_id"),
        F.col("ts").alias("request_ts"),
        shared_id("C", "user_id").alias("customer_id"),
        shared_id("S", F.col("user_id") % STORES).alias("store_id"),
        shared_id("P", F.regexp_extract("props", r"\d+", 0).cast("int")).alias("product_id"),
        (F.col("event_id") % 8).cast("int").alias("quantity"),
    )


def earlier_ledger(sources: dict[str, DataFrame]) -> DataFrame:
    """The movements that are booked before the requests come: those of even quantities."""
    return sources["inventory.inventory_movement"].where("quantity_change % 2 = 0")


def _key_bounds(spark: SparkSession, folder: str) -> DataFrame:
    return footers.key_bounds(spark, {name: f"{folder}/{name}.parquet" for name in TABLE_KEYS}, TABLE_KEYS)


def _decided(*makers: Query, slice_rows: int = stock.SLICE_ROWS, with_ledger: bool = False) -> Query:
    def query(spark: SparkSession, folder: str) -> DataFrame:
        sources = sample_warehouse(spark, folder, dirty=False).linked
        requests = linked.union_all(make(spark, folder) for make in makers)
        movements = earlier_ledger(sources) if with_ledger else None
        decisions = stock.adjudicate(requests, sources["inventory.inventory"], movements, slice_rows)
        return decisions.select("request_id", "kind", F.col("success").cast("string"), "reason", "error", "applied")

    return query


def _after(result: Callable[[DataFrame, DataFrame], DataFrame]) -> Query:
    """Stock or ledger after holds and returns that meet the earlier ledger, decided in small slices."""

    def query(spark: SparkSession, folder: str) -> DataFrame:
        sources = sample_warehouse(spark, folder, dirty=False).linked
        requests = reserve_requests(spark, folder).unionByName(release_requests(spark, folder))
        decisions = stock.adjudicate(requests, sources["inventory.inventory"], earlier_ledger(sources), SMALL_SLICE)
        return result(sources["inventory.inventory"], store(decisions, fresh_folder(spark, "decisions")))

    return query


def faulty_ids(requests: DataFrame) -> DataFrame:
    """Of forty requests one has a blank id, one none, and two share theirs."""
    number = F.substring("request_id", 2, 30).cast("long") % 40
    shared = shared_id("E", F.substring("request_id", 2, 30).cast("long") - 1)
    broken = F.when(number == 0, F.lit(" ")).when(number == 3, shared).when(number != 1, F.col("request_id"))
    return requests.withColumn("request_id", broken)


def _orders(spark: SparkSession, folder: str, faulty: bool = False) -> DataFrame:
    """Answer per request: the new order, or why there is none."""
    requests = order_requests(spark, folder)
    placed = stock.place_orders(faulty_ids(requests) if faulty else requests, _request_sources(spark, folder))
    orders = placed["ecommerce.online_order"].select("order_id", "order_total")
    items = placed["ecommerce.order_item"].select("order_id", "product_id", F.col("quantity").cast("double"), "line_amount")
    holds = placed["ecommerce.reservation"].select("reservation_id", "expires_at")
    accepted = placed["answers"].join(holds, "reservation_id").join(orders, "order_id").join(items, "order_id")
    accepted = accepted.withColumn("error", F.lit(None).cast("string"))
    return _plain(accepted.unionByName(placed["refused"], allowMissingColumns=True))


def _sales(spark: SparkSession, folder: str, faulty: bool = False) -> DataFrame:
    """Answer per till attempt with the stored amounts, or why it was not valid."""
    requests = order_requests(spark, folder).drop("customer_id")
    sold = stock.attempt_sales(faulty_ids(requests) if faulty else requests, _request_sources(spark, folder))
    tills = sold["pos.pos_transaction"].select("transaction_id", "store_id", "total_amount")
    items = sold["pos.pos_transaction_item"].select("transaction_id", "product_id", F.col("quantity").cast("double"), "line_amount")
    stored = sold["answers"].join(tills, "transaction_id").join(items, "transaction_id").withColumn("error", F.lit(None).cast("string"))
    return _plain(stored.unionByName(sold["refused"], allowMissingColumns=True))


def _request_sources(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """Sources with the agreed stock, and the faulty customer and product ids that requests run into."""
    clean, dirty = sample_warehouse(spark, folder, dirty=False).linked, sample_warehouse(spark, folder).linked
    return {**clean, "ecommerce.customer": dirty["ecommerce.customer"], "inventory.product": dirty["inventory.product"]}


def _availability(sources: dict[str, DataFrame]) -> DataFrame:
    """Stock behind every refused sale: the pairs tills asked for."""
    tills = sources["pos.pos_transaction"].select("transaction_id", "store_id")
    asked = sources["pos.pos_transaction_item"].select("transaction_id", "product_id").join(tills, "transaction_id")
    return stock.availability(asked, sources["inventory.inventory"])


def _next_ids(sources: dict[str, DataFrame]) -> DataFrame:
    ids = (
        ("ecommerce.online_order", "order_id", "O"),
        ("pos.pos_transaction", "transaction_id", "T"),
        ("pos.pos_transaction_item", "transaction_item_id", "TI"),
        ("ecommerce.customer", "customer_id", "C"),
    )
    return linked.union_all(stock.next_shared_id(sources, *i) for i in ids)


def _rules(dw: Warehouse) -> DataFrame:
    return quality.violations(
        {**{name: dw.source(name) for name in dw.linked}, **{name: dw[name] for name in quality.RECORD_ID}}
    )


def _fact(name: str) -> Query:
    return _on_warehouse(lambda dw: dw[name].drop(dw[name].columns[0]))


def _from_days(dw: Warehouse) -> DataFrame:
    days = store(day_counts.day_counts(*[dw[name] for name in facts.FACTS]), fresh_folder(dw.spark, "day-counts"))
    return reports.omnichannel_from_days(dw["dim_store"], days)


def _run_log(dw: Warehouse) -> DataFrame:
    """The last entries of a kept log: here of two runs, of which the later one answers."""
    path = fresh_folder(dw.spark, "run-log")
    steps = store(dw.run_log(), fresh_folder(dw.spark, "run-steps"))
    for version, rows in ((1, F.lit(0).cast("bigint")), (2, F.col("rows_affected"))):
        logged = steps.withColumns({"run_id": F.lit(version) * 100 + F.col("step_no"), "rows_affected": rows})
        logged.coalesce(1).write.mode("append").parquet(path)
    return latest_log(dw.spark.read.parquet(path)).select("step", "rows_affected")


QUERIES: dict[str, Query] = {
    "link_summary": _on_sources(linked.link_summary),
    "contract_check": _on_sources(_contract),
    "source_row_counts": _on_sources(linked.row_counts),
    "table_key_bounds": _key_bounds,
    "staged_row_counts": _on_sources(
        lambda s: linked.row_counts(stage_all(s, SAMPLE_RUN.started_at), "table_name")
    ),
    "operational_counts": _on_sources(reports.operational_counts),
    "bad_status": _on_sources(linked.bad_status),
    **{f"stage_{name.removeprefix('stg_')}": _staged(name) for name in STAGED},
    "clean_dedup": _on_warehouse(
        lambda dw: cleaning.rejects("stg_customers", dw.tagged("stg_customers")).where(
            F.col("reject_reason") == "Duplicate record removed"
        )
    ),
    **{f"clean_{name.removeprefix('stg_')}": _tagged(name) for name in STAGED},
    "reject_log": _on_warehouse(lambda dw: dw.reject_log(alone=True)),
    "standardise_status": _on_sources(_standardised),
    "pos_status_map": _on_sources(_pos_words),
    "line_amount": _on_warehouse(_line_amounts),
    "ats_recalc": _on_warehouse(_ats),
    "dim_date": _on_warehouse(lambda dw: dw["dim_date"]),
    "dim_product": _on_warehouse(lambda dw: dw["dim_product"]),
    "dim_store": _on_warehouse(lambda dw: dw["dim_store"]),
    "dim_customer": _on_warehouse(lambda dw: dw["dim_customer"]),
    "dim_date_new": _new_dates,
    "dim_product_upsert": _product_upsert,
    "dim_store_upsert": _store_upsert,
    "dim_customer_upsert": _customer_upsert,
    "fact_pos_activity": _fact("fact_pos_activity"),
    "fact_online_order": _fact("fact_online_order"),
    "fact_reservation": _fact("fact_reservation"),
    "fact_inventory_snapshot": _on_warehouse(lambda dw: dw["fact_inventory_snapshot"].drop("inventory_fact_key")),
    "snapshot_replace": _snapshot_replace,
    "snapshot_replace_empty": partial(_snapshot_replace, empty=True),
    "run_log_latest": _on_warehouse(_run_log),
    "report_inventory": _on_warehouse(reports.inventory_availability),
    "report_conflicts": _on_warehouse(reports.pos_conflicts),
    "report_omnichannel": _on_warehouse(reports.omnichannel_performance),
    "omnichannel_from_days": _on_warehouse(_from_days),
    "pos_summary": _on_warehouse(reports.pos_summary),
    "orders_per_store": _on_warehouse(reports.orders_per_store),
    "reservation_summary": _on_warehouse(reports.reservation_summary),
    "last_unit_conflicts": _on_warehouse(reports.last_unit_conflicts),
    "oos_warning": _on_warehouse(reports.out_of_stock_warning),
    "conflict_check": _on_sources(reports.conflict_check),
    "inventory_rows": _on_sources(reports.inventory_rows),
    "ats_violations": _on_sources(reports.ats_violations),
    "fully_reserved": _on_sources(reports.fully_reserved),
    "blocked_reserved": _on_sources(reports.blocked_by_reservation, dirty=False),
    "dash_stock_position": _on_sources(lambda s: reports.stock_position(s, PRODUCT, STORE)),
    "dash_movements": _on_sources(lambda s: reports.recent_movements(s, PRODUCT, STORE)),
    "dash_orders": _on_sources(lambda s: reports.recent_orders(s, PRODUCT, STORE)),
    "dash_pos_attempts": _on_sources(lambda s: reports.recent_pos_attempts(s, PRODUCT, STORE)),
    "qa_checks": _on_warehouse(lambda dw: quality.qa_checks(dw, dw.linked)),
    "qa_scoreboard": _on_warehouse(lambda dw: quality.qa_scoreboard(quality.qa_checks(dw, dw.linked))),
    "qa_scoreboard_clean": _on_warehouse(lambda dw: quality.qa_scoreboard(quality.qa_checks(dw, dw.linked)), dirty=False),
    "revenue_reconcile": _on_warehouse(lambda dw: quality.revenue_reconcile(dw, dw.linked)),
    "dup_natural_keys": _on_sources(
        lambda s: quality.duplicate_natural_keys(
            {n: t for n, t in stage_all(s, SAMPLE_RUN.started_at).items() if n in dimensions.DIMENSION_SOURCE.values()}
        )
    ),
    "dq_violations": _on_warehouse(_rules),
    "ledger_position": _on_sources(lambda s: stock.ledger_position(s["inventory.inventory_movement"])),
    "reservation_balance": _on_sources(lambda s: stock.reservation_balance(s["inventory.inventory_movement"])),
    "availability_lookup": _on_sources(_availability),
    "next_shared_id": _on_sources(_next_ids),
    "adjudicate_reserve": _decided(reserve_requests),
    "adjudicate_sell": _decided(sale_requests),
    "adjudicate_release": _decided(reserve_requests, release_requests),
    "adjudicate_sliced": _decided(reserve_requests, release_requests, slice_rows=SMALL_SLICE),
    "adjudicate_with_ledger": _decided(reserve_requests, release_requests, slice_rows=SMALL_SLICE, with_ledger=True),
    "stock_after_requests": _after(
        lambda inventory, decisions: stock.stock_after(inventory, decisions).select(
            "inventory_id", "on_hand_quantity", "reserved_quantity", "available_to_sell"
        )
    ),
    "ledger_after_requests": _after(lambda inventory, decisions: stock.movements_of(decisions)),
    "adjudicate_orders": _orders,
    "adjudicate_pos": _sales,
    "adjudicate_orders_faulty": partial(_orders, faulty=True),
    "adjudicate_pos_faulty": partial(_sales, faulty=True),
}
