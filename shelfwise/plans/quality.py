"""Reconciliation tests after a load, and the declared constraints as data-quality rules."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from shelfwise.functions.retail import is_last_unit_conflict, standard_word
from shelfwise.operators.dimensions import DIMENSION_SOURCE
from shelfwise.plans.reports import PAIR, latest_snapshot
from shelfwise.session import fresh_folder, store
from shelfwise.sources.linked import union_all
from shelfwise.sources.schemas import ORDER_STATUSES, POS_REASONS, POS_STATUSES, RESERVATION_STATUSES, SOURCES

Tables = Mapping[str, DataFrame]

def _rows() -> Column:
    return F.count(F.lit(1))


# Checklist items and the tests behind each.
CHECKLIST = (
    (1, "ETL executes", [21, 22]),
    (2, "Dimensions load", [1, 2, 3]),
    (3, "Facts load", [4, 5, 6, 7]),
    (4, "Surrogate keys resolve", [10]),
    (5, "ATS calculation correct", [11, 12, 13, 14]),
    (6, "POS conflict works", [15, 16, 17, 18, 20]),
    (7, "Reservation cancellation works", [19]),
    (8, "Dashboard totals reconcile", [8, 9]),
)

# Test names as they appear in the failed_tests column.
TEST_NAMES = {
    1: "Dimensions load: DIM_PRODUCT = stg_products",
    2: "Dimensions load: DIM_STORE = stg_stores",
    3: "Dimensions load: DIM_CUSTOMER = stg_customers",
    4: "Facts load: FACT_POS_ACTIVITY = stg_pos_items",
    5: "Facts load: FACT_ONLINE_ORDER = stg_order_items",
    6: "Facts load: FACT_RESERVATION = stg_reservations",
    7: "Facts load: FACT_INVENTORY_SNAPSHOT = stg_inventory",
    8: "Revenue reconciles: completed POS line_amount = source",
    9: "On-hand total reconciles with source INVENTORY",
    10: "Surrogate keys resolve: no NULL keys in any fact",
    11: "ATS calculation correct: ATS = on_hand - reserved (all rows)",
    12: "ATS matches source available_to_sell",
    13: "No negative ATS (no oversell)",
    14: "Reserved qty = sum of ACTIVE reservations per product/store",
    15: "Scenario: some product/store has On Hand > 0, Reserved > 0, ATS = 0",
    16: "Scenario: FACT_RESERVATION holds an ACTIVE reservation on that stock",
    17: "Scenario: FACT_POS_ACTIVITY records a BLOCKED / RESERVED_STOCK attempt on that stock",
    18: "Every BLOCKED attempt has a reason, and every OUT_OF_STOCK one is on stock with On Hand = 0",
    19: "Reservation cancellation works: cancelled reservations no longer hold stock",
    20: "Normal POS sale: COMPLETED sales are recorded with revenue",
    21: "Cleaning: no duplicate natural keys in any dimension",
    22: "Cleaning: statuses standardised (no lower-case / padded values)",
}


def _measure(df: DataFrame, prefix: str, **measures: Column) -> DataFrame:
    """Aggregates of one table as (metric, value) rows, computed in one pass."""
    columns = {f"{prefix}_{name}": m.cast("decimal(38,2)") for name, m in measures.items()}
    return df.agg(*[m.alias(n) for n, m in columns.items()]).unpivot([], list(columns), "metric", "value")


def _any_null(*columns: str) -> Column:
    missing = F.lit(False)
    for column in columns:
        missing = missing | F.col(column).isNull()
    return F.count_if(missing)


def stock_against_activity(dw: Tables) -> DataFrame:
    """Latest stock of each pair with the reservations and refused sales booked on it; NULL where there are none.

    Rows that count nowhere stay out of the shuffle.
    """
    active, cancelled = F.col("reservation_status") == "ACTIVE", F.col("reservation_status") == "CANCELLED"
    reserved_stock = (F.col("transaction_status") == "BLOCKED") & (F.col("rejection_reason") == "RESERVED_STOCK")
    out_of_stock = F.col("rejection_reason") == "OUT_OF_STOCK"
    holds = (
        dw["fact_reservation"]
        .where(active | cancelled)
        .groupBy(*PAIR)
        .agg(
            F.sum(F.when(active, F.col("quantity"))).alias("active_quantity"),
            F.count_if(active).alias("active_holds"),
            F.count_if(cancelled).alias("cancelled_holds"),
        )
    )
    refused = (
        dw["fact_pos_activity"]
        .where(reserved_stock | out_of_stock)
        .groupBy(*PAIR)
        .agg(
            F.count_if(reserved_stock).alias("blocked_reserved"),
            F.count_if(out_of_stock).alias("out_of_stock"),
        )
    )
    return latest_snapshot(dw).join(holds, PAIR, "left").join(refused, PAIR, "left")


def measures(dw: Tables, linked: Tables) -> DataFrame:
    parts = []
    for name, source in DIMENSION_SOURCE.items():
        natural = dw[name].columns[1]
        parts.append(_measure(dw[name], name, rows=_rows(), repeats=_rows() - F.countDistinct(natural)))
        parts.append(_measure(dw[source], source, rows=_rows()))
    for source in ("stg_pos_items", "stg_order_items", "stg_reservations", "stg_inventory"):
        parts.append(_measure(dw[source], source, rows=_rows()))

    completed = F.col("transaction_status") == "COMPLETED"
    blocked = F.col("transaction_status") == "BLOCKED"
    parts.append(
        _measure(
            dw["fact_pos_activity"],
            "pos",
            rows=_rows(),
            revenue=F.coalesce(F.sum(F.when(completed, F.col("line_amount"))), F.lit(0)),
            null_keys=_any_null("product_key", "store_key", "date_key"),
            no_reason=F.count_if(blocked & F.col("rejection_reason").isNull()),
            paid=F.count_if(completed & (F.col("line_amount") > 0)),
        )
    )
    parts.append(
        _measure(
            dw["fact_online_order"],
            "order",
            rows=_rows(),
            null_keys=_any_null("product_key", "store_key", "customer_key", "date_key"),
            unclean=F.count_if(F.col("order_status") != standard_word("order_status")),
        )
    )
    parts.append(
        _measure(
            dw["fact_reservation"],
            "hold",
            rows=_rows(),
            null_keys=_any_null("product_key", "store_key", "customer_key", "date_key"),
            cancelled=F.count_if(F.col("reservation_status") == "CANCELLED"),
        )
    )

    mismatch = F.col("reserved_quantity") != F.coalesce("active_quantity", F.lit(0))
    held = is_last_unit_conflict()
    parts.append(
        _measure(
            stock_against_activity(dw),
            "stock",
            rows=_rows(),
            on_hand=F.sum("on_hand_quantity"),
            wrong_ats=F.count_if(F.col("available_to_sell") != F.col("on_hand_quantity") - F.col("reserved_quantity")),
            negative=F.count_if(F.col("available_to_sell") < 0),
            mismatch=F.count_if(mismatch),
            mismatch_cancelled=F.count_if(mismatch & (F.col("cancelled_holds") > 0)),
            held=F.count_if(held),
            held_active=F.count_if(held & (F.col("active_holds") > 0)),
            held_blocked=F.count_if(held & (F.col("blocked_reserved") > 0)),
            stocked_refusals=F.count_if((F.col("out_of_stock") > 0) & (F.col("on_hand_quantity") > 0)),
        )
    )

    sold = standard_word("transaction_status").isin("COMPLETED", "APPROVED")
    sales = linked["pos.pos_transaction"].where(sold).select("transaction_id")
    paid = linked["pos.pos_transaction_item"].select("transaction_id", "quantity", "unit_price")
    amount = F.sum(F.col("quantity") * F.col("unit_price"))
    parts.append(_measure(paid.join(sales, "transaction_id"), "source", revenue=F.coalesce(amount, F.lit(0))))

    source = linked["inventory.inventory"].select(
        "product_id", "store_id", "on_hand_quantity", F.col("available_to_sell").alias("source_ats")
    )
    # two measures need it, and a source may be a view that is dear to compute
    source = store(source, fresh_folder(source.sparkSession, "qa-inventory"), compression="zstd")
    loaded = (
        latest_snapshot(dw)
        .join(dw["dim_product"].select("product_key", "product_id"), "product_key")
        .join(dw["dim_store"].select("store_key", "store_id"), "store_key")
        .select("product_id", "store_id", "available_to_sell")
    )
    differs = F.count_if(F.col("available_to_sell") != F.col("source_ats"))
    # summed before the join, so no repeated row can count twice
    parts.append(_measure(source, "source", on_hand=F.sum("on_hand_quantity")))
    parts.append(_measure(source.join(loaded, ["product_id", "store_id"]), "source", other_ats=differs))
    return union_all(parts)


def qa_checks(dw: Tables, linked: Tables) -> DataFrame:
    """The 22 tests as (n, check_name, ok). ``ok`` is NULL where a total does not exist."""
    rows = measures(dw, linked)
    m = lambda metric: F.max(F.when(F.col("metric") == metric, F.col("value")))
    none, some = (lambda metric: m(metric) == 0), (lambda metric: m(metric) > 0)
    same = lambda a, b: m(a) == m(b)
    tests = {
        1: same("dim_product_rows", "stg_products_rows"),
        2: same("dim_store_rows", "stg_stores_rows"),
        3: same("dim_customer_rows", "stg_customers_rows"),
        4: same("pos_rows", "stg_pos_items_rows"),
        5: same("order_rows", "stg_order_items_rows"),
        6: same("hold_rows", "stg_reservations_rows"),
        7: same("stock_rows", "stg_inventory_rows"),
        8: same("pos_revenue", "source_revenue"),
        9: same("stock_on_hand", "source_on_hand"),
        10: none("pos_null_keys") & none("order_null_keys") & none("hold_null_keys"),
        11: none("stock_wrong_ats"),
        12: none("source_other_ats"),
        13: none("stock_negative"),
        14: none("stock_mismatch"),
        15: some("stock_held"),
        16: some("stock_held_active"),
        17: some("stock_held_blocked"),
        18: none("pos_no_reason") & none("stock_stocked_refusals"),
        19: some("hold_cancelled") & none("stock_mismatch_cancelled"),
        20: some("pos_paid"),
        21: none("dim_product_repeats") & none("dim_store_repeats") & none("dim_customer_repeats"),
        22: none("order_unclean"),
    }
    wide = rows.agg(*[ok.alias(f"t{n}") for n, ok in tests.items()])
    entries = [
        F.struct(F.lit(n).alias("n"), F.lit(TEST_NAMES[n]).alias("check_name"), F.col(f"t{n}").alias("ok")) for n in tests
    ]
    return wide.select(F.explode(F.array(*entries)).alias("t")).select("t.*")


def qa_scoreboard(checks: DataFrame) -> DataFrame:
    """PASS or FAIL per checklist item; a test without a result counts as failed."""
    spark = checks.sparkSession
    items = spark.createDataFrame(list(CHECKLIST), "item int, qa_checklist_item string, tests array<int>")
    members = items.select("item", "qa_checklist_item", F.explode("tests").alias("n"))
    passed = F.coalesce("ok", F.lit(False))
    failed = F.array_sort(F.collect_list(F.when(~passed, F.struct("n", "check_name"))))
    return (
        members.join(checks, "n")
        .groupBy("item", "qa_checklist_item")
        .agg(
            F.when(F.bool_and(passed), "PASS").otherwise("FAIL").alias("result"),
            F.concat(F.count_if(passed).cast("string"), F.lit(" of "), _rows().cast("string")).alias("tests_passed"),
            F.array_join(F.transform(failed, lambda t: t["check_name"]), "; ").alias("failed_tests"),
        )
        .orderBy("item")
    )


def revenue_reconcile(dw: Tables, linked: Tables) -> DataFrame:
    """Loaded against source revenue of completed sales."""
    value = lambda metric: F.max(F.when(F.col("metric") == metric, F.col("value")))
    completed = F.col("transaction_status") == "COMPLETED"
    loaded = _measure(
        dw["fact_pos_activity"], "pos", revenue=F.coalesce(F.sum(F.when(completed, F.col("line_amount"))), F.lit(0))
    )
    sales = linked["pos.pos_transaction"].where(standard_word("transaction_status").isin("COMPLETED", "APPROVED"))
    lines = linked["pos.pos_transaction_item"].join(sales.select("transaction_id"), "transaction_id")
    amount = F.sum(F.col("quantity") * F.col("unit_price"))
    both = loaded.unionByName(_measure(lines, "source", revenue=F.coalesce(amount, F.lit(0))))
    return both.agg(value("pos_revenue").alias("warehouse_revenue"), value("source_revenue").alias("source_revenue")).withColumn(
        "ok", F.col("warehouse_revenue") == F.col("source_revenue")
    )


def duplicate_natural_keys(tables: Tables) -> DataFrame:
    """Ids that more than one row of a cleaned master table carries, with the number of rows."""
    return union_all(
        tables[source]
        .groupBy(F.col(column).alias("natural_key"))
        .agg(_rows().alias("row_count"))
        .where(F.col("row_count") > 1)
        .select(F.lit(source).alias("table_name"), "natural_key", "row_count")
        for source, column in (("stg_products", "product_id"), ("stg_stores", "store_id"), ("stg_customers", "customer_id"))
    )


# ---- declared constraints ----

# Keys, references, empty columns, value rules and text lengths as declared.
UNIQUE = (
    ("dim_date", ("date_key",)),
    ("dim_date", ("full_date",)),
    ("dim_product", ("product_key",)),
    ("dim_product", ("product_id",)),
    ("dim_store", ("store_key",)),
    ("dim_store", ("store_id",)),
    ("dim_customer", ("customer_key",)),
    ("dim_customer", ("customer_id",)),
    ("inventory.product", ("product_id",)),
    ("inventory.product", ("sku",)),
    ("inventory.store", ("store_id",)),
    ("inventory.inventory", ("inventory_id",)),
    ("inventory.inventory", ("product_id", "store_id")),
    ("inventory.inventory_movement", ("movement_id",)),
    ("ecommerce.customer", ("customer_id",)),
    ("ecommerce.customer", ("email",)),
    ("ecommerce.online_order", ("order_id",)),
    ("ecommerce.order_item", ("order_item_id",)),
    ("ecommerce.reservation", ("reservation_id",)),
    ("pos.pos_transaction", ("transaction_id",)),
    ("pos.pos_transaction_item", ("transaction_item_id",)),
    ("fact_pos_activity", ("transaction_item_id",)),
    ("fact_online_order", ("order_item_id",)),
    ("fact_reservation", ("reservation_id",)),
    ("fact_inventory_snapshot", ("product_key", "store_key", "date_key")),
)

REFERENCES = (
    ("inventory.inventory", ("product_id",), "inventory.product", ("product_id",)),
    ("inventory.inventory", ("store_id",), "inventory.store", ("store_id",)),
    ("inventory.inventory_movement", ("product_id", "store_id"), "inventory.inventory", ("product_id", "store_id")),
    ("ecommerce.online_order", ("customer_id",), "ecommerce.customer", ("customer_id",)),
    ("ecommerce.order_item", ("order_id",), "ecommerce.online_order", ("order_id",)),
    ("ecommerce.reservation", ("order_id",), "ecommerce.online_order", ("order_id",)),
    ("pos.pos_transaction_item", ("transaction_id",), "pos.pos_transaction", ("transaction_id",)),
    *(
        (fact, (key,), dimension, (key,))
        for fact in ("fact_pos_activity", "fact_online_order", "fact_reservation", "fact_inventory_snapshot")
        for dimension, key in (
            ("dim_product", "product_key"),
            ("dim_store", "store_key"),
            ("dim_customer", "customer_key"),
            ("dim_date", "date_key"),
        )
        if key != "customer_key" or fact in ("fact_online_order", "fact_reservation")
    ),
)

# Columns that may stay empty; every other column must have a value.
NULLABLE = {
    "dim_product": {"category"},
    "dim_store": {"location"},
    "inventory.inventory_movement": {"source_reference_id"},
    "ecommerce.reservation": {"expires_at", "released_at"},
    "pos.pos_transaction": {"rejection_reason"},
    "fact_pos_activity": {"rejection_reason"},
}

_ats = "available_to_sell = on_hand_quantity - reserved_quantity"
_words = lambda column, words: f"{column} IN ({', '.join(repr(w) for w in words)})"
# Row rules as SQL conditions that a valid row meets; an unknown result passes.
ROW_RULES = {
    "inventory.product": ("unit_price >= 0",),
    "inventory.inventory": ("on_hand_quantity >= 0", "reserved_quantity >= 0", "reserved_quantity <= on_hand_quantity", _ats),
    "ecommerce.online_order": (_words("order_status", ORDER_STATUSES), "order_total >= 0", "updated_at >= created_at"),
    "ecommerce.order_item": ("quantity > 0", "unit_price >= 0", "line_amount >= 0", "line_amount = quantity * unit_price"),
    "ecommerce.reservation": (
        "quantity > 0",
        _words("reservation_status", RESERVATION_STATUSES),
        "expires_at >= created_at",
        "released_at >= created_at",
    ),
    "pos.pos_transaction": (
        _words("transaction_status", POS_STATUSES),
        _words("rejection_reason", POS_REASONS),
        "total_amount >= 0",
        "transaction_status <> 'BLOCKED' OR rejection_reason IS NOT NULL",
    ),
    "pos.pos_transaction_item": ("quantity > 0", "unit_price >= 0", "line_amount >= 0"),
    "fact_inventory_snapshot": (_ats,),
}

# Longest text each column may hold.
MAX_LENGTH = {
    "dim_date": {"month": 10, "quarter": 2, "day_of_week": 10},
    "dim_product": {"product_id": 20, "sku": 50, "product_name": 150, "category": 50},
    "dim_store": {"store_id": 20, "store_name": 100, "location": 150},
    "dim_customer": {"customer_id": 20, "customer_name": 100},
    "fact_pos_activity": {
        "transaction_id": 20, "transaction_item_id": 20, "transaction_status": 20, "rejection_reason": 255,
    },
    "fact_online_order": {"order_id": 20, "order_item_id": 20, "order_status": 30},
    "fact_reservation": {"reservation_id": 20, "order_id": 20, "reservation_status": 30},
    "inventory.product": {"product_id": 20, "sku": 50, "product_name": 150, "category": 50},
    "inventory.store": {"store_id": 20, "store_name": 100, "location": 150},
    "inventory.inventory": {"inventory_id": 20, "product_id": 20, "store_id": 20},
    "inventory.inventory_movement": {
        "movement_id": 50, "product_id": 20, "store_id": 20, "movement_type": 30, "source_system": 30,
        "source_reference_id": 100,
    },
    "ecommerce.customer": {"customer_id": 20, "customer_name": 100, "email": 150},
    "ecommerce.online_order": {"order_id": 20, "customer_id": 20, "fulfilment_store_id": 20, "order_status": 30},
    "ecommerce.order_item": {"order_item_id": 20, "order_id": 20, "product_id": 20},
    "ecommerce.reservation": {
        "reservation_id": 20, "order_id": 20, "product_id": 20, "store_id": 20, "reservation_status": 30,
    },
    "pos.pos_transaction": {"transaction_id": 20, "store_id": 20, "transaction_status": 20, "rejection_reason": 255},
    "pos.pos_transaction_item": {"transaction_item_id": 20, "transaction_id": 20, "product_id": 20},
}

# What names a row of a loaded table; a source row is named by its first column.
RECORD_ID = {
    "dim_date": ("date_key",),
    "dim_product": ("product_key",),
    "dim_store": ("store_key",),
    "dim_customer": ("customer_key",),
    "fact_pos_activity": ("transaction_item_id",),
    "fact_online_order": ("order_item_id",),
    "fact_reservation": ("reservation_id",),
    "fact_inventory_snapshot": ("product_key", "store_key", "date_key"),
}


VIOLATIONS = "table_name string, rule string, record_id string"
# Whole numbers of the longest key, that of the snapshot.
KEY_NUMBERS = 3


def _record(columns: tuple[str, ...]) -> Column:
    return F.concat_ws("/", *[F.col(c).cast("string") for c in columns])


def _required(name: str, df: DataFrame) -> list[str]:
    return [c for c in df.columns if c not in NULLABLE.get(name, ()) and not c.endswith("_fact_key")]


def value_rules(name: str) -> list[str]:
    lengths = [f"length({column}) <= {most}" for column, most in MAX_LENGTH.get(name, {}).items()]
    return [*ROW_RULES.get(name, ()), *lengths]


def row_violations(name: str, df: DataFrame) -> DataFrame:
    """Rows that break a value rule of their table, one output row per broken rule, in one scan."""
    record = RECORD_ID.get(name) or (SOURCES[name].fieldNames()[0],)
    rules = {f"{c} IS NOT NULL": F.col(c).isNull() for c in _required(name, df)}
    # an unknown result passes
    rules |= {rule: F.coalesce(~F.expr(rule), F.lit(False)) for rule in value_rules(name)}
    broken = F.array(*[F.when(fails, F.lit(rule)) for rule, fails in rules.items()])
    # only bad rows are looked at rule by rule
    return (
        df.where(reduce(lambda a, b: a | b, rules.values()))
        .select(F.lit(name).alias("table_name"), F.explode(broken).alias("rule"), _record(record).alias("record_id"))
        .where("rule IS NOT NULL")
    )


def _present(columns: tuple[str, ...]) -> Column:
    return reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in columns])


def _texts(df: DataFrame, columns: tuple[str, ...]) -> list[str]:
    return [c for c in columns if df.schema[c].dataType.typeName() not in ("integer", "long")]


def _value(df: DataFrame, columns: tuple[str, ...]) -> Column:
    """A key value: whole numbers as they are, texts as one text, the rest empty."""
    texts = _texts(df, columns)
    numbers = [c for c in columns if c not in texts]
    joined = F.concat_ws("/", *texts) if texts else F.lit(None).cast("string")
    if len(texts) > 1:
        # the lengths tell ("a", "b/c") from ("a/b", "c")
        joined = F.concat(F.concat_ws(",", *[F.length(c).cast("string") for c in texts]), F.lit(":"), joined)
    parts = [joined]
    parts += [F.col(numbers[i]).cast("long") if i < len(numbers) else F.lit(None).cast("long") for i in range(KEY_NUMBERS)]
    return F.struct(*[part.alias(f"v{i}") for i, part in enumerate(parts)])


def key_values(df: DataFrame, roles: Iterable[tuple[int, int, tuple[str, ...]]]) -> DataFrame:
    """Values of a table's keys in one scan: the key they belong to, the role of the table, the value; NULL is none.

    Role 0 owns the key; the others refer to it.
    """
    found = [
        F.when(_present(columns), F.struct(F.lit(key).alias("key"), F.lit(role).alias("role"), _value(df, columns).alias("value")))
        for key, role, columns in roles
    ]
    return df.select(F.explode(F.array(*found)).alias("k")).where("k IS NOT NULL").select("k.key", "k.role", "k.value.*")


def key_violations(tables: Tables) -> DataFrame:
    """Repeated keys and text references without an owner, from one shuffle of all key values.

    The rows that own a key and those that refer to it meet in one group per value. Tasks sum before they send, so a
    value that very many rows refer to is one row per task.
    """
    spark = next(iter(tables.values())).sparkSession
    unique = [(n, c) for n, c in UNIQUE if n in tables]
    references = [r for r in REFERENCES if r[0] in tables and r[2] in tables and not _is_surrogate(r)]
    keys = {key: i for i, key in enumerate(dict.fromkeys([*unique, *((r[2], r[3]) for r in references)]))}
    label = lambda columns: ", ".join(columns)
    roles: dict[str, list[tuple[int, int, tuple[str, ...]]]] = {}
    for (name, columns), key in keys.items():
        roles.setdefault(name, []).append((key, 0, columns))
    several = {key: len(_texts(tables[n], c)) > 1 for (n, c), key in keys.items()}
    rules = [(keys[n, c], 0, n, f"UNIQUE ({label(c)})", several[keys[n, c]]) for n, c in unique]
    for role, (child, columns, parent, owned) in enumerate(references, 1):
        key = keys[parent, owned]
        roles.setdefault(child, []).append((key, role, columns))
        rules.append((key, role, child, f"({label(columns)}) REFERENCES {parent}", several[key]))
    if not roles:
        return spark.createDataFrame([], VIOLATIONS)
    values = union_all(key_values(tables[name], wanted) for name, wanted in roles.items())
    value = ["v0", *[f"v{i + 1}" for i in range(KEY_NUMBERS)]]
    met = values.groupBy("key", *value).agg(
        F.count_if(F.col("role") == 0).alias("owners"),
        F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), F.col("role"))).alias("roles"),
    )
    broken = met.where("owners <> 1")
    known = spark.createDataFrame(rules, "key int, role int, table_name string, rule string, several boolean")
    repeated = (F.col("role") == 0) & (F.col("owners") > 1)
    orphan = (F.col("role") > 0) & (F.col("owners") == 0) & (F.call_function("shiftright", "roles", F.col("role")) % 2 == 1)
    text = F.when(F.col("several"), F.regexp_replace("v0", "^[0-9,]*:", "")).otherwise(F.col("v0"))
    record = F.concat_ws("/", text, *[F.col(c).cast("string") for c in value[1:]]).alias("record_id")
    # the rules are constants of this module
    return broken.join(F.broadcast(known), "key").where(repeated | orphan).select("table_name", "rule", record)


def _is_surrogate(reference: tuple) -> bool:
    child, _, parent, columns = reference
    return parent in RECORD_ID and len(columns) == 1 and columns[0].endswith("_key")


def key_bitmaps(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """column, bucket, keys: which whole numbers occur in each column, a bit per number."""
    entries = [
        F.when(F.col(c).isNotNull(), F.struct(F.lit(c).alias("column"), F.col(c).cast("long").alias("key"))) for c in columns
    ]
    found = df.select(F.explode(F.array(*entries)).alias("e")).where("e IS NOT NULL")
    bucket, position = F.bitmap_bucket_number("e.key"), F.bitmap_bit_position("e.key")
    return found.groupBy(F.col("e.column").alias("column"), bucket.alias("bucket")).agg(
        F.bitmap_construct_agg(position).alias("keys")
    )


def surrogate_violations(tables: Tables) -> DataFrame:
    """References to dimensions by surrogate key that lead nowhere.

    Surrogate keys are dense, so the keys that occur in a fact fit a bitmap no larger than the dimension's: each task
    sends bits instead of keys. Where a fact has bits that the dimension has not, and only there, the keys are looked at.
    """
    spark = next(iter(tables.values())).sparkSession
    references = [r for r in REFERENCES if r[0] in tables and r[2] in tables and _is_surrogate(r)]
    child_columns: dict[str, dict[str, str]] = {}
    for child, (column,), parent, _ in references:
        child_columns.setdefault(child, {})[column] = parent
    owners = {parent: key[0] for _, _, parent, key in references}
    used = union_all(
        key_bitmaps(tables[child], columns).select(F.lit(child).alias("child"), "column", "bucket", "keys")
        for child, columns in child_columns.items()
    )
    owned = union_all(key_bitmaps(tables[p], [c]).select("column", "bucket", F.col("keys").alias("known")) for p, c in owners.items())
    # a bitmap is 4 KB for 32,768 keys: written, since both sides are asked again below
    used = store(used, fresh_folder(spark, "used-keys"))
    owned = store(owned, fresh_folder(spark, "owned-keys"))
    either = (
        used.join(owned, ["column", "bucket"], "left")
        .select("child", "column", "bucket", F.explode(F.array_compact(F.array("keys", "known"))).alias("keys"), "known")
        .groupBy("child", "column", "bucket")
        .agg(F.bitmap_count(F.bitmap_or_agg("keys")).alias("n_either"), F.coalesce(F.bitmap_count(F.first("known")), F.lit(0)).alias("n_known"))
        .where("n_either > n_known")
    )
    found = store(either.select("child", "column", "bucket"), fresh_folder(spark, "unknown-keys"))
    wrong = found.select("child", "column").distinct().collect()  # one row per reference at most
    parts = []
    for child, column in sorted((r["child"], r["column"]) for r in wrong):
        parent = child_columns[child][column]
        key = F.col(column).cast("long")
        here = found.where((F.col("child") == child) & (F.col("column") == column)).select("bucket")
        keys = tables[child].where(F.col(column).isNotNull()).select(key.alias("key")).distinct()
        keys = keys.join(here, F.bitmap_bucket_number("key") == F.col("bucket"), "left_semi")
        unknown = keys.join(tables[parent].select(F.col(column).cast("long").alias("key")), "key", "left_anti")
        parts.append(
            unknown.select(F.lit(child).alias("table_name"), F.lit(f"({column}) REFERENCES {parent}").alias("rule"), F.col("key").cast("string").alias("record_id"))
        )
    return union_all(parts) if parts else spark.createDataFrame([], VIOLATIONS)


def violations(tables: Tables) -> DataFrame:
    """Every broken rule of the given tables: rules on rows, repeated keys, references that lead nowhere.

    A table is scanned once for its rows, once for its keys, and a fact once more for the bitmaps of its surrogate keys.
    """
    parts = [row_violations(n, df) for n, df in tables.items() if n in SOURCES or n in RECORD_ID]
    parts.append(key_violations(tables))
    if any(_is_surrogate(r) and r[0] in tables and r[2] in tables for r in REFERENCES):
        parts.append(surrogate_violations(tables))
    return union_all(parts)
