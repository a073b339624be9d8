"""Stock requests: rules of one shelf, and bulk decisions against a one-by-one walk."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from shelfwise.operators import stock
from shelfwise.operators.shelf import RELEASE, RESERVE, SELL, Shelf

START = datetime(2025, 3, 1)
REQUEST = (
    "request_id string, request_ts timestamp_ntz, kind string, product_id string, store_id string, quantity int, reference string"
)
INVENTORY = "product_id string, store_id string, on_hand_quantity int, reserved_quantity int, available_to_sell int"
MOVEMENT = "product_id string, store_id string, movement_type string, quantity_change int, source_system string, source_reference_id string"


def outcome(decision):
    return decision.success, decision.reason, decision.error, decision.applied


def test_reservation_rules():
    shelf = Shelf(5, 0)
    assert outcome(shelf.reserve(9, "A")) == (False, None, None, False)
    assert outcome(shelf.reserve(5, "B")) == (True, None, None, True)
    assert outcome(shelf.reserve(5, "B")) == (True, None, None, False)
    assert shelf.reserve(4, "B").error.endswith("different quantity")
    assert outcome(shelf.release(2, "B")) == (True, None, None, True)
    assert outcome(shelf.release(2, "B")) == (True, None, None, True)
    assert outcome(shelf.release(2, "B")) == (False, None, None, False)
    assert outcome(shelf.reserve(5, "B")) == (False, None, None, False)
    assert outcome(shelf.reserve(3, "A")) == (True, None, None, True)
    assert (shelf.on_hand, shelf.reserved) == (5, 4)


def test_sale_rules():
    shelf = Shelf(3, 0)
    assert outcome(shelf.sell(4, "A")) == (False, "RESERVED_STOCK", None, False)
    assert outcome(shelf.sell(3, "A")) == (True, "NONE", None, True)
    assert outcome(shelf.sell(3, "A")) == (True, "NONE", None, False)
    assert shelf.sell(1, "A").error.endswith("different quantity")
    assert outcome(shelf.sell(1, "B")) == (False, "OUT_OF_STOCK", None, False)


def test_release_needs_a_balance():
    assert outcome(Shelf(5, 5).release(1, "unknown")) == (False, None, None, False)


def walk(requests, inventory, ledger=()):
    """Decide requests one by one, in order, as the source system does."""
    shelves = {(p, s): Shelf(on_hand, reserved) for p, s, on_hand, reserved, _ in inventory}
    for product, store, kind, change, _, reference in ledger:
        shelf = shelves[product, store]
        if kind == "POS_SALE":
            shelf.sales[reference] = -change
        elif kind == "ONLINE_RESERVATION":
            shelf.learn(reference, -change, -change, False, None)
        elif kind == "RESERVATION_RELEASE":
            shelf.holds[reference].balance -= change
            shelf.holds[reference].closed = True
    answers = {}
    for request_id, ts, kind, product, store, quantity, reference in sorted(requests, key=lambda r: (r[1], r[0])):
        if quantity is None or quantity <= 0:
            answers[request_id] = (None, None, f"{ {'RESERVE': 'Reservation', 'SELL': 'Sale', 'RELEASE': 'Release'}[kind] } quantity must be greater than zero", False)
        elif reference is None or not reference.strip(" "):
            answers[request_id] = (None, None, ("Transaction" if kind == SELL else "Reservation") + " reference is required", False)
        elif (product, store) not in shelves:
            answers[request_id] = (False, "OUT_OF_STOCK" if kind == SELL else None, None, False)
        else:
            answers[request_id] = outcome(shelves[product, store].decide(kind, quantity, reference))
    return answers, shelves


def make_requests(seed, rows, kinds, hot_share=0.5, sizes=(1, 6), references=None):
    rng = random.Random(seed)
    requests = []
    for i in range(rows):
        product = "P001" if rng.random() < hot_share else f"P{rng.randint(2, 9):03d}"
        requests.append(
            (
                f"Q{i:05d}",
                START + timedelta(minutes=rng.randint(0, rows)),
                rng.choice(kinds),
                product,
                "S001",
                rng.choice([None, 0, -1]) if rng.random() < 0.02 else rng.randint(*sizes),
                rng.choice([None, "", "  "]) if rng.random() < 0.02 else f"R{rng.randint(0, references or rows)}",
            )
        )
    return requests


def stock_rows(hot, reserved=0):
    return [("P001", "S001", hot, reserved, hot - reserved)] + [(f"P{i:03d}", "S001", 3 * i, 0, 3 * i) for i in range(2, 9)]


def decided(spark, requests, inventory, ledger=None, slice_rows=stock.SLICE_ROWS):
    frame = stock.adjudicate(
        spark.createDataFrame(requests, REQUEST),
        spark.createDataFrame(inventory, INVENTORY),
        None if ledger is None else spark.createDataFrame(ledger, MOVEMENT),
        slice_rows,
    )
    return frame


def as_answers(frame):
    return {r.request_id: (r.success, r.reason, r.error, r.applied) for r in frame.collect()}


@pytest.mark.parametrize("slice_rows", [40, 100_000])
@pytest.mark.parametrize(
    "name, hot, kinds, references",
    [
        ("scarce sales", 25, [SELL], None),
        ("plentiful sales", 100_000, [SELL], 60),
        ("sales and holds", 120, [SELL, RESERVE], 150),
        ("holds given back", 60, [RESERVE, RESERVE, RELEASE], 50),
        ("everything", 90, [SELL, RESERVE, RELEASE], 80),
    ],
)
def test_bulk_matches_one_by_one(spark, name, hot, kinds, references, slice_rows):
    requests = make_requests(len(name), 240, kinds, references=references)
    inventory = stock_rows(hot)
    expected, shelves = walk(requests, inventory)
    frame = decided(spark, requests, inventory, slice_rows=slice_rows)
    assert as_answers(frame) == expected

    after = stock.stock_after(spark.createDataFrame(inventory, INVENTORY), frame).collect()
    assert {(r.product_id, r.store_id): (r.on_hand_quantity, r.reserved_quantity) for r in after} == {
        k: (s.on_hand, s.reserved) for k, s in shelves.items()
    }
    assert all(r.available_to_sell >= 0 for r in after)


@pytest.mark.parametrize("slice_rows", [30, 100_000])
def test_earlier_ledger_counts(spark, slice_rows):
    requests = make_requests(7, 300, [SELL, RESERVE, RELEASE], references=40, sizes=(1, 3))
    inventory = stock_rows(80, reserved=9)
    ledger = [
        ("P001", "S001", "ONLINE_RESERVATION", -2, "ECOMMERCE", "R1"),
        ("P001", "S001", "ONLINE_RESERVATION", -3, "ECOMMERCE", "R2"),
        ("P001", "S001", "RESERVATION_RELEASE", 1, "ECOMMERCE", "R2"),
        ("P001", "S001", "ONLINE_RESERVATION", -5, "ECOMMERCE", "R900"),
        ("P001", "S001", "POS_SALE", -2, "POS", "R3"),
    ]
    expected, _ = walk(requests, inventory, ledger)
    assert as_answers(decided(spark, requests, inventory, ledger, slice_rows)) == expected


def test_repeating_a_run_over_its_own_ledger_changes_nothing(spark):
    requests = [r for r in make_requests(11, 200, [SELL]) if r[5] and r[5] > 0 and r[6] and r[6].strip()]
    inventory = stock_rows(50)
    first = decided(spark, requests, inventory)
    after = stock.stock_after(spark.createDataFrame(inventory, INVENTORY), first)
    again = stock.adjudicate(spark.createDataFrame(requests, REQUEST), after, stock.movements_of(first))
    accepted = {r.request_id for r in first.where("applied").collect()}
    repeated = {r.request_id: r for r in again.collect()}
    assert accepted and all(repeated[i].success and not repeated[i].applied for i in accepted)


def test_duplicate_inventory_is_refused(spark):
    with pytest.raises(ValueError, match="must be unique"):
        decided(spark, make_requests(1, 5, [SELL]), stock_rows(5) * 2)


def linked_sources(spark):
    return {
        "ecommerce.customer": spark.createDataFrame([("C001", "Ada Fern", "a@x.test")], "customer_id string, customer_name string, email string"),
        "inventory.product": spark.createDataFrame([("P001", "9.50"), ("P002", "20.00")], "product_id string, unit_price string").withColumn("unit_price", F.col("unit_price").cast("decimal(10,2)")),
        "inventory.inventory": spark.createDataFrame([("P001", "S001", 3, 0, 3), ("P002", "S001", 2, 2, 0)], INVENTORY),
        "ecommerce.online_order": spark.createDataFrame([("O041",), ("O007",)], "order_id string"),
        "ecommerce.order_item": spark.createDataFrame([("OI0999",)], "order_item_id string"),
        "ecommerce.reservation": spark.createDataFrame([], "reservation_id string"),
        "pos.pos_transaction": spark.createDataFrame([("T050",)], "transaction_id string"),
        "pos.pos_transaction_item": spark.createDataFrame([("TI050",)], "transaction_item_id string"),
    }


def test_orders_take_ids_in_request_order_and_leave_no_gap(spark):
    asks = [
        ("q1", START, "C001", "S001", "P001", 2),
        ("q2", START + timedelta(1), "C001", "S001", "P001", 2),
        ("q3", START + timedelta(2), "C001", "S001", "P001", 1),
        ("q4", START, "C999", "S001", "P001", 1),
        ("q5", START, "C001", "S001", "P404", 1),
        ("q6", START, "C001", "S001", "P001", 0),
        ("q7", START, "C001", "S404", "P001", 1),
        ("q8", START, None, "S001", "P001", 1),
    ]
    requests = spark.createDataFrame(asks, "request_id string, request_ts timestamp_ntz, customer_id string, store_id string, product_id string, quantity int")
    placed = stock.place_orders(requests, linked_sources(spark))
    assert [tuple(r) for r in placed["answers"].orderBy("order_id").collect()] == [
        ("q1", "O042", "R001", "CONFIRMED", "ACTIVE"),
        ("q3", "O043", "R002", "CONFIRMED", "ACTIVE"),
    ]
    assert {r.order_item_id: str(r.line_amount) for r in placed["ecommerce.order_item"].collect()} == {"OI1000": "19.00", "OI1001": "9.50"}
    moves = placed["inventory.inventory_movement"].select("source_reference_id", "movement_type", "quantity_change")
    assert sorted(tuple(r) for r in moves.collect()) == [("R001", "ONLINE_RESERVATION", -2), ("R002", "ONLINE_RESERVATION", -1)]
    assert {r.product_id: (r.reserved_quantity, r.available_to_sell) for r in placed["inventory.inventory"].collect()} == {"P001": (3, 0), "P002": (2, 0)}
    hold = placed["ecommerce.reservation"].orderBy("reservation_id").first()
    assert hold.expires_at == START + timedelta(1)
    assert {r.request_id: r.error for r in placed["refused"].collect()} == {
        "q2": "Not enough available stock to reserve 2 x P001 at S001",
        "q4": "Unknown customer C999",
        "q5": "Unknown product P404",
        "q6": "Quantity must be greater than zero",
        "q7": "Not enough available stock to reserve 1 x P001 at S404",
        "q8": "Unknown customer <NULL>",
    }


def test_every_valid_sale_attempt_is_stored(spark):
    asks = [
        ("q1", START, "S001", "P001", 3),
        ("q2", START + timedelta(1), "S001", "P001", 1),
        ("q3", START + timedelta(2), "S001", "P002", 1),
        ("q4", START, "S001", "P404", 1),
    ]
    requests = spark.createDataFrame(asks, "request_id string, request_ts timestamp_ntz, store_id string, product_id string, quantity int")
    sold = stock.attempt_sales(requests, linked_sources(spark))
    tills = sold["pos.pos_transaction"].orderBy("transaction_id").collect()
    assert [(r.transaction_id, r.transaction_status, r.rejection_reason, str(r.total_amount)) for r in tills] == [
        ("T051", "COMPLETED", "NONE", "28.50"),
        ("T052", "BLOCKED", "OUT_OF_STOCK", "0.00"),
        ("T053", "BLOCKED", "RESERVED_STOCK", "0.00"),
    ]
    moves = sold["inventory.inventory_movement"].select("source_reference_id", "movement_type", "quantity_change")
    assert [tuple(r) for r in moves.collect()] == [("T051", "POS_SALE", -3)]
    items = sold["pos.pos_transaction_item"].orderBy("transaction_item_id").collect()
    assert [str(r.line_amount) for r in items] == ["28.50", "9.50", "20.00"]
    assert [tuple(r) for r in sold["refused"].collect()] == [("q4", "Unknown product P404")]


def test_ledger_views(spark):
    rows = [
        ("P1", "S1", "STOCK_RECEIVED", 10, "WAREHOUSE", "G1"),
        ("P1", "S1", "ONLINE_RESERVATION", -4, "ECOMMERCE", "R1"),
        ("P1", "S1", "RESERVATION_RELEASE", 1, "ECOMMERCE", "R1"),
        ("P1", "S1", "RESERVATION_COLLECTION", -2, "ECOMMERCE", "R1"),
        ("P1", "S1", "POS_SALE", -3, "POS", "T1"),
        ("P1", "S1", "STOCK_ADJUSTMENT", -1, "INVENTORY", None),
    ]
    movements = spark.createDataFrame(rows, MOVEMENT)
    assert [tuple(r) for r in stock.ledger_position(movements).collect()] == [("P1", "S1", 4, 1, 3)]
    assert [tuple(r) for r in stock.reservation_balance(movements).collect()] == [("P1", "S1", "R1", 1)]


# ---- every request comes back once ----

ODD_REQUESTS = (("q1", 1), ("q1", 2), (" ", 1), (None, 1), ("q4", 1), ("q5", 0), ("q6", 9))


def _odd_requests(spark, columns):
    rows = [(i, START, "C001", "S001", "P001", q) for i, q in ODD_REQUESTS]
    schema = "request_id string, request_ts timestamp_ntz, customer_id string, store_id string, product_id string, quantity int"
    return spark.createDataFrame(rows, schema).select(*columns)


def _shop(spark):
    return {
        "inventory.product": spark.createDataFrame([("P001", 2.5), (None, 1.0), (None, 2.0)], "product_id string, unit_price double")
        .withColumn("unit_price", F.col("unit_price").cast("decimal(10,2)")),
        "inventory.inventory": spark.createDataFrame(
            [("I1", "P001", "S001", 5, 0, 5)],
            "inventory_id string, product_id string, store_id string, on_hand_quantity int, reserved_quantity int, available_to_sell int",
        ),
        "ecommerce.customer": spark.createDataFrame([("C001",)], "customer_id string"),
        "ecommerce.online_order": spark.createDataFrame([("O007",)], "order_id string"),
        "ecommerce.order_item": spark.createDataFrame([], "order_item_id string"),
        "ecommerce.reservation": spark.createDataFrame([], "reservation_id string"),
        "pos.pos_transaction": spark.createDataFrame([], "transaction_id string"),
        "pos.pos_transaction_item": spark.createDataFrame([], "transaction_item_id string"),
    }


def test_orders_lose_and_double_nothing(spark):
    columns = ["request_id", "request_ts", "customer_id", "store_id", "product_id", "quantity"]
    placed = stock.place_orders(_odd_requests(spark, columns), _shop(spark))
    answers, refused = placed["answers"].collect(), placed["refused"].collect()
    ids = [r.request_id for r in answers] + [r.request_id for r in refused]
    assert sorted(ids, key=str) == sorted((i for i, _ in ODD_REQUESTS), key=str)
    assert [(r.request_id, r.order_id) for r in answers] == [("q4", "O008")]
    why = {(r.request_id, r.error) for r in refused}
    assert why == {
        ("q1", "Request id is used more than once"), (" ", "Request id is required"), (None, "Request id is required"),
        ("q5", "Quantity must be greater than zero"), ("q6", "Not enough available stock to reserve 9 x P001 at S001"),
    }
    reserved = placed["inventory.inventory"].first().reserved_quantity
    assert reserved == placed["ecommerce.order_item"].agg(F.sum("quantity")).first()[0] == 1
    held = placed["ecommerce.reservation"].select("created_at", "expires_at").first()
    assert (held.expires_at - held.created_at).days == 1


def test_sales_lose_and_double_nothing(spark):
    columns = ["request_id", "request_ts", "store_id", "product_id", "quantity"]
    sold = stock.attempt_sales(_odd_requests(spark, columns), _shop(spark))
    answers, refused = sold["answers"].collect(), sold["refused"].collect()
    ids = [r.request_id for r in answers] + [r.request_id for r in refused]
    assert sorted(ids, key=str) == sorted((i for i, _ in ODD_REQUESTS), key=str)
    assert {(r.request_id, r.transaction_status, r.rejection_reason) for r in answers} == {
        ("q4", "COMPLETED", "NONE"), ("q6", "BLOCKED", "RESERVED_STOCK"),
    }


def test_repeated_products_stop_the_requests(spark):
    shop = _shop(spark)
    shop["inventory.product"] = shop["inventory.product"].union(shop["inventory.product"])
    columns = ["request_id", "request_ts", "store_id", "product_id", "quantity"]
    with pytest.raises(ValueError, match="must be unique"):
        stock.attempt_sales(_odd_requests(spark, columns), shop)


def test_without_a_ledger_no_prior_columns_travel(spark):
    requests = spark.createDataFrame([(f"q{i}", START + timedelta(hours=i), SELL, "P001", "S001", 2, f"T{i}") for i in range(4)], REQUEST)
    inventory = spark.createDataFrame([("P001", "S001", 5, 0, 5)], INVENTORY)
    decided = stock.adjudicate(requests, inventory)
    plan = decided._jdf.queryExecution().executedPlan().toString()
    assert not any(f" AS {name}#" in plan for name in stock.PRIOR)
    assert [r.success for r in decided.orderBy("request_id").collect()] == [True, True, False, False]
    import pyarrow as pa

    for column in (pa.array([1, None, 3], pa.int32()), pa.array([1, 2], pa.int64()), pa.array(["a", None]), pa.array([], pa.int32())):
        assert stock._values(column) == column.to_pylist()
    assert all(type(v) is int for v in stock._values(pa.array([1, 2], pa.int32())))
