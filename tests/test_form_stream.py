"""Orders and till sales as a stream against a one-by-one shop, with crashes in between."""

import random
from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from shelfwise.operators import stock
from shelfwise.operators.shelf import Shelf
from shelfwise.streaming import form_stream
from test_stock import START, _shop

PAIRS = [(p, s) for p in ("P001", "P002", "P003") for s in ("S001", "S002")]


def shop(spark):
    tables = _shop(spark)
    money = F.col("unit_price").cast("decimal(10,2)")
    tables["inventory.product"] = spark.createDataFrame([("P001", 2.5), ("P002", 1.0), ("P003", 4.0)], "product_id string, unit_price double").withColumn("unit_price", money)
    tables["inventory.inventory"] = spark.createDataFrame(
        [(p, s, 20 + 7 * i, i, 20 + 6 * i) for i, (p, s) in enumerate(PAIRS[:5])],
        "product_id string, store_id string, on_hand_quantity int, reserved_quantity int, available_to_sell int",
    )
    return tables


def make_forms(seed, n):
    random_ = random.Random(seed)
    rows = []
    for i in range(n):
        p, s = random_.choice(PAIRS)
        form = random_.choice(["ORDER", "SALE", "SALE", "ORDER", "ORDER", "GIFT"] if i % 17 == 0 else ["ORDER", "SALE"])
        customer = random_.choice(["C001", "C001", "C404"]) if form == "ORDER" else None
        product = "P404" if i % 23 == 0 else p
        rows.append((f"q{i:04}", START + timedelta(seconds=random_.randint(0, n)), form, customer, s, product, random_.randint(0, 5)))
    return rows


def walk(batches):
    """(orders, tills, refused ids, stock) of a shop that takes forms one by one, batch by batch."""
    shelves = {pair: Shelf(20 + 7 * i, i) for i, pair in enumerate(PAIRS[:5])}
    orders, tills, refused = [], [], []
    for batch in batches:
        for i, at, form, customer, s, p, q in sorted(batch, key=lambda r: (r[1], r[0])):
            shelf = shelves.get((p, s))
            if form == "GIFT" or q <= 0 or p == "P404" or (form == "ORDER" and customer != "C001"):
                refused.append(i)
            elif form == "ORDER":
                if shelf and shelf.reserve(q, i).success:
                    orders.append((i, f"O{8 + len(orders):03}", p, s, q, at))
                else:
                    refused.append(i)
            else:
                done = shelf.sell(q, i) if shelf else None
                status = ("COMPLETED", "NONE") if done and done.success else ("BLOCKED", done.reason if done else "OUT_OF_STOCK")
                tills.append((i, f"T{1 + len(tills):03}", *status, q))
    return orders, tills, sorted(refused), {k: (v.on_hand, v.reserved) for k, v in shelves.items()}


def found(spark, out):
    table = lambda name: form_stream.stored(spark, out, name)
    orders = table("ecommerce.online_order").join(table("order_answers").drop("order_status", "version"), "order_id")
    orders = orders.join(table("ecommerce.order_item").drop("version"), "order_id").select(
        "request_id", "order_id", "product_id", "fulfilment_store_id", "quantity", "created_at"
    )
    tills = table("sale_answers").join(table("pos.pos_transaction_item").drop("version"), "transaction_id")
    tills = tills.select("request_id", "transaction_id", "transaction_status", "rejection_reason", "quantity")
    refused = sorted(r.request_id for r in table("refused").collect())
    now = {(r.product_id, r.store_id): (r.on_hand_quantity, r.reserved_quantity) for r in form_stream.stock_now(spark, out).collect()}
    return sorted(map(tuple, orders.collect()), key=lambda r: r[1]), sorted(map(tuple, tills.collect()), key=lambda r: r[1]), refused, now


def test_forms_are_stored_once_whatever_crashes(spark, tmp_path, monkeypatch):
    source, out, checkpoint = (f"{tmp_path}/{x}" for x in ("in", "out", "checkpoint"))
    rows = make_forms(5, 120)
    batches = [rows[:50], rows[50:90], rows[90:]]
    masters = shop(spark)
    form_stream.open_shop(masters, out)
    form_stream.open_shop(masters, out)  # changes nothing

    def drain():
        query = form_stream.serve(form_stream.form_stream(spark, source, 1), masters, out, checkpoint, fold_every=2)
        query.awaitTermination(240)
        assert query.exception() is None

    put = form_stream._put
    for n, batch in enumerate(batches):
        spark.createDataFrame(batch, form_stream.FORMS).coalesce(1).write.mode("append").parquet(source)

        def crashes(*arguments, late=n % 2 == 1):
            if late:
                put(*arguments)  # stored, but the stream does not get to know
            raise RuntimeError("lost")

        with monkeypatch.context() as patched:
            patched.setattr(form_stream, "_put", crashes)
            with pytest.raises(Exception, match="lost"):
                drain()
        drain()  # replays the batch
    expected = walk(batches)
    got = found(spark, out)
    assert got[0] == expected[0] and got[1] == expected[1] and got[2] == expected[2]
    assert got[3] == expected[3]

    # the ledger explains the stock, and refers to the new ids
    moves = form_stream.stored(spark, out, "inventory.inventory_movement")
    position = {(r.product_id, r.store_id): (r.on_hand, r.reserved) for r in stock.ledger_position(moves).collect()}
    opening = {pair: (20 + 7 * i, i) for i, pair in enumerate(PAIRS[:5])}
    assert {k: (opening[k][0] + a, opening[k][1] + b) for k, (a, b) in position.items()} == {k: v for k, v in expected[3].items() if k in position}
    held = form_stream.stored(spark, out, "ecommerce.reservation")
    assert held.where("expires_at <> created_at + INTERVAL 1 DAY").count() == 0 and held.count() == len(expected[0])

    # asked pairs are answered from the live stock, as the batch job answers from a whole table
    asked = spark.createDataFrame([*PAIRS, ("P404", "S001")], "product_id string, store_id string")
    answers = sorted(map(tuple, form_stream.availability(asked, out).collect()))
    assert answers == sorted((p, s, a, b, a - b) for (p, s), (a, b) in expected[3].items())
    assert answers == sorted(map(tuple, stock.availability(asked, form_stream.stock_now(spark, out)).collect()))

    # the newest ten, as of the newest batch
    top = [r.order_id for r in form_stream.newest(spark, out, "ecommerce.online_order", "created_at").collect()]
    assert top == [o[1] for o in sorted(expected[0], key=lambda o: (o[5], o[1]), reverse=True)[:10]]

    last = form_stream._commits(spark, out)[-1]
    assert last.version == 3 and len(last.changes) == 1  # two of three were folded
    assert last.highest["ecommerce.online_order"] == 7 + len(expected[0])


def test_an_id_in_two_forms_is_refused_in_both(spark):
    tables = shop(spark)
    columns = "request_id string, request_ts timestamp_ntz, customer_id string, store_id string, product_id string, quantity int"
    orders = spark.createDataFrame([("x", START, "C001", "S001", "P001", 1), ("y", START, "C001", "S001", "P001", 1)], columns)
    sales = spark.createDataFrame([("x", START, None, "S001", "P001", 1), ("z", START, None, "S001", "P001", 20)], columns).drop("customer_id")
    ordered, sold, _ = stock.serve_forms(orders, sales, tables)
    assert [r.request_id for r in ordered["answers"].collect()] == ["y"]
    assert [(r.request_id, r.rejection_reason) for r in sold["answers"].collect()] == [("z", "RESERVED_STOCK")]
    assert [r.request_id for r in ordered["refused"].collect()] == [r.request_id for r in sold["refused"].collect()] == ["x"]


def test_nothing_is_stored_yet(spark, tmp_path):
    form_stream.open_shop(shop(spark), str(tmp_path))
    assert form_stream.stock_now(spark, str(tmp_path)).count() == 5
    with pytest.raises(ValueError, match="no batch"):
        form_stream.stored(spark, str(tmp_path), "refused")
