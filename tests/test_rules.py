"""Column rules, and what must hold for a shelf whatever is asked of it."""

from datetime import date
from decimal import Decimal

from hypothesis import given, strategies as st
from pyspark.sql import functions as F

from shelfwise.functions import retail
from shelfwise.operators.shelf import RELEASE, RESERVE, SELL, Shelf

ASK = st.tuples(st.sampled_from([RESERVE, SELL, RELEASE]), st.integers(1, 9), st.sampled_from("ABCDE"))


@given(st.integers(0, 30), st.lists(ASK, max_size=60))
def test_a_shelf_is_never_oversold(on_hand, asks):
    shelf = Shelf(on_hand, 0)
    for kind, quantity, reference in asks:
        before = (shelf.on_hand, shelf.reserved)
        decision = shelf.decide(kind, quantity, reference)
        assert 0 <= shelf.reserved <= shelf.on_hand <= on_hand
        assert decision.applied == ((shelf.on_hand, shelf.reserved) != before)
        assert (decision.error is None) == (decision.success is not None)
    assert shelf.reserved == sum(hold.balance for hold in shelf.holds.values())


@given(st.integers(0, 30), st.lists(ASK, max_size=40))
def test_an_accepted_request_can_be_repeated(on_hand, asks):
    shelf = Shelf(on_hand, 0)
    for kind, quantity, reference in asks:
        if shelf.decide(kind, quantity, reference).applied and kind != RELEASE:
            state = (shelf.on_hand, shelf.reserved)
            again = shelf.decide(kind, quantity, reference)
            assert again.success and not again.applied and (shelf.on_hand, shelf.reserved) == state


def values(spark, *columns):
    return tuple(spark.range(1).select(*[c.alias(f"c{i}") for i, c in enumerate(columns)]).first())


def test_ids(spark):
    assert values(spark, *[retail.shared_id("O", F.lit(n)) for n in (7, 41, 999, 1000)]) == ("O007", "O041", "O999", "O1000")
    assert values(spark, *[retail.id_number(F.lit(i)) for i in ("OI0051", "R1000", "none")]) == (51, 1000, None)


def test_words(spark):
    words = [retail.pos_status(F.lit(w)) for w in (" approved", "Rejected ", "pending", "completed")]
    assert values(spark, *words) == ("COMPLETED", "BLOCKED", "PENDING", "COMPLETED")
    reasons = [retail.pos_reason(F.lit(w).cast("string")) for w in (" none ", "  ", "out_of_stock", None)]
    assert values(spark, *reasons) == (None, None, "OUT_OF_STOCK", None)


def test_amounts_dates_and_labels(spark):
    price = F.lit("12.35").cast("decimal(10,2)")
    assert values(
        spark,
        retail.line_amount(F.lit(3), price),
        retail.date_key(F.lit(date(2025, 2, 9))),
        retail.stock_condition(F.lit(2), F.lit(0)),
        retail.stock_condition(F.lit(0), F.lit(0)),
    ) == (Decimal("37.05"), 20250209, "PHYSICAL STOCK PRESENT BUT FULLY RESERVED", "NO CONFLICT")
