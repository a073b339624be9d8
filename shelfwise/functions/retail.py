"""Column expressions for the retail business rules."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

MONEY = "decimal(10,2)"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def shared_id(prefix: str, number: Column | str) -> Column:
    """Prefix plus the number padded to at least three digits: O041, O1000."""
    digits = _col(number).cast("string")
    return F.concat(F.lit(prefix), F.lpad(digits, F.greatest(F.lit(3), F.length(digits)), F.lit("0")))


def id_number(identifier: Column | str) -> Column:
    """The digits of an id as a number of any usual length; NULL when it has none."""
    digits = F.regexp_replace(_col(identifier), r"\D", "")
    return F.nullif(digits, F.lit("")).cast("decimal(38,0)")


def standard_word(c: Column | str) -> Column:
    return F.upper(F.trim(_col(c)))


def pos_status(c: Column | str) -> Column:
    """Till words mapped to the warehouse words."""
    word = standard_word(c)
    return (
        F.when(word == "APPROVED", F.lit("COMPLETED"))
        .when(word == "REJECTED", F.lit("BLOCKED"))
        .otherwise(word)
    )


def pos_reason(c: Column | str) -> Column:
    """'' and NONE both mean that there is no reason."""
    return F.nullif(F.nullif(standard_word(c), F.lit("")), F.lit("NONE"))


def line_amount(quantity: Column | str = "quantity", unit_price: Column | str = "unit_price") -> Column:
    return (_col(quantity) * _col(unit_price)).cast(MONEY)


def available_to_sell(on_hand: Column | str = "on_hand_quantity", reserved: Column | str = "reserved_quantity") -> Column:
    return _col(on_hand) - _col(reserved)


def date_key(day: Column | str) -> Column:
    return F.date_format(_col(day), "yyyyMMdd").cast("int")


def stock_condition(on_hand: Column | str = "on_hand_quantity", available: Column | str = "available_to_sell") -> Column:
    # fixed values
    return F.when(
        (_col(on_hand) > 0) & (_col(available) == 0), F.lit("PHYSICAL STOCK PRESENT BUT FULLY RESERVED")
    ).otherwise(F.lit("NO CONFLICT"))


def is_last_unit_conflict() -> Column:
    """Stock on the shelf that is completely held for online customers."""
    return (F.col("on_hand_quantity") > 0) & (F.col("reserved_quantity") > 0) & (F.col("available_to_sell") == 0)


def movement_effect(kind: str) -> Column:
    """Signed change of ``on_hand`` or ``reserved`` caused by one ledger row."""
    change, moved = F.col("quantity_change"), F.col("movement_type")
    if kind == "reserved":
        return (
            F.when(moved.isin("ONLINE_RESERVATION", "RESERVATION_RELEASE"), -change)
            .when(moved == "RESERVATION_COLLECTION", change)
            .otherwise(F.lit(0))
        )
    return F.when(moved.isin("ONLINE_RESERVATION", "RESERVATION_RELEASE"), F.lit(0)).otherwise(change)
