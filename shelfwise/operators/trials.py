"""Slices of a hot pair that are tried before it is known what the slices before them leave.

A slice is decided from an opening: the stock, and what the ledger says about its references. The opening of the
next slice is known; those of later ones are guessed, and all are decided side by side. A scarce shelf is soon as
empty whatever it held first, so most guesses come true; openings that did not are derived anew from the last tries, and
only their slices are decided again. The tries from the front on whose openings are those that the tries before them leave
are final, which by induction are the decisions of a walk from request to request.

At least one slice of a pair becomes final with each wave. The next wave looks ahead as far as ``GROWTH`` times what has
become final, so waves grow by a factor while guesses hold, and requests are tried ``GROWTH`` times or so at worst.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from shelfwise.operators.shelf import RELEASE, RESERVE, SELL

PAIR = ["product_id", "store_id"]
SLICE = [*PAIR, "slice"]
PRIOR = ["held", "balance", "closed", "sold"]
FIRST_WIDTH, GROWTH = 4, 4

TRIES = (
    "product_id string, store_id string, slice bigint, wave int, used_on_hand bigint, used_reserved bigint,"
    " used_priors struct<a: bigint, b: bigint>, units_sold bigint, units_held bigint, least_on_hand bigint, least_spare bigint"
)


def units(kind: str, sign: int = 1) -> Column:
    return F.when(F.col("kind") == kind, sign * F.col("quantity").cast("bigint"))


def priors(asked: DataFrame, decisions: DataFrame, ledger: DataFrame | None) -> DataFrame:
    """What is known of each reference of the ``asked`` requests before their slice, where anything is.

    ``decisions`` are the tries of slices before, ``ledger`` what is final.
    """
    added = (
        decisions.where("applied")
        .groupBy(*SLICE, "reference")
        .agg(
            F.max(units(RESERVE)).alias("held"),
            F.sum(F.coalesce(units(RESERVE), units(RELEASE, -1))).alias("balance"),
            F.bool_or(F.col("kind") == RELEASE).alias("closed"),
            F.max(units(SELL)).alias("sold"),
        )
    )
    before = Window.partitionBy(*PAIR, "reference").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    folds = {"held": F.max, "balance": F.sum, "closed": F.bool_or, "sold": F.max}
    known = asked.select(*SLICE, "reference").distinct().join(added, [*SLICE, "reference"], "left")
    known = known.select(*SLICE, "reference", *[fold(name).over(before).alias(name) for name, fold in folds.items()])
    if ledger is not None:
        final = ledger.select(*PAIR, "reference", *[F.col(name).alias(f"_{name}") for name in PRIOR])
        known = known.join(final, [*PAIR, "reference"], "left").select(
            *SLICE,
            "reference",
            F.greatest("held", "_held").alias("held"),
            F.coalesce(F.col("balance") + F.col("_balance"), "balance", "_balance").alias("balance"),
            (F.coalesce("closed", F.lit(False)) | F.coalesce("_closed", F.lit(False))).alias("closed"),
            F.greatest("sold", "_sold").alias("sold"),
        )
    return known.select(
        *SLICE,
        "reference",
        F.col("held").cast("bigint").alias("held"),
        F.col("balance").cast("bigint").alias("balance"),
        F.coalesce("closed", F.lit(False)).alias("closed"),
        F.col("sold").cast("bigint").alias("sold"),
    ).where("held is not null or balance is not null or sold is not null")


def digests(known: DataFrame) -> DataFrame:
    """128 bits per slice over all its priors: two tries agree on them only if these do."""
    row = F.to_json(F.struct("reference", *PRIOR))
    both = F.struct(
        F.bit_xor(F.xxhash64(row)).alias("a"), F.bit_xor(F.xxhash64(F.lit("b"), F.reverse(row))).alias("b")
    )
    return known.groupBy(*SLICE).agg(both.alias("priors"))


def _same_answers(on_hand: Column) -> Column:
    """Whether a try with as much free stock, but another stock on hand, gives the same answers.

    Stock on hand matters beside the free stock for the reason of a refused sale and for releases, which need as
    much reserved; ``least_on_hand`` and ``least_spare`` are the smallest margins the try has met.
    """
    shift = on_hand - F.col("used_on_hand")
    sales = F.col("least_on_hand").isNull() | ((F.col("least_on_hand") > 0) & (F.col("least_on_hand") + shift > 0))
    releases = F.col("least_spare").isNull() | ((F.col("least_spare") >= 0) & (F.col("least_spare") + shift >= 0))
    return (shift == 0) | (sales & releases)


def checked(asked: DataFrame, tries: DataFrame, known: DataFrame, summary: DataFrame) -> DataFrame:
    """For each asked slice: is its try ``final``, or is it due ``again``, and from which opening.

    ``asked`` has the stock at ``next_slice``, where nothing is final yet.
    """
    in_order = Window.partitionBy(*PAIR).orderBy("slice")
    earlier = in_order.rowsBetween(Window.unboundedPreceding, -1)
    so_far = in_order.rowsBetween(Window.unboundedPreceding, 0)
    rows = (
        asked.join(tries, SLICE, "left")
        .join(digests(known), SLICE, "left")
        .join(summary.select(*SLICE, "wanted", "returned"), SLICE)
    )
    moved = lambda name: F.coalesce(F.sum(name).over(earlier), F.lit(0))
    rows = rows.withColumns(
        {
            "left_on_hand": F.col("on_hand") - moved("units_sold"),
            "left_reserved": F.col("reserved") + moved("units_held"),
            "used_free": F.col("used_on_hand") - F.col("used_reserved"),
            "calm": F.col("on_hand") - F.col("reserved") + moved("returned") - moved("wanted"),
        }
    )
    free = F.col("left_on_hand") - F.col("left_reserved")
    agrees = F.col("wave").isNotNull() & F.col("priors").eqNullSafe(F.col("used_priors"))
    holds = agrees & (F.col("used_free") == free) & _same_answers(F.col("left_on_hand"))
    rows = rows.withColumns({"agrees": agrees, "holds": F.coalesce(holds, F.lit(False))})
    rows = rows.withColumns(
        {
            "final": F.bool_and("holds").over(so_far),
            "known_opening": F.coalesce(F.bool_and("holds").over(earlier), F.lit(True)),
            # what the try before leaves; where there is none, as if every request were served as far as stock goes
            "guess": F.coalesce(
                F.lag(F.col("used_free") - F.col("units_sold") - F.col("units_held")).over(in_order),
                F.col("calm") - F.least(F.min("calm").over(so_far), F.lit(0)),
            ),
        }
    )
    guess = F.greatest("guess", F.lit(0))
    rows = rows.withColumns(
        {
            "open_on_hand": F.when(F.col("known_opening"), F.col("left_on_hand")).otherwise(F.greatest("left_on_hand", guess)),
            "n_final": F.sum(F.col("final").cast("int")).over(Window.partitionBy(*PAIR)),
        }
    )
    rows = rows.withColumns(
        {
            "open_reserved": F.when(F.col("known_opening"), F.col("left_reserved")).otherwise(F.col("open_on_hand") - guess),
            "next_width": F.greatest(F.lit(FIRST_WIDTH), GROWTH * F.col("n_final")).cast("bigint"),
        }
    )
    near = F.col("slice") < F.col("next_slice") + F.col("n_final") + F.col("next_width")
    stands = F.col("agrees") & (F.col("used_free") == F.col("open_on_hand") - F.col("open_reserved"))
    stands = F.coalesce(stands & _same_answers(F.col("open_on_hand")), F.lit(False))
    return rows.select(
        *SLICE, "final", "n_final", "next_slice", "last_slice", "next_width",
        (~F.col("final") & near & ~stands).alias("again"), (~F.col("final") & near & stands).alias("stands"),
        "open_on_hand", "open_reserved", "priors", *tries.columns[len(SLICE) :],
    )


def tried(decisions: DataFrame, again: DataFrame, wave: int) -> DataFrame:
    """One row per slice that was tried: opening, what it moves, and margins."""
    applied = lambda value: F.coalesce(F.sum(F.when(F.col("applied"), value)), F.lit(0))
    moves = decisions.groupBy(*SLICE).agg(
        applied(units(SELL)).alias("units_sold"),
        applied(F.coalesce(units(RESERVE), units(RELEASE, -1))).alias("units_held"),
        F.min("least_on_hand").alias("least_on_hand"),
        F.min("least_spare").alias("least_spare"),
    )
    used = again.select(
        *SLICE,
        F.lit(wave).alias("wave"),
        F.col("open_on_hand").cast("bigint").alias("used_on_hand"),
        F.col("open_reserved").cast("bigint").alias("used_reserved"),
        F.col("priors").alias("used_priors"),
    )
    return used.join(moves, SLICE)
