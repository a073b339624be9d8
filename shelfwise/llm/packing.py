"""Packs documents into fixed-length sequences, shortest pack first over the histogram of lengths.

Ids are cut into pieces of the sequence length; only the last piece of a document is shorter. The
histogram of piece lengths has at most ``sequence_length`` rows, whatever the data. On it the packs are
planned, longest pieces first, each into the emptiest pack that takes it, as patterns with counts. Pieces
find their place by the rank among pieces of their length.

Cases: a null or empty text is its end id alone; a null doc_id is carried; rows that repeat are packed
each by itself; a very long text is as many pieces as it needs; equal lengths take their places in the order of tasks and
rows; an empty table gives no rows; further columns of the input are not read.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from shelfwise.llm.text_ids import encoded, forget_words
from shelfwise.session import fresh_folder, store

PIECES = "doc_id {id}, start long, length long, doc_tokens long, ids array<int>, part int, slot long"
# Rows of the offset table up to which it is broadcast; beyond, it is joined by a shuffle.
BROADCAST_ROWS = 500_000


def cut(docs: DataFrame, tokenizer: str, keeps_blanks: bool, end_id: int, sequence_length: int) -> DataFrame:
    """One row per piece. ``slot`` numbers the pieces of one length within the task ``part``."""

    def pieces(batches: Iterator) -> Iterator:
        import numpy as np
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        seen = np.zeros(sequence_length + 1, dtype=np.int64)
        for rows, ids, tokens in encoded(batches, tokenizer, keeps_blanks, end_id):
            counts = -(-tokens // sequence_length)
            row = np.repeat(np.arange(len(tokens)), counts)
            start = (np.arange(len(row)) - np.repeat(np.cumsum(counts) - counts, counts)) * sequence_length
            length = np.minimum(tokens[row] - start, sequence_length)
            # number equal lengths in row order
            order = np.argsort(length, kind="stable")
            ordered = length[order]
            first = np.searchsorted(ordered, ordered)
            slot = np.empty(len(row), dtype=np.int64)
            slot[order] = seen[ordered] + np.arange(len(row)) - first
            seen += np.bincount(length, minlength=sequence_length + 1)
            ends = np.concatenate([[0], np.cumsum(length)]).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [
                    rows.column(0).take(pa.array(row)),
                    pa.array(start),
                    pa.array(length),
                    pa.array(tokens[row]),
                    pa.ListArray.from_arrays(pa.array(ends), pa.array(ids.view(np.int32))),
                    pa.array(np.full(len(row), part, dtype=np.int32)),
                    pa.array(slot),
                ],
                names=["doc_id", "start", "length", "doc_tokens", "ids", "part", "slot"],
            )

    id_type = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(pieces, PIECES.format(id=id_type))


def plan_packs(histogram: dict[int, int], sequence_length: int) -> list[tuple[int, list[int]]]:
    """Patterns (number of packs, lengths in them).

    A step uses up a pattern or a length, or opens one of at most two patterns per length; so there are a few
    patterns per length at most, whatever the counts.
    """
    done: list[tuple[int, list[int]]] = []
    open_packs: dict[int, list[tuple[int, list[int]]]] = defaultdict(list)  # by free room
    for length in sorted(histogram, reverse=True):
        left, room = histogram[length], sequence_length - 1
        while left:
            while room >= length and not open_packs[room]:
                room -= 1
            if room >= length:
                packs, pattern = open_packs[room].pop()
                used = min(packs, left)
                if packs > used:
                    open_packs[room].append((packs - used, pattern))
                pattern = [*pattern, length]
                left -= used
            else:
                # a new pack is the emptiest one, until it has no room
                most = min(left, sequence_length // length)
                used, pattern = left // most, [length] * most
                left -= used * most
            free = sequence_length - sum(pattern)
            if free:
                open_packs[free].append((used, pattern))
                room = max(room, free)
            else:
                done.append((used, pattern))
    return done + [pack for packs in open_packs.values() for pack in packs]


def places(patterns: list[tuple[int, list[int]]]) -> dict[str, list[int]]:
    """For each piece of each pattern: its length, the first rank it takes, the first sequence, the offset."""
    taken: dict[int, int] = defaultdict(int)
    rows, sequence = [], 0
    for packs, pattern in patterns:
        offset = 0
        for length in pattern:
            rows.append((length, taken[length], sequence, offset))
            taken[length] += packs
            offset += length
        sequence += packs
    rows.sort()
    return {name: [row[i] for row in rows] for i, name in enumerate(("length", "rank", "sequence", "offset"))}


def _placed(table: dict[str, list[int]], length: Column, rank: Column) -> Column:
    """The sequence and offset of the piece with this rank among pieces of its length."""

    @F.arrow_udf("struct<sequence_id: bigint, offset: bigint>")
    def place(length: pa.Array, rank: pa.Array) -> pa.Array:
        import numpy as np

        forget_words()  # workers are used again, and no text follows
        lengths, ranks, sequences, offsets = (np.array(table[k]) for k in ("length", "rank", "sequence", "offset"))
        asked, at_rank = length.to_numpy(zero_copy_only=False), rank.to_numpy(zero_copy_only=False)
        # ranks of one length are gapless, so lengths can follow each other on one line
        most = np.int64(1) << 48
        at = np.searchsorted(lengths * most + ranks, asked * most + at_rank, side="right") - 1
        found = [pa.array(sequences[at] + at_rank - ranks[at]), pa.array(offsets[at])]
        return pa.StructArray.from_arrays(found, ["sequence_id", "offset"])

    return place(length, rank)


def pack(
    docs: DataFrame, tokenizer: str, keeps_blanks: bool = True, end_id: int = 0, sequence_length: int = 1024
) -> DataFrame:
    """Pieces with their ids, ``sequence_id`` and ``offset``; sequence ids are dense from 0."""
    spark = docs.sparkSession
    pieces = store(cut(docs, tokenizer, keeps_blanks, end_id, sequence_length), fresh_folder(spark, "pieces"))
    counts = store(
        pieces.groupBy("part", "length").agg(F.count(F.lit(1)).alias("n")), fresh_folder(spark, "piece-counts")
    )
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("part", "length", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    if counts.count() <= BROADCAST_ROWS:
        offsets = F.broadcast(offsets)
    histogram = {row["length"]: row["n"] for row in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    table = places(plan_packs(histogram, sequence_length))
    ranked = pieces.join(offsets, ["part", "length"])
    return ranked.withColumn("place", _placed(table, F.col("length"), F.col("before") + F.col("slot"))).select(
        "doc_id", "start", "length", "doc_tokens", "ids", "place.sequence_id", "place.offset"
    )
