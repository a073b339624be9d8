"""Byte-level BPE of whole texts from a rank file, and back.

A text longer than a chunk is cut into chunks that overlap, and the chunks are dealt out: each is split by the
pre-token pattern from its own start on. What the pattern matches at a place depends on the text after it alone, so
where two neighbouring chunks have a boundary in common, their pre-tokens agree from there on. That is where they
are stitched: the first common boundary ends the piece of one and starts that of the next. Pieces are encoded side
by side, and their ids joined in order. A chunk that finds no common boundary with the one before it (a run of letters
or blanks longer than the overlap) becomes one with it and is split anew, until all meet. A text of one chunk is one
piece.

Decoding joins the bytes of the ids.

Cases: a null or empty text has no ids, and no ids are an empty text; null ids stay null; an id outside the ranks is
an error; special tokens are ordinary text; a null doc_id is carried; repeated rows are encoded each; an empty table
gives no rows; further columns are not read. A document's ids are one row, as its text is.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator
from itertools import pairwise

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from shelfwise.session import fresh_folder, store

CHUNK, OVERLAP = 1 << 15, 1 << 9
# A match is certain if this many more characters could be seen: a contraction has up to three.
AHEAD = 4
# Bytes of text worked on at a time.
SLICE_BYTES = 4 << 20

_loaded: dict = {}


def ranks_of(path: str) -> dict[bytes, int]:
    with open(path, "rb") as file:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, file)}


def _encoding(path: str, pattern: str):
    """The worker's encoder; loaded once per Python worker."""
    if (path, pattern) not in _loaded:
        import tiktoken

        _loaded[path, pattern] = tiktoken.Encoding(
            "ranks", pat_str=pattern, mergeable_ranks=ranks_of(path), special_tokens={}
        )
    return _loaded[path, pattern]


def _ids(encode, texts: list[str]) -> pa.Array:
    import numpy as np

    # a list of numbers takes ten times the memory of an array, so there is one at a time
    found = [np.array(encode(x), dtype=np.int32) for x in texts]
    ends = np.cumsum([0, *map(len, found)], dtype=np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(found)))


def _slices(batch: pa.RecordBatch, column: int) -> Iterator[pa.RecordBatch]:
    """Parts of a batch whose texts have few bytes, or are a single one."""
    import numpy as np
    import pyarrow.compute as pc

    held = np.cumsum(pc.binary_length(pc.fill_null(batch.column(column), "")).to_numpy(zero_copy_only=False).astype(np.int64))
    start = 0
    while start < len(held):
        before = held[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(held, before + SLICE_BYTES, side="right")))
        yield batch.slice(start, stop - start)
        start = stop


def encode_pieces(rows: DataFrame, path: str, pattern: str) -> DataFrame:
    """``text``, the last column of ``rows``, becomes ``ids``; each text is encoded by itself."""
    kept = rows.columns[:-1]

    def encoded(batches: Iterator) -> Iterator:
        encode = _encoding(path, pattern).encode_ordinary
        for batch in batches:
            for part in _slices(batch, len(kept)):
                texts = [x or "" for x in part.column(len(kept)).to_pylist()]
                yield pa.RecordBatch.from_arrays([*part.columns[:-1], _ids(encode, texts)], names=[*kept, "ids"])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields[:-1])
    return rows.mapInArrow(encoded, f"{schema}, ids array<int>")


def cut(docs: DataFrame, chunk: int, overlap: int) -> DataFrame:
    """Chunks: part and line say of which row, ``at`` where the chunk starts, ``core`` how much of it is its own."""

    def chunks(batches: Iterator) -> Iterator:
        from pyspark import TaskContext

        part, line = TaskContext.get().partitionId(), 0
        for batch in batches:
            for one in range(len(batch)):
                doc, text = batch.column(0).slice(one, 1), batch.column(1)[one].as_py()
                starts = range(0, len(text), chunk)
                for group in [starts[i : i + 64] for i in range(0, len(starts), 64)]:
                    yield pa.RecordBatch.from_arrays(
                        [
                            doc.take(pa.array([0] * len(group))),
                            pa.array([part] * len(group), pa.int32()),
                            pa.array([line] * len(group), pa.int64()),
                            pa.array(list(group), pa.int64()),
                            pa.array([min(chunk, len(text) - x) for x in group], pa.int64()),
                            pa.array([x + chunk + overlap >= len(text) for x in group]),
                            pa.array([text[x : x + chunk + overlap] for x in group]),
                        ],
                        names=["doc_id", "part", "line", "at", "core", "sees_end", "text"],
                    )
                line += 1

    doc = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {doc}, part int, line long, at long, core long, sees_end boolean, text string"
    return docs.select("doc_id", "text").mapInArrow(chunks, schema)


def split(chunks: DataFrame, pattern: str, overlap: int) -> DataFrame:
    """Add ``head`` and ``tail``: where pre-tokens start in the first characters and in those shared with the next."""

    def with_boundaries(batches: Iterator) -> Iterator:
        import regex

        find = regex.compile(pattern).finditer
        for batch in batches:
            for part in _slices(batch, 6):
                heads, tails = [], []
                for core, sees_end, text in zip(*[part.column(i).to_pylist() for i in (4, 5, 6)], strict=True):
                    sure = len(text) if sees_end else len(text) - AHEAD
                    starts = [0, *[x for m in find(text) if (x := m.end()) <= sure]]
                    heads.append([x for x in starts if x <= overlap])
                    # a piece that ended in white space would end like a text, which the pattern tells from a blank
                    tails.append([x - core for x in starts if x >= core and not text[x - 1].isspace()])
                kind = pa.list_(pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, pa.array(heads, kind), pa.array(tails, kind)],
                    names=[*part.schema.names, "head", "tail"],
                )

    columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in chunks.schema.fields)
    return chunks.mapInArrow(with_boundaries, f"{columns}, head array<long>, tail array<long>")


def stitch(chunks: DataFrame, pattern: str, overlap: int) -> DataFrame:
    """Pieces: doc_id, part, line, at, text. Chunks that meet nowhere are joined and split anew."""
    spark, row = chunks.sparkSession, ["part", "line"]
    while True:
        chunks = store(split(chunks, pattern, overlap), fresh_folder(spark, "bpe-chunks"))
        before = chunks.select(*row, (F.col("at") + F.col("core")).alias("at"), F.col("tail").alias("tail_before"))
        common = F.array_min(F.array_intersect("head", "tail_before"))
        joints = chunks.select(*row, "at", "head").join(before, [*row, "at"], "left")
        joints = joints.select(*row, "at", F.when(F.col("at") > 0, common).otherwise(0).alias("joint"))
        joints = store(joints, fresh_folder(spark, "bpe-joints"))
        if not joints.where("joint IS NULL").limit(1).count():
            break
        # each chunk without a joint goes to the last one before it that has one
        firsts = joints.selectExpr(*row, "at", "max(if(joint IS NULL, NULL, at)) OVER (PARTITION BY part, line ORDER BY at) AS first")
        whole = F.sort_array(F.collect_list(F.struct("at", "core", "sees_end", "text")))
        groups = chunks.join(firsts, [*row, "at"]).groupBy("doc_id", *row, "first").agg(whole.alias("all"))
        cores = F.transform("all", lambda x: F.substring(x["text"], F.lit(1), x["core"].cast("int")))
        last = F.element_at("all", -1)
        rest = F.substring(last["text"], last["core"].cast("int") + 1, F.lit(overlap))
        chunks = groups.select(
            "doc_id", *row, F.col("first").alias("at"),
            F.aggregate("all", F.lit(0).cast("long"), lambda done, x: done + x["core"]).alias("core"),
            last["sees_end"].alias("sees_end"), F.concat(F.array_join(cores, ""), rest).alias("text"),
        )
    after = joints.where("at > 0").select(*row, "at", F.col("joint").alias("joint_after"))
    found = (
        chunks.withColumn("next", F.col("at") + F.col("core"))
        .join(joints, [*row, "at"])
        .join(after.withColumnRenamed("at", "next"), [*row, "next"], "left")
    )
    end = F.col("core") + F.coalesce("joint_after", F.lit(0))
    piece = F.substring("text", (F.col("joint") + 1).cast("int"), (end - F.col("joint")).cast("int"))
    return found.select("doc_id", *row, "at", piece.alias("text"))


def encode(docs: DataFrame, path: str, pattern: str, chunk: int = CHUNK, overlap: int = OVERLAP) -> DataFrame:
    """doc_id and ``ids`` of every row."""
    rows, length = docs.select("doc_id", "text"), F.coalesce(F.length("text"), F.lit(0))
    short = encode_pieces(rows.where(length <= chunk), path, pattern)
    long = cut(rows.where(length > chunk), chunk, overlap).repartition("part", "line", "at")
    pieces = encode_pieces(stitch(long, pattern, overlap), path, pattern)
    joined = pieces.groupBy("doc_id", "part", "line").agg(F.sort_array(F.collect_list(F.struct("at", "ids"))).alias("all"))
    return short.unionByName(joined.select("doc_id", F.flatten(F.transform("all", lambda x: x["ids"])).alias("ids")))


def decode(ids: Column, path: str) -> Column:
    """The bytes of ids, whatever the pattern was."""

    @F.arrow_udf("binary")
    def joined(lists: pa.Array) -> pa.Array:
        if path not in _loaded:
            _loaded[path] = {rank: token for token, rank in ranks_of(path).items()}
        token = _loaded[path].__getitem__
        values, ends = lists.values.to_numpy(), lists.offsets.to_numpy()
        texts = [b"".join(map(token, values[lo:hi].tolist())) for lo, hi in pairwise(ends)]
        return pa.array(texts, pa.binary(), mask=lists.is_null().to_numpy(zero_copy_only=False))

    return joined(ids)


def ids_sha256(ids: Column) -> Column:
    """Hexadecimal SHA-256 of ids as little-endian unsigned 32-bit integers."""

    @F.arrow_udf("string")
    def digest(lists: pa.Array) -> pa.Array:
        values, ends = lists.values.to_numpy(), lists.offsets.to_numpy()
        return pa.array([hashlib.sha256(values[lo:hi]).hexdigest() for lo, hi in pairwise(ends)], pa.string())

    return digest(ids)
