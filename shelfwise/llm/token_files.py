"""Token ids as ORC files in doc_id order.

Rows are dealt by ranges of doc_id and sorted, encoded, and written as ORC: ids and counts are integer
run-length encoded, row groups carry min/max indexes, and doc_id a Bloom filter, so a reader can take
stripes side by side and skip those that cannot hold a document.

Cases: a null or empty text is its end id alone; a null doc_id comes first; rows with equal doc_id
follow in the order of their text's hash; a very long text is one row with all its ids; an empty table gives files
without rows; further columns of the input are not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from itertools import pairwise

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from shelfwise.llm.text_ids import encoded, forget_words
from shelfwise.session import fresh_folder

LAYOUT = {
    "orc.bloom.filter.columns": "doc_id",
    "orc.bloom.filter.fpp": "0.01",
    "orc.create.index": "true",
    "orc.row.index.stride": "1000",
    "orc.stripe.size": str(16 << 20),
    "compression": "zstd",
}
ROWS = "doc_id {id}, part int, start_in_part long, n_tokens long, ids array<int>"


def rows_with_ids(docs: DataFrame, tokenizer: str, keeps_blanks: bool, end_id: int) -> DataFrame:
    """Ids per document in the order of the rows; ``start_in_part`` counts the ids of the task before it."""

    def rows_of(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa
        from pyspark import TaskContext

        part, before = TaskContext.get().partitionId(), 0
        for rows, ids, tokens in encoded(batches, tokenizer, keeps_blanks, end_id):
            ends = np.concatenate([[0], np.cumsum(tokens)])
            yield pa.RecordBatch.from_arrays(
                [
                    rows.column(0),
                    pa.array(np.full(len(tokens), part, dtype=np.int32)),
                    pa.array(before + ends[:-1]),
                    pa.array(tokens),
                    pa.ListArray.from_arrays(
                        pa.array(ends.astype(np.int32)), pa.array(ids.view(np.int32))
                    ),
                ],
                names=["doc_id", "part", "start_in_part", "n_tokens", "ids"],
            )
            before += int(ends[-1])

    id_type = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(rows_of, ROWS.format(id=id_type))


def write_ids(docs: DataFrame, folder: str, tokenizer: str, keeps_blanks: bool = False, end_id: int = 1) -> str:
    """Write the files; their names sort in doc_id order."""
    # the text's hash only orders rows of equal doc_id, so that a retried task writes the same file
    order = [F.col("doc_id").asc_nulls_first(), F.xxhash64("text")]
    dealt = docs.select("doc_id", "text").repartitionByRange(*order).sortWithinPartitions(*order)
    rows_with_ids(dealt, tokenizer, keeps_blanks, end_id).write.options(**LAYOUT).orc(folder)
    return folder


def read_ids(spark: SparkSession, folder: str, id_type: str = "long") -> DataFrame:
    """doc_id, start (ids of all documents before it), n_tokens, ids.

    A file's start is the sum over the files before it: one row per file, not per document.
    """
    files = spark.read.schema(ROWS.format(id=id_type)).orc(folder)
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        files.groupBy("part")
        .agg(F.sum("n_tokens").alias("n"))
        .select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("part_start"))
    )
    # one row per file, each far larger than its row here
    return files.join(F.broadcast(starts), "part").select(
        "doc_id", (F.col("part_start") + F.col("start_in_part")).alias("start"), "n_tokens", "ids"
    )


def ids_crc32(ids: Column) -> Column:
    """Unsigned CRC-32 of ids as little-endian unsigned 32-bit integers."""

    @F.arrow_udf("long")
    def crc(ids: pa.Array) -> pa.Array:
        forget_words()  # workers are used again, and no text follows
        values, ends = ids.values.to_numpy(), ids.offsets.to_numpy()
        return pa.array([zlib.crc32(values[lo:hi]) for lo, hi in pairwise(ends)], type=pa.int64())

    return crc(ids)


def token_table(docs: DataFrame, tokenizer: str, keeps_blanks: bool = False, end_id: int = 1) -> DataFrame:
    """Write the ids of all documents to a new folder and read them back."""
    folder = write_ids(docs, fresh_folder(docs.sparkSession, "token-ids"), tokenizer, keeps_blanks, end_id)
    return read_ids(docs.sparkSession, folder, docs.schema["doc_id"].dataType.simpleString())
