"""Removes lines that many sites share.

The spread of a line is the number of distinct sites it occurs on. Every line has a HyperLogLog sketch of its
sites, merged by the aggregation, so a line that is on every page of the web costs a few kilobytes. Where the
estimate is within its error of the limit the sites are counted exactly. Of a line whose spread reaches the
limit the first occurrence stays (least doc_id, then first in the text); all others go.

Lines are compared with blanks at both ends taken off; lines without letters or digits are left alone.

Cases: a null text stays null, an empty one empty; a null source is a site of its own; a null doc_id comes after
all others; rows equal in doc_id and text share the first occurrence, so each of them keeps it; an empty table
gives no rows; further columns, whatever their names, pass through. A text that loses all its lines stays as an
empty text. A very long text is cut into lines whole, however many it has; of a line's occurrences in rows with one
doc_id the first place counts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from shelfwise.session import fresh_folder, store

# Sites from which on a line is boilerplate.
MIN_SITES = 10
# Sketch of 2^12 registers: a relative error of 1.04 / 64 per standard deviation. Below a few hundred sites it is exact
# in practice; the band takes four deviations.
SKETCH_BITS = 12
BAND = 4 * 1.04 / 2 ** (SKETCH_BITS / 2)


def _lines(docs: DataFrame) -> DataFrame:
    """doc_id, text_hash, pos, key, site of every line that has letters or digits."""
    lines = docs.select("doc_id", "source", F.xxhash64("text").alias("text_hash"), F.posexplode(F.split("text", "\n")))
    bare = F.trim("col")
    return lines.where(bare.rlike(r"[\p{L}\p{N}]")).select(
        "doc_id",
        "text_hash",
        "pos",
        F.xxhash64(bare).alias("key"),
        F.xxhash64("source", F.col("source").isNull()).alias("site"),
    )


def spread_lines(docs: DataFrame, min_sites: int = MIN_SITES) -> DataFrame:
    """key, n_sites and the first occurrence of the lines on ``min_sites`` sites or more."""
    spark = docs.sparkSession
    lines = _lines(docs)
    # null ids come last
    place = F.struct(F.col("doc_id").isNull().alias("absent"), "doc_id", "text_hash", "pos")
    sketches = (
        lines.groupBy("key")
        .agg(F.hll_sketch_agg("site", SKETCH_BITS).alias("sites"), F.min(place).alias("first"))
        .select("key", F.hll_sketch_estimate("sites").alias("estimate"), "first")
        .where(F.col("estimate") >= min_sites * (1 - BAND) - 1)
    )
    sketches = store(sketches, fresh_folder(spark, "line-spread"))
    near = F.col("estimate") <= min_sites * (1 + BAND) + 1
    exact = (
        lines.join(sketches.where(near).select("key"), "key", "left_semi")
        .select("key", "site")
        .distinct()
        .groupBy("key")
        .agg(F.count(F.lit(1)).alias("exact"))
    )
    counted = sketches.join(exact, "key", "left").withColumn("n_sites", F.coalesce("exact", "estimate"))
    return counted.where(F.col("n_sites") >= min_sites).select("key", "n_sites", "first")


def remove_spread_lines(docs: DataFrame, min_sites: int = MIN_SITES) -> DataFrame:
    """The rows of ``docs`` as a struct ``doc``, with ``text`` (new), ``n_lines`` and ``n_removed``."""
    spark = docs.sparkSession
    spread = store(spread_lines(docs, min_sites), fresh_folder(spark, "spread-lines"))
    here = F.struct(F.col("doc_id").isNull().alias("absent"), "doc_id", "text_hash", "pos")
    # a text is named by its id and hash, so rows with equal ids keep their own lines
    gone = (
        _lines(docs)
        .join(spread, "key")
        .where(~here.eqNullSafe(F.col("first")))
        .groupBy("doc_id", "text_hash")
        .agg(F.collect_set("pos").alias("gone"))
        .withColumnRenamed("doc_id", "_gone_id")
    )
    rows = docs.select(F.struct("*").alias("doc"), F.xxhash64("text").alias("text_hash"))
    rows = rows.join(
        gone, F.col("doc.doc_id").eqNullSafe(F.col("_gone_id")) & (rows["text_hash"] == gone["text_hash"]), "left"
    ).select("doc", "gone", F.split("doc.text", "\n").alias("lines"))
    last = F.size("lines") - 1
    stay = F.array_except(F.sequence(F.lit(0), last), "gone")
    kept = F.array_join(F.transform(stay, lambda at: F.get("lines", at)), "\n")
    return rows.select(
        "doc",
        F.when(F.col("gone").isNull(), F.col("doc.text")).otherwise(kept).alias("text"),
        F.when(F.col("lines").isNull(), 0).otherwise(F.size("lines")).alias("n_lines"),
        F.when(F.col("gone").isNull(), 0).otherwise(F.size("gone")).alias("n_removed"),
    )
