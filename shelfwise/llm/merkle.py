"""A Merkle manifest of a table, and proofs climbed by a recursive query.

A leaf is the digest of a row. Per group (language) the leaves follow each other by doc_id, and runs of eight become
a node, level by level, until one is left; the groups' last nodes are the leaves of one more tree. A built level is
stored as node rows: group, level, place, the place of the parent, the digest, and the digests of the children.

A proof climbs with a recursive query of Spark: a row per leaf finds the node above it, appends the siblings it meets
there and folds what it carries with them; a row that finds no node has reached the root. All leaves of a group meet
in its upper nodes, so these are listed once per block of leaves (``BLOCK_LEVEL``): no join key has more than 4096
rows on the leaves' side, and the repeated nodes are a 4096th of the leaves per level.

Digests are kept as 32 bytes; they enter other digests as hexadecimal text.

Cases: a null value is told from an empty one; a null group is a group of its own, first; a null doc_id comes first in
its group; rows with equal doc_id follow by their digest, equal rows are leaves each; a group of one row has that leaf
as its last node, a table of one group has that group's as its root, without a proof; very long texts are digested
whole; an empty table has no leaves and no root; further columns are not read.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from shelfwise.operators.keys import number_rows
from shelfwise.session import fresh_folder, store

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
GROUP = "lang"
# Runs are of two to the power RUN_BITS, eight; up to BLOCK_LEVEL a node is listed once, above once per block.
RUN_BITS = 3
BLOCK_LEVEL = 4
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def hex_text(digests: Column) -> Column:
    return F.lower(F.hex(digests))


def digest_of(text: Column) -> Column:
    return F.unhex(F.sha2(text, 256))


def framed(value: Column) -> Column:
    """A value that cannot run into the next one: its length in bytes, a colon, itself; ``-`` for null."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_digest(text: Column) -> Column:
    return digest_of(F.concat(*[framed(text if c == "text" else F.col(c)) for c in FIELDS]))


def lower_cased_third(doc_id: Column, text: Column) -> Column:
    """The tampering that is to be found: A-Z become small where 3 divides the CRC-32 of doc_id."""
    hit = F.crc32(doc_id.cast("string").cast("binary")) % 3 == 0
    return F.when(hit, F.translate(text, _UPPER, _LOWER)).otherwise(text)


@dataclass
class Manifest:
    """``leaves``: doc_id, digest, claim, tree, place; ``trees``: tree, size, height, subroot; ``nodes`` of all trees,
    ``top`` nodes above them."""

    leaves: DataFrame
    trees: DataFrame
    nodes: DataFrame
    top: DataFrame
    root: bytes | None


def _height(size: Column) -> Column:
    """Levels above the leaves until one node is left."""
    return reduce(lambda a, b: a + b, [F.when(size > 1 << (RUN_BITS * i), 1).otherwise(0) for i in range(20)])


def _levels(bottom: DataFrame, folder: str) -> tuple[DataFrame, DataFrame]:
    """(nodes, last digest per tree) above ``bottom``: tree, height, place, digest."""
    spark, levels = bottom.sparkSession, []
    row = ["tree", "height", "place", "digest"]
    lasts = [bottom.where("height = 0").select("tree", "digest")]
    current = bottom.select(*row)
    highest = bottom.agg(F.max("height")).first()[0] or 0
    for level in range(1, highest + 1):
        run = F.sort_array(F.collect_list(F.struct("place", "digest")))  # at most eight
        current = (
            current.where(F.col("height") >= level)
            .groupBy("tree", "height", F.shiftright("place", RUN_BITS).alias("place"))
            .agg(F.aggregate(run, F.lit(b""), lambda done, x: F.concat(done, x["digest"])).alias("children"))
            .withColumn("digest", digest_of(hex_text(F.col("children"))))
            .withColumn("level", F.lit(level))
            .withColumn("parent", F.when(F.col("height") > level, F.shiftright("place", RUN_BITS)))
        )
        current = store(current, f"{folder}-level-{level}")
        levels.append(current)
        lasts.append(current.where("height = level").select("tree", "digest"))
    empty = "tree long, height int, place long, children binary, digest binary, level int, parent long"
    return reduce(DataFrame.unionByName, levels, spark.createDataFrame([], empty)), reduce(DataFrame.union, lasts)


def build(docs: DataFrame, claimed: Column | None = None) -> Manifest:
    """The manifest of a table; ``claimed`` is the digest that a proof shall fold, the leaf's own if none is given."""
    spark = docs.sparkSession
    digest = leaf_digest(F.col("text"))
    rows = docs.select("doc_id", F.col(GROUP).alias("grp"), digest.alias("digest"), (digest if claimed is None else claimed).alias("claim"))
    rows = store(rows, fresh_folder(spark, "merkle-rows"))
    numbered = number_rows(rows, ["grp", "doc_id", "digest", "claim"], "at", start=-1)
    numbered = store(numbered, fresh_folder(spark, "merkle-numbered"))
    sizes = numbered.groupBy("grp").agg(F.count(F.lit(1)).alias("size"), F.min("at").alias("first"))
    trees = number_rows(store(sizes, fresh_folder(spark, "merkle-sizes")), ["grp"], "tree", start=-1)
    trees = store(trees.withColumn("height", _height(F.col("size"))), fresh_folder(spark, "merkle-trees"))
    groups = trees.select(F.col("grp").alias("_grp"), "tree", "height", "first")
    leaves = numbered.join(groups, F.col("grp").eqNullSafe(F.col("_grp"))).select(
        "at", "doc_id", "digest", "claim", "tree", "height", (F.col("at") - F.col("first")).alias("place")
    )
    leaves = store(leaves, fresh_folder(spark, "merkle-leaves"))
    nodes, lasts = _levels(leaves, fresh_folder(spark, "merkle-nodes"))
    trees = store(
        trees.join(lasts.withColumnRenamed("digest", "subroot"), "tree").select("tree", "size", "height", "subroot"),
        fresh_folder(spark, "merkle-subroots"),
    )
    n_trees = trees.count()
    bottom = trees.select(
        F.lit(0).cast("long").alias("tree"), _height(F.lit(n_trees)).alias("height"), F.col("tree").alias("place"),
        F.col("subroot").alias("digest"),
    )
    top, last = _levels(bottom, fresh_folder(spark, "merkle-top"))
    root = last.first()
    return Manifest(leaves, trees, nodes, top, None if root is None else bytes(root["digest"]))


def rungs(manifest: Manifest) -> DataFrame:
    """tree, level, spot, children, nth: what a leaf of the tree finds on a level, by its place.

    ``spot`` is the leaf's place cut to the level, and no coarser than a block; ``nth`` is set where the place does
    not say which of the children one comes from.
    """

    def spots(level: Column, first: Column, last: Column) -> Column:
        """All spots of the leaves from ``first`` to ``last``."""
        bits = F.least(level, F.lit(BLOCK_LEVEL)) * RUN_BITS
        shifted = lambda x: F.call_function("shiftright", x, bits)
        return F.explode(F.sequence(shifted(first), shifted(last)))

    level, size = F.col("level"), F.col("size")
    bits = level * RUN_BITS
    first = F.call_function("shiftleft", F.col("place"), bits)
    end = F.least(F.call_function("shiftleft", F.col("place") + 1, bits), size) - 1
    within = manifest.nodes.join(manifest.trees.select("tree", "size"), "tree").select(
        "tree", "level", spots(level, first, end).alias("spot"), "children", F.lit(None).cast("int").alias("nth")
    )
    top = manifest.top.select(F.col("level").alias("step"), F.col("place").alias("top_place"), "children")
    steps = manifest.top.agg(F.max("level")).first()[0] or 0
    places = manifest.trees.select(
        "*", F.explode(F.sequence(F.lit(1), F.lit(steps)) if steps else F.array().cast("array<int>")).alias("step")
    )
    here = F.call_function("shiftright", F.col("tree"), F.col("step") * RUN_BITS)
    child = F.call_function("shiftright", F.col("tree"), (F.col("step") - 1) * RUN_BITS)
    above = (
        places.withColumn("top_place", here)
        .join(top, ["step", "top_place"])
        .withColumn("level", F.col("height") + F.col("step"))
        .select(
            "tree",
            "level",
            spots(level, F.lit(0).cast("long"), size - 1).alias("spot"),
            "children",
            child.bitwiseAND(F.lit((1 << RUN_BITS) - 1)).cast("int").alias("nth"),
        )
    )
    return within.unionByName(above)


# LIMIT ALL: a climb has as many rows as the leaves have ancestors
_CLIMB = f"""
WITH RECURSIVE climb (at, tree, place, level, siblings, folded) AS (
    SELECT at, tree, place, 0, CAST('' AS BINARY), claim FROM {{leaves}}
    UNION ALL
    SELECT at, tree, place, level, concat(`left`, `right`), unhex(sha2(lower(hex(concat(`left`, folded, `right`))), 256))
    FROM (
        SELECT c.at, c.tree, c.place, c.level + 1 AS level, c.folded,
               substring(r.children, 1, 32 * coalesce(r.nth, CAST(shiftright(c.place, {RUN_BITS} * c.level) & 7 AS INT))) AS `left`,
               substring(r.children, 32 * coalesce(r.nth, CAST(shiftright(c.place, {RUN_BITS} * c.level) & 7 AS INT)) + 33) AS `right`
        FROM climb c JOIN {{rungs}} r
        ON r.tree = c.tree AND r.level = c.level + 1
        AND r.spot = shiftright(c.place, {RUN_BITS} * least(c.level + 1, {BLOCK_LEVEL}))
    )
)
SELECT at, level, siblings, folded FROM (SELECT * FROM climb LIMIT ALL)"""


def prove(manifest: Manifest) -> DataFrame:
    """doc_id, leaf, subroot, proof (digests of the siblings, from the leaf to the root), folded."""
    spark = manifest.leaves.sparkSession
    listed = store(rungs(manifest), fresh_folder(spark, "merkle-rungs"))
    claims = manifest.leaves.select("at", "tree", "place", "claim")
    steps = spark.sql(_CLIMB, leaves=claims, rungs=listed)
    path = F.sort_array(F.collect_list(F.struct("level", "siblings", "folded")))  # a row per level
    climbed = steps.groupBy("at").agg(path.alias("path"))
    proof = F.aggregate("path", F.lit(b""), lambda done, x: F.concat(done, x["siblings"]))
    climbed = climbed.select("at", proof.alias("proof"), F.element_at("path", -1)["folded"].alias("folded"))
    leaves = manifest.leaves.select("at", "doc_id", F.col("digest").alias("leaf"), "tree")
    return (
        leaves.join(climbed, "at")
        .join(manifest.trees.select("tree", "subroot"), "tree")
        .select("doc_id", "leaf", "subroot", "proof", "folded")
    )
