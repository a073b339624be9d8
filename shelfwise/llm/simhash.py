"""Near copies by SimHash fingerprints, found with vantage-point trees.

A fingerprint has a bit set where more than half of the shingle hashes have it. Documents link when their
fingerprints differ in at most ``max_bits`` bits. Each distinct fingerprint is searched once.

A tree of vantage points, fitted on a bounded sample of fingerprints, splits all fingerprints by their Hamming
distance to the vantage point of each node; its leaves are the shards. By the triangle inequality a fingerprint at
distance d can only have partners at distances d - max_bits to d + max_bits, so it is sent as a query to just
those further shards that such partners can be in. Every shard is searched with a tree of its own in memory and
answers with the links of a spanning forest, not with all pairs. Shards that hold too many fingerprints, as many
near copies of one text do, are cut into blocks that are searched side by side.

Cases: a null or empty text has no words and the fingerprint zero, which links like any other; a null doc_id
counts only if a component has no other id; repeated rows share a fingerprint; a bit that is set in exactly half of
the hashes is 0; very long texts are read whole; an empty table gives no rows; further columns do not matter.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from shelfwise.llm.components import components
from shelfwise.session import fresh_folder, store

SEED = 42
BITS = 64
SHINGLE = 3
MAX_BITS = 3
# Fingerprints at home in a shard, or in a block of a shard that holds more; fingerprints that ask a block at a time.
SHARD, ASKED = 16_384, 262_144
# Fingerprints that the tree over shards is fitted on, and candidates for a vantage point.
SAMPLE, CANDIDATES = 4096, 8
# Fingerprints of a leaf inside a shard, and queries compared with them at a time.
LEAF, QUERIES = 256, 4096
# Shingles whose bits are counted at a time.
COUNTED = 1 << 16


def fingerprint(text: Column, shingle: int = SHINGLE) -> Column:
    """64 bits as a long."""

    @F.pandas_udf("long")
    def of(texts):
        from itertools import islice, repeat

        import numpy as np
        import pandas as pd
        from xxhash import xxh64_digest

        found = np.zeros(len(texts), dtype=np.int64)
        for row, text in enumerate(texts):
            words = text.encode().lower().split() if text else []  # A-Z, and the six ASCII spaces, alone
            if not words:
                continue
            runs = zip(*(islice(words, k, None) for k in range(shingle))) if len(words) >= shingle else [words]
            digests = map(xxh64_digest, map(b" ".join, runs), repeat(SEED))
            counts, n = np.zeros(BITS, dtype=np.int64), 0
            while part := b"".join(islice(digests, COUNTED)):
                bits = np.unpackbits(np.frombuffer(part, dtype=np.uint8)).reshape(-1, BITS)
                counts += bits.sum(axis=0, dtype=np.int64)
                n += len(bits)
            found[row] = np.packbits(2 * counts > n).view(">i8")[0]
        return pd.Series(found)

    return of(text)


def as_hex(fp: Column) -> Column:
    return F.lpad(F.lower(F.hex(fp)), BITS // 4, "0")


def distances(fps, vantage):
    import numpy as np

    return np.bitwise_count(fps ^ vantage)


def fit_tree(sample, leaves: int, max_bits: int) -> list[tuple]:
    """Nodes (vantage, radius, inner, outer); a child below zero is the shard -child - 1.

    The vantage point of a node is the candidate that leaves the fewest points of the sample within reach of
    both children.
    """
    import numpy as np

    nodes: list[list] = []
    shards = 0

    def grow(points, wanted: int) -> int:
        nonlocal shards
        best = None
        if wanted > 1 and len(points) > 1:
            for vantage in points[:: max(1, len(points) // CANDIDATES)][:CANDIDATES]:
                d = distances(points, vantage).astype(int)
                radius = int(np.median(d))
                inner = d <= radius
                if inner.all():
                    radius -= 1
                    inner = d <= radius
                if inner.any() and not inner.all():
                    reach = ((d > radius - max_bits) & (d <= radius + max_bits)).sum()
                    cost = reach + abs(int(inner.sum()) * 2 - len(points))
                    if best is None or cost < best[0]:
                        best = cost, vantage, radius, inner
        if best is None:
            shards += 1
            return -shards
        _, vantage, radius, inner = best
        at = len(nodes)
        nodes.append([vantage, radius, 0, 0])
        nodes[at][2] = grow(points[inner], wanted // 2)
        nodes[at][3] = grow(points[~inner], wanted - wanted // 2)
        return at

    grow(sample, leaves)
    return [tuple(x) for x in nodes]


def route(fps, nodes: list[tuple], max_bits: int) -> Iterator[tuple]:
    """(rows, shard, is_home) for all fingerprints.

    A pair that a node parts is met once: the outer one is a query inside, not the inner one outside.
    """
    import numpy as np

    todo = [(0 if nodes else -1, np.arange(len(fps)), np.ones(len(fps), dtype=bool))]
    while todo:
        at, rows, home = todo.pop()
        if not len(rows):
            continue
        if at < 0:
            yield rows, -at - 1, home
            continue
        vantage, radius, inner, outer = nodes[at]
        d = distances(fps[rows], vantage).astype(int)
        inside = d <= radius
        into = inside | (d <= radius + max_bits)
        todo.append((inner, rows[into], home[into] & inside[into]))
        out = (home & ~inside) | (~home & (d > radius - max_bits))
        todo.append((outer, rows[out], home[out]))


def least_labels(n: int, a, b):
    """The smallest index that each of n items is joined to by the pairs (a, b)."""
    import numpy as np

    label = np.arange(n)
    while len(a):
        before = label.copy()
        least = np.minimum(before[a], before[b])
        np.minimum.at(label, before[a], least)
        np.minimum.at(label, before[b], least)
        label = label[label]
        if (label == before).all():
            break
    return label


def forest(fps, home, max_bits: int):
    """Pairs (a, b) that join all fingerprints that links with a home fingerprint join."""
    import numpy as np

    found_a, found_b = [np.zeros(0, dtype=np.int64)], [np.zeros(0, dtype=np.int64)]
    todo = [(np.flatnonzero(home), np.arange(len(fps)))]
    while todo:
        inside, asked = todo.pop()
        parts = None
        if len(inside) > LEAF:
            for vantage in fps[inside[:: max(1, len(inside) // 3)][:3]]:
                d = distances(fps[inside], vantage).astype(int)
                radius = int(np.median(d))
                if radius < d.max():
                    parts = inside[d <= radius], inside[d > radius]
                    break
        if parts:
            d = distances(fps[asked], vantage).astype(int)
            todo.append((parts[0], asked[d <= radius + max_bits]))
            todo.append((parts[1], asked[d > radius - max_bits]))
            continue
        for i in range(0, len(inside), LEAF):
            rows = inside[i : i + LEAF]
            for j in range(0, len(asked), QUERIES):
                columns = asked[j : j + QUERIES]
                r, c = np.nonzero(np.bitwise_count(fps[rows][:, None] ^ fps[columns][None, :]) <= max_bits)
                if len(r):
                    # the pairs of the block, cut down to a forest
                    labels = least_labels(len(rows) + len(columns), r, c + len(rows))
                    both = np.concatenate([rows, columns])
                    joined = np.flatnonzero(labels != np.arange(len(labels)))
                    found_a.append(both[joined])
                    found_b.append(both[labels[joined]])
    a, b = np.concatenate(found_a), np.concatenate(found_b)
    labels = least_labels(len(fps), a, b)
    joined = np.flatnonzero(labels != np.arange(len(labels)))
    return joined, labels[joined]


def near_links(fps: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """Distinct fingerprints (fp) -> links (a, b) that join whatever chains of close pairs join."""
    spark: SparkSession = fps.sparkSession
    n = fps.count()
    shards = max(1, -(-n // SHARD))
    nodes: list[tuple] = []
    if shards > 1:
        import numpy as np

        # a hash orders the sample, so reruns fit the same tree
        sample = fps.orderBy(F.xxhash64("fp"), "fp").limit(min(SAMPLE, n // 4)).collect()
        nodes = fit_tree(np.array([row["fp"] for row in sample], dtype=np.int64).view(np.uint64), shards, max_bits)

    def routed(batches: Iterator) -> Iterator:
        import numpy as np
        import pandas as pd

        for batch in batches:
            values = batch["fp"].to_numpy()
            parts = list(route(values.view(np.uint64), nodes, max_bits))
            yield pd.DataFrame(
                {
                    "fp": np.concatenate([values[rows] for rows, _, _ in parts]),
                    "shard": np.concatenate([np.full(len(rows), shard) for rows, shard, _ in parts]),
                    "home": np.concatenate([home for _, _, home in parts]),
                }
            )

    places = store(fps.mapInPandas(routed, "fp long, shard long, home boolean"), fresh_folder(spark, "fp-shards"))
    sizes = places.groupBy("shard").agg(
        F.greatest(F.lit(1), F.ceil(F.count_if("home") / SHARD)).alias("blocks"),
        F.ceil(F.count(F.lit(1)) / ASKED).alias("asks"),
    )
    # A cell is a block of home fingerprints and a part of those that ask it. A home fingerprint is in all cells of
    # its block, and asks the blocks before; a query asks all blocks.
    zero = F.lit(0).cast("long")
    own, part = F.pmod(F.xxhash64("fp"), F.col("blocks")), F.pmod(F.xxhash64("fp", F.lit(1)), F.col("asks"))
    at_home = F.when(F.col("home"), F.sequence(zero, F.col("asks") - 1))
    others = F.when(~F.col("home"), F.sequence(zero, F.col("blocks") - 1)).when(own > 0, F.sequence(zero, own - 1))
    none = F.array().cast("array<long>")
    cell = lambda block, ask, home: F.struct(
        block.alias("block"), ask.alias("ask"), F.lit(home).alias("inside")
    )
    cells = F.concat(
        F.transform(F.coalesce(at_home, none), lambda k: cell(own, k, True)),
        F.transform(F.coalesce(others, none), lambda k: cell(k, part, False)),
    )
    blocks = places.join(sizes, "shard").select("fp", "shard", F.explode(cells).alias("cell"))
    blocks = blocks.select("fp", "shard", "cell.block", "cell.ask", "cell.inside")

    def searched(group):
        import numpy as np
        import pandas as pd

        values = group["fp"].to_numpy()
        a, b = forest(values.view(np.uint64), group["inside"].to_numpy(), max_bits)
        return pd.DataFrame({"a": values[a], "b": values[b]})

    # dealt by cell: rows already dealt by shard would do for the grouping, and put a shard's cells into one task; the
    # number is set, because small cells are joined by their bytes, but cost by their pairs
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    cell = ["shard", "block", "ask"]
    return blocks.repartition(tasks, *cell).groupBy(*cell).applyInPandas(searched, "a long, b long")


def near_copies(docs: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS) -> DataFrame:
    """doc_id, text_hash, fp, component (a fingerprint) and component_id (its least doc_id) of every row."""
    spark = docs.sparkSession
    rows = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), fingerprint(F.col("text"), shingle).alias("fp"))
    rows = store(rows, fresh_folder(spark, "fingerprints"))
    classes = store(rows.groupBy("fp").agg(F.min("doc_id").alias("first")), fresh_folder(spark, "fp-classes"))
    joined = components(near_links(classes.select("fp"), max_bits)).select(F.col("node").alias("fp"), "component")
    wide = classes.join(joined, "fp", "left").withColumn("component", F.coalesce("component", "fp"))
    wide = store(wide, fresh_folder(spark, "fp-components"))
    named = wide.groupBy("component").agg(F.min("first").alias("component_id"))
    # written, so that the join below can split a fingerprint that many rows share
    named = store(wide.join(named, "component").select("fp", "component", "component_id"), fresh_folder(spark, "fp-named"))
    return rows.join(named, "fp")


def one_of_each(docs: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS) -> DataFrame:
    """The rows of ``docs`` without near copies: of each component the row with the least doc_id stays.

    Of several rows with this id the one with the least hash of its text stays, and one of equal rows.
    """
    spark = docs.sparkSession
    found = near_copies(docs, shingle, max_bits)
    absent = F.col("doc_id").isNull()
    least = F.min(F.struct(absent.alias("absent"), "doc_id", "text_hash"))
    winners = found.groupBy("component").agg(least.alias("w")).select("w.*")
    winners = store(winners, fresh_folder(spark, "fp-winners"))
    name = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("")).alias("id")
    rows = docs.select(F.struct("*").alias("doc")).select(
        "doc", F.col("doc.doc_id").isNull().alias("absent"), name("doc.doc_id"), F.xxhash64("doc.text").alias("text_hash")
    )
    kept = winners.select("absent", name("doc_id"), "text_hash")
    order = Window.partitionBy("absent", "id", "text_hash").orderBy("absent")
    once = rows.join(kept, ["absent", "id", "text_hash"]).withColumn("copy", F.row_number().over(order))
    return once.where("copy = 1").select("doc.*")
