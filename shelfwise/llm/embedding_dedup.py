"""Near copies among vectors by Euclidean p-stable hashing and exact cosines.

Normalised vectors with cosine c are sqrt(2 - 2c) apart. A table hashes a vector by several Gaussian projections, each
cut into steps a few times that distance; vectors that share all steps of a table are compared exactly. The
number of projections grows with the logarithm of the vectors, so that chance meetings do not, and the number of
tables follows from the wanted recall of a pair that is just close enough.

Equal vectors of a label are one class and searched once. Buckets are cut into blocks, and pairs of blocks are compared
as matrices; a pair counts in the first table in which it meets, so no pair is written down.

Cases: vectors that are null, empty or zero, or hold null or non-finite numbers, and rows without a label, link with
nothing; vectors of unlike length never link; a null vec_id links like any other and counts for a component only if it
has no other id; repeated rows are each other's copies; an empty table gives no rows; further columns do not matter.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

from pyspark.sql import DataFrame, functions as F

from shelfwise.llm.components import components
from shelfwise.session import fresh_folder, store

MIN_COSINE = 0.98
# Of pairs exactly at the limit; closer pairs are found more surely.
RECALL = 0.998
# Width of a step in distances of a pair at the limit.
STEP = 8.0
# Distance of vectors that have little to do with each other (cosine 0.28), and how often a vector may
# meet one of them in a table: they set the number of projections.
APART, CHANCE = 1.2, 0.1
SEED = 20_240_201
# Vectors of a block.
BLOCK = 2048


def collision(ratio: float) -> float:
    """Probability that a projection puts two vectors into one step, ``ratio`` = step over distance."""
    below = 0.5 * math.erfc(ratio / math.sqrt(2.0))
    return 1 - 2 * below - 2 / (math.sqrt(2 * math.pi) * ratio) * (1 - math.exp(-ratio * ratio / 2))


def shape(n: int, min_cosine: float, recall: float) -> tuple[float, int, int]:
    """(step, projections of a table, tables)."""
    distance = math.sqrt(2 - 2 * min_cosine)
    step = STEP * distance
    near, far = collision(STEP), collision(step / APART)
    projections = max(2, math.ceil(math.log(max(n, 2) / CHANCE) / -math.log(far)))
    tables = math.ceil(math.log(1 - recall) / math.log(1 - near**projections))
    return step, projections, tables


def scaled(vectors):
    """Rows of a matrix with their largest number between a half and one, so that squares neither vanish nor overflow.

    The factor is a power of two, so the cosines of other rows stay as they are to the last bit.
    """
    import numpy as np

    _, exponent = np.frexp(np.abs(vectors).max(axis=1))
    return np.ldexp(vectors, -exponent[:, None])


def classes_of(rows: DataFrame) -> DataFrame:
    """vec_id, digest, vector of each row; the digest of label and numbers names a class, null for none."""

    def digested(batches: Iterator) -> Iterator:
        import hashlib

        import numpy as np
        import pandas as pd

        for batch in batches:
            names, vectors = [], []
            for label, values in zip(batch["label"], batch["embedding"], strict=True):
                name = vector = None
                if label is not None and values is not None and len(values):
                    numbers = np.array([np.nan if v is None else v for v in values], dtype=np.float64) + 0.0
                    if np.isfinite(numbers).all() and numbers.any():
                        vector = numbers
                        name = hashlib.blake2b(numbers.tobytes(), digest_size=16, salt=b"").digest()
                        name += str(label).encode()
                names.append(name)
                vectors.append(vector)
            yield pd.DataFrame({"vec_id": batch["vec_id"], "digest": names, "vector": vectors})

    id_type = rows.schema["vec_id"].dataType.simpleString()
    picked = rows.select("vec_id", F.col("label").cast("string").alias("label"), "embedding")
    return picked.mapInPandas(digested, f"vec_id {id_type}, digest binary, vector array<double>")


def near_classes(classes: DataFrame, n: int, min_cosine: float, recall: float) -> DataFrame:
    """Classes (number, label, copies, vector) -> (number, links, least): vectors of other classes it links with, and a
    class number it is joined to; several rows per class."""
    spark = classes.sparkSession
    step, projections, tables = shape(n, min_cosine, recall)

    def hashed(batches: Iterator) -> Iterator:
        import numpy as np
        import pandas as pd

        planes: dict[int, tuple] = {}
        for batch in batches:
            sizes = batch["vector"].map(len).to_numpy()
            for size in np.unique(sizes):
                part = batch[sizes == size]
                if size not in planes:
                    random = np.random.default_rng([SEED, int(size)])
                    planes[size] = (
                        random.standard_normal((int(size), projections * tables)),
                        random.uniform(0, step, projections * tables),
                        random.integers(1, 1 << 62, projections) * 2 + 1,
                    )
                axes, shift, odd = planes[size]
                vectors = np.stack(part["vector"].to_numpy())
                unit = scaled(vectors)
                unit /= np.sqrt((unit * unit).sum(axis=1, keepdims=True))
                steps = np.floor((unit @ axes + shift) / step).astype(np.int64).reshape(-1, tables, projections)
                keys = (steps * odd).sum(axis=2)
                yield part[["number", "label", "copies", "vector"]].assign(keys=list(keys))

    schema = "number long, label string, copies long, vector array<double>, keys array<long>"
    hashed_classes = store(classes.mapInPandas(hashed, schema), fresh_folder(spark, "vector-keys"))
    # a bucket is a label, a length, a table and its key
    slots = hashed_classes.select("number", "label", F.size("vector").alias("length"), F.posexplode("keys").alias("nth", "key"))
    bucket = F.xxhash64("label", "length", "nth", "key")
    slots = slots.select("number", "nth", bucket.alias("bucket"))
    full = slots.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    full = store(full, fresh_folder(spark, "vector-buckets"))
    # block i meets all blocks j: the pair (i, j) is named by the smaller first
    blocks = F.ceil(F.col("n") / BLOCK)
    own = F.pmod(F.xxhash64("number"), blocks)
    met = F.transform(
        F.sequence(F.lit(0).cast("long"), blocks - 1),
        lambda j: F.struct(F.least(own, j).alias("i"), F.greatest(own, j).alias("j"), own.alias("own")),
    )
    cells = slots.join(full, "bucket").select("number", "nth", "bucket", F.explode(met).alias("cell"))
    cells = cells.select("number", "nth", "bucket", "cell.*")
    members = cells.join(hashed_classes, "number")

    def compared(group):
        import numpy as np
        import pandas as pd

        from shelfwise.llm.simhash import least_labels

        group = group.sort_values("number", ignore_index=True)
        numbers, copies = group["number"].to_numpy(), group["copies"].to_numpy()
        labels, keys = group["label"].to_numpy(), np.stack(group["keys"].to_numpy())
        nth, first, second = (int(group[c].iloc[0]) for c in ("nth", "i", "j"))
        lengths = group["vector"].map(len).to_numpy()
        vectors = scaled(np.stack([v if len(v) == lengths[0] else np.zeros(lengths[0]) for v in group["vector"]]))
        norms = np.sqrt((vectors * vectors).sum(axis=1))
        left, right = (np.flatnonzero(group["own"].to_numpy() == k) for k in (first, second))
        links = np.zeros(len(group), dtype=np.int64)
        found_a, found_b = [np.zeros(0, dtype=np.int64)], [np.zeros(0, dtype=np.int64)]
        for k in range(0, len(left), 512):
            rows = left[k : k + 512]
            with np.errstate(invalid="ignore", divide="ignore"):
                cosine = (vectors[rows] @ vectors[right].T) / (norms[rows][:, None] * norms[right][None, :])
            a, b = np.nonzero(cosine >= min_cosine)
            a, b = rows[a], right[b]
            # a bucket's hash may bring strangers together; and each pair once, in its first table
            good = (labels[a] == labels[b]) & (lengths[a] == lengths[b]) & (a != b)
            good &= (a < b) if first == second else True
            good[good] = keys[a[good], nth] == keys[b[good], nth]
            for table in range(nth):
                good[good] = keys[a[good], table] != keys[b[good], table]
            a, b = a[good], b[good]
            np.add.at(links, a, copies[b])
            np.add.at(links, b, copies[a])
            joined = least_labels(len(group), a, b)
            moved = np.flatnonzero(joined != np.arange(len(group)))
            found_a.append(moved)
            found_b.append(joined[moved])
        joined = least_labels(len(group), np.concatenate(found_a), np.concatenate(found_b))
        some = np.flatnonzero(links)
        return pd.DataFrame({"number": numbers[some], "links": links[some], "least": numbers[joined[some]]})

    return members.groupBy("bucket", "i", "j").applyInPandas(compared, "number long, links long, least long")


def near_vectors(rows: DataFrame, min_cosine: float = MIN_COSINE, recall: float = RECALL) -> DataFrame:
    """vec_id, n_links and component_id of every row of ``rows`` (vec_id, embedding, label)."""
    spark = rows.sparkSession
    named = store(classes_of(rows), fresh_folder(spark, "vectors"))
    classes = (
        named.where("digest is not null")
        .groupBy("digest")
        .agg(F.count(F.lit(1)).alias("copies"), F.min("vec_id").alias("first"), F.first("vector").alias("vector"))
        .select(
            "digest", "copies", "first", "vector", F.substring("digest", 17, 1 << 20).cast("string").alias("label"),
            F.xxhash64("digest").alias("number"),
        )
    )
    classes = store(classes, fresh_folder(spark, "vector-classes"))
    n = classes.count()
    found = near_classes(classes.select("number", "label", "copies", "vector"), n, min_cosine, recall)
    found = store(found, fresh_folder(spark, "vector-links"))
    counts = found.groupBy("number").agg(F.sum("links").alias("links"))
    parts = components(found.select(F.col("number").alias("a"), F.col("least").alias("b")))
    wide = (
        classes.select("digest", "copies", "first", "number")
        .join(counts, "number", "left")
        .join(parts.withColumnRenamed("node", "number"), "number", "left")
        .withColumn("component", F.coalesce("component", "number"))
    )
    wide = store(wide, fresh_folder(spark, "vector-components"))
    least = wide.groupBy("component").agg(F.min("first").alias("component_id"))
    answers = store(
        wide.join(least, "component").select(
            "digest", (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), "component_id"
        ),
        fresh_folder(spark, "vector-answers"),
    )
    linked = named.select("vec_id", "digest").join(answers, "digest", "left")
    return linked.select(
        "vec_id",
        F.coalesce("n_links", F.lit(0)).alias("n_links"),
        F.when(F.col("digest").isNull(), F.col("vec_id")).otherwise(F.col("component_id")).alias("component_id"),
    )
