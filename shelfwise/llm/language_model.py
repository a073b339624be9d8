"""Interpolated modified Kneser-Ney n-gram model, counted in Spark and memory-mapped by the tasks.

Words are counted first, dealt out by the leading bits of their 64-bit hashes and numbered, frequent ones low, by their
rank and their bucket. Then tasks count the n-grams of a few million tokens as word numbers, sort them and deal them
out by the leading bits of the hash of all numbers; the groups of a bucket are merged, the counts written as one sorted
array per bucket, and the next lower order's continuation counts and the totals of the contexts handed on as partial
counts. Sorted numbers take some 4 bytes an n-gram when compressed. N-grams that begin with a begin mark count
continuations below the highest order, as all others do. A frequent word or n-gram is one entry per task, so no bucket
is hot, and buckets grow in number with the text, not in size. Tasks map the arrays and look up sorted keys; the model
never passes the driver, which holds the discounts and a few totals.

Cases: a null or empty text is its end token alone; a null doc_id counts as an empty one; repeated rows count and
are scored each; tokens with equal counts need no order; without training text every word is unknown and all orders fall back to the uniform distribution; an
empty table gives no rows; texts of any length are read whole; further columns do not matter.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import islice
from typing import Any

from pyspark.sql import Column, DataFrame, functions as F

from shelfwise.llm import hash_arrays
from shelfwise.session import fresh_folder

# Words of the longest n-grams.
ORDER = 3
# Tokens counted before they are dealt out, and scored at a time.
COUNTED, SCORED = 1_000_000, 500_000
# Training bytes for which one more bucket is taken.
BUCKET_BYTES = 12 << 20
SEED = 0
# No word holds white space.
END, BEGIN = b"\n", b"\n\n"
# Numbers of the begin mark and of words that are not in the training text; those of other words follow.
BEGIN_NUMBER, UNKNOWN, FIRST = 0, 1, 2
# Discounts where too few n-grams are seen once to four times to estimate them.
DEFAULT_DISCOUNTS = (0.5, 1.0, 1.5)

_DEALT = "level string, bucket int, data binary"
_NAMES = ["level", "bucket", "data"]


def _digest(word: bytes):
    import numpy as np
    from xxhash import xxh64_digest

    return np.frombuffer(xxh64_digest(word, SEED), dtype=np.uint64)[0]


def hashes(words: list[bytes]):
    from itertools import repeat

    import numpy as np
    from xxhash import xxh64_digest

    return np.frombuffer(b"".join(map(xxh64_digest, words, repeat(SEED))), dtype=np.uint64)


def token_hashes(text: str, order: int):
    """Hashes of begin marks, words and the end of a text."""
    # A-Z, and the six ASCII spaces, alone
    return hashes([*[BEGIN] * (order - 1), *text.encode().lower().split(), END])


def chained(context, word):
    """Hash of an n-gram from the hash of its first words and its last word."""
    import numpy as np

    mixed = (context ^ (context >> np.uint64(32))) * np.uint64(0x9E3779B97F4A7C15)
    mixed = (mixed ^ (mixed >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9) + word
    return (mixed ^ (mixed >> np.uint64(32))) * np.uint64(0x94D049BB133111EB)


def whole(columns):
    """Hash of the n-grams whose word numbers are the columns."""
    import numpy as np

    found = np.zeros(len(columns[0]), dtype=np.uint64)
    for word in columns:
        found = chained(found, word.astype(np.uint64))
    return found


def summed(keys, *values):
    """Distinct keys in order, a place of each, and the sums of each value over equal keys."""
    import numpy as np

    order = np.argsort(keys)
    ordered = keys[order]
    starts = np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1]])) if len(keys) else order
    return ordered[starts], order[starts], [np.add.reduceat(v[order], starts, dtype=np.int64) if len(keys) else v for v in values]


def joint(columns: list, base: int):
    """One number per row of columns below ``base``, in the order of the rows."""
    import numpy as np

    found, most = columns[0].astype(np.uint64), base
    for column in columns[1:]:
        if most * base >= 1 << 64:
            distinct, back = np.unique(found, return_inverse=True)
            found, most = back.astype(np.uint64), len(distinct)
        found, most = found * np.uint64(base) + column.astype(np.uint64), most * base
    return found


def distinct_rows(columns: list, base: int) -> tuple[list, Any]:
    """Distinct rows of columns below ``base``, in order, and how often each occurs."""
    import numpy as np

    key = joint(columns, base)
    if base ** len(columns) >= 1 << 64:
        _, first, n = np.unique(key, return_index=True, return_counts=True)
        return [c[first] for c in columns], n
    key, n = np.unique(key, return_counts=True)
    found = []
    for _ in columns:
        rest = key // np.uint64(base)
        found.append((key - rest * np.uint64(base)).astype(np.uint32 if base <= 1 << 32 else np.uint64))
        key = rest
    return found[::-1], n


def steps(ascending):
    """Differences of neighbours, the first from 0."""
    import numpy as np

    return np.diff(ascending, prepend=ascending.dtype.type(0))


def packed(columns: list) -> bytes:
    """Columns of unsigned numbers, equal bytes of a column's numbers together, compressed."""
    import numpy as np
    import zstandard

    heads, parts = [len(columns)], []
    for column in columns:
        width = hash_arrays.width(column)
        heads += [len(column), width]
        parts.append(np.ascontiguousarray(column.astype(f"<u{width}")).view(np.uint8).reshape(-1, width).T.tobytes())
    return zstandard.ZstdCompressor(level=1).compress(np.array(heads, dtype="<i8").tobytes() + b"".join(parts))


def unpacked(data: bytes) -> list:
    import numpy as np
    import zstandard

    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), dtype=np.uint8)
    n = int(raw[:8].view("<i8")[0])
    found, start = [], 8 + 16 * n
    for size, width in raw[8:start].view("<i8").reshape(n, 2).tolist():
        planes = raw[start : start + size * width].reshape(width, size)
        found.append(np.ascontiguousarray(planes.T).view(f"<u{width}").reshape(-1))
        start += size * width
    return found


def deal(level: str, bits: int, key, columns: list, counts: list) -> Iterator[tuple]:
    """Rows (level, bucket, data) of entries whose hash is ``key``; the first column ascends."""
    import numpy as np

    buckets = hash_arrays.bucket_of(key, bits)
    order = np.argsort(buckets.astype(np.uint16) if bits <= 16 else buckets, kind="stable")
    found, starts = np.unique(buckets[order], return_index=True)
    for bucket, lo, hi in zip(found.tolist(), starts, np.append(starts, len(key))[1:], strict=True):
        rows = order[lo:hi]
        first, *others = columns
        yield level, bucket, packed([steps(first[rows]), *[c[rows] for c in (*others, *counts)]])


def dealt(data: bytes, size: int) -> tuple[list, list]:
    """The columns, of which there are ``size``, and the counts of a row."""
    import numpy as np

    first, *others = unpacked(data)
    first = np.cumsum(first, dtype=np.uint64)
    if len(first) and first[-1] < 1 << 32:
        first = first.astype(np.uint32)
    return [first, *others[: size - 1]], others[size - 1 :]


def streams(texts: Iterator[list[str]], order: int) -> Iterator:
    """Hashes of a few million tokens at a time; a text is not cut."""
    import numpy as np

    parts: list = []
    held = 0
    for batch in texts:
        for text in batch:
            parts.append(token_hashes(text, order))
            held += len(parts[-1])
            if held >= COUNTED:
                stream, parts, held = np.concatenate(parts), [], 0
                yield stream
    if parts:
        yield np.concatenate(parts)


def count_words(texts: Iterator[list[str]], bits: int) -> Iterator[tuple]:
    """Dealt rows of the tokens of a task's texts."""
    import numpy as np

    key, n = np.zeros(0, dtype=np.uint64), np.zeros(0, dtype=np.int64)
    for stream in streams(texts, 1):
        more, found = np.unique(stream, return_counts=True)
        key, _, (n,) = summed(np.concatenate([key, more]), np.concatenate([n, found]))
        if len(key) >= COUNTED:
            yield from deal("tokens", bits, key, [key], [n])
            key, n = key[:0], n[:0]
    if len(key):
        yield from deal("tokens", bits, key, [key], [n])


def merge_words(bucket: int, data: list[bytes], folder: str, bits: int) -> Iterator[tuple]:
    """Write the bucket's words with counts and numbers."""
    import numpy as np

    found = [dealt(x, 1) for x in data]
    key, _, (n,) = summed(np.concatenate([c.astype(np.uint64) for (c,), _ in found]), np.concatenate([n for _, (n,) in found]))
    number = np.empty(len(n), dtype=np.int64)
    number[np.lexsort((key, -n))] = FIRST + (np.arange(len(n)) << bits | bucket)
    hash_arrays.write(f"{folder}/tokens", bucket, bits, key, [n, number])
    yield "stats-tokens", bucket, _stats(n)


def _stats(n) -> bytes:
    """How many there are, their sum, and how many are 1, 2, 3 and 4."""
    import numpy as np

    return np.array([len(n), n.sum(), *[(n == k).sum() for k in (1, 2, 3, 4)]], dtype="<i8").tobytes()


class Words:
    """Counts and numbers of words by their hashes."""

    def __init__(self, folder: str, bits: int) -> None:
        self.arrays = hash_arrays.Arrays(f"{folder}/tokens", bits, 2)

    def find(self, keys) -> tuple:
        import numpy as np

        n, number = self.arrays.find(keys)
        number = np.where(n > 0, number, UNKNOWN)
        return n, np.where(keys == _digest(BEGIN), BEGIN_NUMBER, number)


def count(texts: Iterator[list[str]], order: int, bits: int, words: Words) -> Iterator[tuple]:
    """Dealt rows of the n-grams of the highest order of a task's texts."""
    import numpy as np

    for stream in streams(texts, order):
        at = np.flatnonzero(stream != _digest(BEGIN))
        distinct, places = np.unique(stream, return_inverse=True)
        _, numbers = words.find(distinct)
        # places in the order of the numbers
        by_number = np.argsort(numbers)
        rank = np.empty(len(by_number), dtype=np.uint32)
        rank[by_number] = np.arange(len(by_number))
        places, numbers = rank[places], numbers[by_number]
        columns = [places[at - order + 1 + k] for k in range(order)]
        del stream, at, distinct, places
        columns, n = distinct_rows(columns, len(numbers))
        columns = [numbers[c] for c in columns]
        yield from deal(f"g{order}", bits, whole(columns), columns, [n])


def merge(level: str, bucket: int, data: list[bytes], folder: str, bits: int, order: int) -> Iterator[tuple]:
    """Write the bucket's array; hand on the lower order and the contexts.

    Below the highest order an n-gram has its own count and, as a context, the total of what follows it and how
    many follow once, twice and more often. A row has the one or the four.
    """
    import numpy as np

    size = int(level[1:])
    found = [dealt(x, size) for x in data]
    columns = [np.concatenate(c) for c in zip(*[numbers for numbers, _ in found], strict=True)]
    sums = np.zeros((1 if size == order else 5, len(columns[0])), dtype=np.int64)
    start = 0
    for numbers, counts in found:
        stop = start + len(numbers[0])
        sums[slice(1) if len(counts) == 1 else slice(1, 5), start:stop] = counts
        start = stop
    del found
    key, first, sums = summed(whole(columns), *sums)
    hash_arrays.write(f"{folder}/{level}", bucket, bits, key, sums)
    # the rest are contexts alone, which hold begin marks
    own = np.flatnonzero(sums[0])
    n, columns = sums[0][own], [c[first[own]] for c in columns]
    yield f"stats-{level}", bucket, _stats(n)
    if size > 1 and len(n):
        base = int(max(c.max() for c in columns)) + 1
        # each distinct n-gram is one continuation of its last words
        lower, distinct = distinct_rows(columns[1:], base)
        yield from deal(f"g{size - 1}", bits, whole(lower), lower, [distinct])
        _, at, totals = summed(joint(columns[:-1], base), n, n == 1, n == 2, n > 2)
        context = [c[at] for c in columns[:-1]]
        yield from deal(f"g{size - 1}", bits, whole(context), context, totals)


@dataclass(frozen=True)
class Model:
    """Where the arrays are and what holds for the whole corpus.

    ``discounts[k]`` are those of order k; ``vocabulary`` and ``tokens`` count training tokens.
    """

    folder: str
    order: int
    bits: int
    discounts: dict[int, tuple[float, float, float]]
    unigrams: tuple[int, int, int, int]
    vocabulary: int
    tokens: int


def discounts(n: tuple[int, int, int, int]) -> tuple[float, float, float]:
    """From the numbers of n-grams seen once to four times."""
    if not all(n):
        return DEFAULT_DISCOUNTS
    y = n[0] / (n[0] + 2 * n[1])
    found = [k + 1 - (k + 2) * y * n[k + 1] / n[k] for k in range(3)]
    return tuple(min(max(d, 0.0), k + 1.0) for k, d in enumerate(found))


def train(texts: DataFrame, order: int = ORDER) -> Model:
    """``texts`` has a column ``text``."""
    spark = texts.sparkSession
    folder = fresh_folder(spark, "ngrams")
    size = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    bits = (size // BUCKET_BYTES).bit_length()

    def asked(batches: Iterator) -> Iterator[list[str]]:
        return ([x or "" for x in b["text"]] for b in batches)

    def frames(rows: Iterator[tuple]) -> Iterator:
        import pandas as pd

        while some := list(islice(rows, 64)):
            yield pd.DataFrame(some, columns=_NAMES)

    def words_counted(batches: Iterator) -> Iterator:
        return frames(count_words(asked(batches), bits))

    def counted(batches: Iterator) -> Iterator:
        return frames(count(asked(batches), order, bits, Words(folder, bits)))

    def merged(group):
        import pandas as pd

        level, bucket, data = group["level"].iloc[0], int(group["bucket"].iloc[0]), list(group["data"])
        if level.startswith("stats-"):
            return group
        rows = merge_words(bucket, data, folder, bits) if level == "tokens" else merge(level, bucket, data, folder, bits, order)
        return pd.DataFrame(list(rows), columns=_NAMES)

    def by_bucket(rows: DataFrame) -> DataFrame:
        return rows.repartition(2 << bits, "level", "bucket").groupBy("level", "bucket").applyInPandas(merged, _DEALT)

    stats = _totals(by_bucket(texts.select("text").mapInPandas(words_counted, _DEALT)))
    grams = texts.select("text").mapInPandas(counted, _DEALT)
    for _ in range(order):
        # one order after the other in one job: what is handed on is written once, by the shuffle
        grams = by_bucket(grams)
    stats |= _totals(grams)
    zero = [0] * 6
    top = {k: stats.get(f"stats-g{k}", zero) for k in range(1, order + 1)}
    tokens = stats.get("stats-tokens", zero)
    first = top[1]
    return Model(
        folder,
        order,
        bits,
        {k: discounts(tuple(x[2:6])) for k, x in top.items()},
        (first[1], first[2], first[3], first[0] - first[2] - first[3]),
        tokens[0],
        tokens[1],
    )


def _totals(rows: DataFrame) -> dict[str, list[int]]:
    """Sums over the buckets of each level; one row per level comes to the driver."""
    @F.pandas_udf("array<long>")
    def numbers(data):
        import numpy as np

        return data.map(lambda x: np.frombuffer(x, dtype="<i8"))

    found = rows.select("level", numbers("data").alias("n"))
    sums = found.groupBy("level").agg(*[F.sum(F.get("n", F.lit(i))).alias(f"n{i}") for i in range(6)])
    return {row["level"]: list(row[1:]) for row in sums.collect()}


class Scorer:
    """log10 probabilities with the arrays of a model."""

    def __init__(self, model: Model) -> None:
        self.model = model
        self.words = Words(model.folder, model.bits)
        self.grams = {
            k: hash_arrays.Arrays(f"{model.folder}/g{k}", model.bits, 1 if k == model.order else 5)
            for k in range(1, model.order + 1)
        }

    def probabilities(self, stream):
        """(places of the tokens, how often each is in training, its probability) of a stream with begin marks."""
        import numpy as np

        model = self.model
        at = np.flatnonzero(stream != _digest(BEGIN))
        # words and their n-grams are looked up once
        distinct, back = np.unique(stream, return_inverse=True)
        known, numbers = self.words.find(distinct)
        single = self.grams[1].find(whole([numbers]))
        known, numbers = known[back[at]], numbers[back]
        # the empty context: all continuations
        total, once, twice, more = model.unigrams
        d = model.discounts[1]
        rest = 1.0 if not total else (d[0] * once + d[1] * twice + d[2] * more) / total
        p = self._discounted(single[0][back[at]], d) / max(total, 1) + rest / (model.vocabulary + 1)
        for k in range(2, model.order + 1):
            # n-grams of k - 1 words that end just before each token are its context
            total, once, twice, more = (single[1:, back] if k == 2 else found[1:])[:, at - 1]
            d = model.discounts[k]
            found = self._ending(k, numbers)
            share = self._discounted(found[0][at], d)
            share = (share + (d[0] * once + d[1] * twice + d[2] * more) * p) / np.maximum(total, 1)
            p = np.where(total > 0, share, p)
        return at, known, p

    def _ending(self, k: int, numbers):
        """Numbers of the n-grams of k words that end at each place, which for the first places begin before it."""
        import numpy as np

        key = whole([numbers if i == 0 else np.roll(numbers, i) for i in reversed(range(k))])
        return self.grams[k].find(key)

    @staticmethod
    def _discounted(n, d):
        import numpy as np

        return np.maximum(n - np.array([0.0, *d])[np.minimum(n, 3).astype(int)], 0.0)

    def scores(self, texts: list[str]):
        """n_tokens, n_known, base_score, score of each text."""
        import numpy as np

        model = self.model
        streams = [token_hashes(text, model.order) for text in texts]
        sizes = np.array([len(x) - model.order + 1 for x in streams])
        starts = np.cumsum(sizes) - sizes
        at, known, p = self.probabilities(np.concatenate(streams))
        base = np.log10((known + 0.5) / (model.tokens + 0.5 * (model.vocabulary + 1)))
        return [sizes, *[np.add.reduceat(x, starts) for x in ((known > 0).astype(np.int64), base, np.log10(p))]]


_scorers: dict[str, Scorer] = {}


def score(text: Column, model: Model) -> Column:
    """Struct of n_tokens, n_known, base_score and score of a text column."""

    @F.pandas_udf("n_tokens long, n_known long, base_score double, score double")
    def scored(texts):
        import pandas as pd

        if model.folder not in _scorers:
            _scorers.clear()
            _scorers[model.folder] = Scorer(model)
        texts, found = [x or "" for x in texts], []
        while texts:
            # a slice of about so many tokens, one text at least
            size = stop = 0
            while stop < len(texts) and size < SCORED:
                size += len(texts[stop]) // 6 + 1
                stop += 1
            found.append(_scorers[model.folder].scores(texts[:stop]))
            texts = texts[stop:]
        names = ["n_tokens", "n_known", "base_score", "score"]
        parts = [pd.DataFrame(dict(zip(names, x, strict=True))) for x in found]
        return pd.concat(parts, ignore_index=True) if parts else pd.DataFrame(columns=names)

    return scored(text)


def held_out() -> Column:
    """Documents that the model does not learn from: those whose id's CRC-32 leaves 1 when divided by 5."""
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))) % 5 == 1


def scored_documents(docs: DataFrame, order: int = ORDER) -> DataFrame:
    """Train on the documents that are not held out and score all: the rows as ``doc``, ``held_out`` and ``lm``."""
    model = train(docs.where(~held_out()), order)
    rows = docs.select(F.struct("*").alias("doc"), held_out().alias("held_out"), "text")
    return rows.select(
        "doc", "held_out", F.lit(model.tokens).cast("long").alias("train_tokens"), score(F.col("text"), model).alias("lm")
    )
