"""What each filter removes in every order of the filters, from decision diagrams of failure masks.

A document's mask has a bit per filter, set if it fails. Per part (language) the masks are counted, and the counts
become a decision diagram: a level per filter, an edge for passing and one for failing, weights at its ends, equal
sub-diagrams held once. A diagram has at most two to the number of filters ends, however many documents there are.
Swapping two neighbouring levels gives the diagram of another order, and a walk that swaps neighbours only visits all
orders. In each, the path on which everything passes yields the steps: what the fail edge of a node on it weighs is
removed there, what the pass edge weighs is kept.

Cases: a null text is empty, so all null and empty texts are identical; a null doc_id is neither smaller nor larger
than another, so its row is never a later copy, and has no labels; of rows with the smallest doc_id of a text (a
repeated row) none is a later copy; a null language is the part of the empty string; very long texts are read whole;
several labels of a document count if any of them says so; an empty table gives no rows; further columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from shelfwise.session import fresh_folder, store

FILTERS = "ABCDE"
LEAST_WORDS, LEAST_DISTINCT, MOST_CAPITALS = 200, 50, 3
SIGNS, CAPITALS = b"#$%&*|", bytes(range(65, 91))
STEP = (
    "part string, filter_order string, step int, kept long, removed long, redundant long, unique_fails long, "
    "good_lost long, toxic_lost long, shapley long"
)

Weight = tuple[int, ...]
Node = tuple  # (pass, fail) of two nodes, or of two weights on the lowest level


def text_mask(text: Column) -> Column:
    """Bits of the filters that look at one text: few words, few distinct words, capitals, signs."""

    @F.arrow_udf("int")
    def failed(texts: pa.Array) -> pa.Array:
        import pyarrow.compute as pc

        masks = []
        points = pc.utf8_length(texts).to_pylist()
        for held, length in zip(texts.cast(pa.binary()).to_pylist(), points, strict=True):
            words = held.split()  # of bytes: between blanks and the control characters 9 to 13
            fails = (
                len(words) < LEAST_WORDS,
                100 * len(set(words)) < LEAST_DISTINCT * len(words),
                100 * (len(held) - len(held.translate(None, CAPITALS))) > MOST_CAPITALS * length,
                len(held) > len(held.translate(None, SIGNS)),
            )
            masks.append(sum(1 << i for i, x in enumerate(fails) if x))
        return pa.array(masks, type=pa.int32())

    return failed(F.coalesce(text, F.lit("")))


def failure_masks(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """part, mask, n, good, toxic: counted masks; the highest bit is that of later copies of a text.

    Texts travel as digests. Rows are counted per document first and per text and part then, so that many copies
    of a text are few rows when the smallest doc_id of the text is looked for.
    """
    rows = docs.select(
        "doc_id",
        F.coalesce("lang", F.lit("")).alias("part"),
        F.unhex(F.sha2(F.coalesce("text", F.lit("")), 256)).alias("digest"),
        text_mask(F.col("text")).alias("mask"),
    )
    rows = rows.groupBy("doc_id", "part", "digest", "mask").agg(F.count(F.lit(1)).alias("n"))
    marks = labels.where("doc_id IS NOT NULL").groupBy("doc_id").agg(
        F.coalesce(F.max(F.col("quality") == 1), F.lit(False)).alias("is_good"),
        F.coalesce(F.max(F.col("toxic") == 1), F.lit(False)).alias("is_toxic"),
    )
    # rows without doc_id match no label; their digest spreads them over tasks
    spread = F.when(F.col("doc_id").isNull(), F.xxhash64("digest")).otherwise(F.lit(0))
    rows = rows.withColumn("spread", spread).join(marks.withColumn("spread", F.lit(0).cast("long")), ["doc_id", "spread"], "left")
    rows = rows.select(
        "doc_id", "part", "digest", "mask", "n",
        F.coalesce("is_good", F.lit(False)).alias("is_good"), F.coalesce("is_toxic", F.lit(False)).alias("is_toxic"),
    )
    counted = rows.groupBy("digest", "part", "mask", "is_good", "is_toxic").agg(
        F.sum("n").alias("n"),
        F.min("doc_id").alias("first"),
        F.sum(F.when(F.col("doc_id").isNull(), F.col("n")).otherwise(0)).alias("unnamed"),
        F.coalesce(F.min_by("n", "doc_id"), F.lit(0)).alias("n_first"),
    )
    # read twice below
    counted = store(counted, fresh_folder(docs.sparkSession, "audit-texts"))
    least = counted.groupBy("digest").agg(F.min("first").alias("least"))
    both = counted.join(least, "digest")
    originals = F.col("unnamed") + F.when(F.col("first") == F.col("least"), F.col("n_first")).otherwise(0)
    copy = 1 << (len(FILTERS) - 1)
    split = F.explode(
        F.array(
            F.struct(F.col("mask").alias("mask"), originals.alias("n")),
            F.struct((F.col("mask") + copy).alias("mask"), (F.col("n") - originals).alias("n")),
        )
    )
    number = lambda flag: F.sum(F.when(F.col(flag), F.col("split.n")).otherwise(0))
    return (
        both.select("part", "is_good", "is_toxic", split.alias("split"))
        .groupBy("part", "split.mask")
        .agg(F.sum("split.n").alias("n"), number("is_good").alias("good"), number("is_toxic").alias("toxic"))
    )


class Diagram:
    """A diagram of weights with a level per filter; no level is ever skipped."""

    def __init__(self, order: str, weights: dict[int, Weight], width: int) -> None:
        self.order, self.width = order, width
        self._nodes: dict[Node, Node] = {}
        self._weight: dict[Node, Weight] = {}
        none = (0,) * width
        level = [weights.get(mask, none) for mask in range(1 << len(order))]
        # bit i of a mask belongs to letter i; the last letter is the lowest level
        for _ in order:
            half = len(level) // 2
            level = [self._node(level[i], level[i + half]) for i in range(half)]
        self.root = level[0]

    def _node(self, passed, failed) -> Node:
        node = (passed, failed)
        return self._nodes.setdefault(node, node)

    def weight(self, node, depth: int) -> Weight:
        """Of all documents below a node ``depth`` levels above the weights."""
        if not depth:
            return node
        key = (depth, node)
        if key not in self._weight:
            halves = [self.weight(x, depth - 1) for x in node]
            self._weight[key] = tuple(map(sum, zip(*halves, strict=True)))
        return self._weight[key]

    def swap(self, upper: int) -> None:
        """Exchange the levels ``upper`` and ``upper`` + 1, counted from the top."""
        done: dict[Node, Node] = {}

        def swapped(node: Node, level: int) -> Node:
            if node not in done:
                if level == upper:
                    (a, b), (c, d) = node
                    done[node] = self._node(self._node(a, c), self._node(b, d))
                else:
                    done[node] = self._node(swapped(node[0], level + 1), swapped(node[1], level + 1))
            return done[node]

        self.root = swapped(self.root, 0)
        x = self.order
        self.order = x[:upper] + x[upper + 1] + x[upper] + x[upper + 2 :]

    def steps(self) -> Iterator[tuple[str, Weight, Weight]]:
        """Along the path on which everything passes: filter, weight kept, weight removed."""
        node, depth = self.root, len(self.order)
        for letter in self.order:
            depth -= 1
            yield letter, self.weight(node[0], depth), self.weight(node[1], depth)
            node = node[0]


def neighbour_swaps(n: int) -> Iterator[int]:
    """Places whose swap with the next one leads through all orders of n things."""
    if n < 2:
        return
    inner, down = neighbour_swaps(n - 1), True
    while True:
        # the last thing wanders through all places, then the others take a step
        yield from range(n - 2, -1, -1) if down else range(n - 1)
        step = next(inner, None)
        if step is None:
            return
        yield step + 1 if down else step
        down = not down


def all_steps(filters: str, weights: dict[int, Weight], width: int) -> list[tuple]:
    """(order, step, kept, removed, redundant, unique, other removed weights, removed over all orders)."""
    diagram = Diagram(filters, weights, width)
    walks = [(diagram.order, list(diagram.steps()))]
    for place in neighbour_swaps(len(filters)):
        diagram.swap(place)
        walks.append((diagram.order, list(diagram.steps())))
    failing, alone, shares = {}, {}, dict.fromkeys(filters, 0)
    for _, walk in walks:
        failing[walk[0][0]] = walk[0][2][0]  # nothing went before
        alone[walk[-1][0]] = walk[-1][2][0]  # everything else passed
        for letter, _, removed in walk:
            shares[letter] += removed[0]
    return [
        (order, i, kept[0], gone[0], failing[x] - gone[0], alone[x], *gone[1:], shares[x])
        for order, walk in walks
        for i, (x, kept, gone) in enumerate(walk, 1)
    ]


def audit(masks: DataFrame, filters: str = FILTERS) -> DataFrame:
    """One row per part, order of the filters and step. A part has a row per mask at most."""

    def steps_of(key: tuple, rows: pa.Table) -> pa.Table:
        found = {r["mask"]: (r["n"], r["good"], r["toxic"]) for r in rows.to_pylist()}
        steps = all_steps(filters, found, 3)
        columns = [[key[0].as_py()] * len(steps), *map(list, zip(*steps, strict=True))]
        return pa.table(columns, schema=pa.schema([
            pa.field(name, pa.string() if i < 2 else pa.int32() if i == 2 else pa.int64())
            for i, name in enumerate(c.split()[0] for c in STEP.split(", "))
        ]))

    return masks.groupBy("part").applyInArrow(steps_of, STEP)
