"""Mixes sources to target weights by Pareto order sampling.

Sources share the words of the mix by weight; none gets more than a number of times its own words, and what
it cannot use goes to the others. A source whose target is r times its words gives floor(r) whole copies of each
document for certain. The words that are missing then come from a sample without replacement of one more copy, in which
a document's inclusion probability is in proportion to the square root of its length, up to one: long documents are a
little likelier. Documents rank by random odds over inclusion odds, u/(1-u) / (p/(1-p)), and the sample takes them
in this order until its size, in words, is reached.

A document that does not fit into what is left is passed over, and the sample goes on behind it with those that fit,
round by round, until less than ``CLOSE`` of the target is missing or nothing fits. So a long document at the end of a
sample does not keep it from its size. Where a source is large, the first round ends it.

No source is ordered as a whole. Ranks fall into bins; sums per bin show the one bin in which a round ends,
and only the documents in it are ordered. Bins grow with the square root of the documents.

Cases: a null text has size 0; a null source is a source of its own, last; rows that repeat (same doc_id, text and
source) are numbered and draw each for itself, so any number of them may be taken; size 0 is never copied; equal ranks
are one block; a very long text is a document like others; an empty table gives no rows; further columns do not matter.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from shelfwise.operators.keys import number_rows
from shelfwise.session import fresh_folder, store
from shelfwise.sources.linked import union_all

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (1.0, 2.0, 3.0)
MOST_COPIES = 3
LEAST_BINS, MOST_BINS = 256, 1 << 20
# Part of its target that a sample may miss; a round that comes nearer is the last.
CLOSE = 0.001
# Equal rows are listed from the count of their kind, so many at a time.
LISTED = 1 << 14
# Hexadecimal digits of the digest that make a draw: 52 bits, exact in a double.
_DIGITS, _DRAWS = 13, float(1 << 52)


def size(text: str = "text") -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def digest(salt: str) -> Column:
    """Names a row by doc_id and text alone, so reruns agree."""
    return F.md5(F.concat_ws("|", F.lit(salt), F.coalesce(F.col("doc_id").cast("string"), F.lit("")), "text"))


def draw(digest: Column, nth: Column) -> Column:
    """A number in (0, 1) for the nth of equal rows, from 0."""
    own = F.when(nth == 0, digest).otherwise(F.md5(F.concat_ws("|", digest, nth.cast("string"))))
    return (F.conv(F.substring(own, 1, _DIGITS), 16, 10).cast("double") + F.lit(0.5)) / F.lit(_DRAWS)


def liking(size: Column) -> Column:
    """How much a document is wanted beside others of its source: a whole number, so that sums are exact."""
    return F.floor(F.sqrt(size.cast("double")))


def targets(sources: DataFrame, weights: Sequence[float], most_copies: float) -> DataFrame:
    """source, source_size -> also ``target``: all words shared by weight, none above its limit.

    Each round fixes the sources that are above their limit and shares the rest anew; the driver holds three
    sums. Every round fixes a source or ends, and few rounds fix any.
    """
    spark = sources.sparkSession
    sources = sources.withColumn("absent", F.col("source").isNull())
    # by code point is by byte order in UTF-8, which is how Spark compares strings
    numbered = number_rows(sources, ["absent", "source"], "place", start=-1)
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("place") % len(weights) + 1).cast("int"))
    limit = F.col("source_size") * F.lit(float(most_copies))
    shared = store(
        numbered.select("source", "source_size", weight.alias("weight"), limit.alias("limit")),
        fresh_folder(spark, "mix-sources"),
    )
    total = shared.agg(F.sum("source_size")).first()[0] or 0
    level = math.inf
    fixed = F.lit(False)
    while True:
        rest, weighed = shared.agg(
            F.lit(float(total)) - F.coalesce(F.sum(F.when(fixed, F.col("limit"))), F.lit(0.0)),
            F.sum(F.when(~fixed, F.col("weight"))),
        ).first()
        if weighed is None:
            break
        level = rest / weighed
        above = fixed | (F.col("weight") * F.lit(level) >= F.col("limit"))
        if not shared.where(above & ~fixed).limit(1).count():
            break
        fixed = F.col("weight") * F.lit(level) >= F.col("limit")
    return shared.select(
        "source",
        "source_size",
        F.when(fixed, F.col("limit")).otherwise(F.col("weight") * F.lit(0.0 if math.isinf(level) else level)).alias("target"),
    )


def expected(size: Column, certain: Column, level: Column) -> Column:
    """How often a document is wanted: the certain copies of its source, and its probability of one more."""
    return F.when(size > 0, certain + F.coalesce(F.least(F.lit(1.0), level * liking(size)), F.lit(0.0))).otherwise(F.lit(0.0))


def levels(classes: DataFrame, by_source: DataFrame) -> DataFrame:
    """source, source_size, target -> also ``certain`` copies and ``level``: times the liking, up to one, it gives
    probabilities with which the words come to the target.

    Documents liked most reach one first. A source has few different likings, whatever its size.
    """
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    by_source = by_source.withColumn("certain", whole.cast("long"))
    rest_of = (F.col("target") - F.col("certain") * F.col("source_size")).alias("missing")
    liked = classes.where("size > 0").groupBy("source", liking(F.col("size")).alias("liking"))
    liked = liked.agg(F.sum(F.col("size") * F.col("n")).alias("words"))
    wide = liked.join(by_source.select(F.col("source").alias("_source"), rest_of), F.col("source").eqNullSafe(F.col("_source")))
    before = Window.partitionBy("source").orderBy(F.col("liking").desc()).rowsBetween(Window.unboundedPreceding, -1)
    onward = Window.partitionBy("source").orderBy(F.col("liking").desc()).rowsBetween(Window.currentRow, Window.unboundedFollowing)
    capped = F.coalesce(F.sum("words").over(before), F.lit(0))
    rest = F.sum(F.col("words") * F.col("liking")).over(onward)
    fits = wide.withColumn("level", (F.col("missing") - capped) / rest).where(F.col("level") * F.col("liking") < 1)
    found = fits.groupBy(F.col("source").alias("_source")).agg(F.max_by("level", "liking").alias("level"))
    return by_source.join(found, F.col("source").eqNullSafe(F.col("_source")), "left").drop("_source")


def rank(u: Column, p: Column) -> Column:
    """Random odds over inclusion odds."""
    return u / (1.0 - u) / (p / (1.0 - p))


def bin_of(rank: Column, bins: int) -> Column:
    """Samples end at a rank of about one, in the middle of the bins."""
    return F.floor(rank / (rank + 1.0) * bins)


def _listed(classes: DataFrame, repeated: bool) -> DataFrame:
    """A row per document: ``nth`` of the ``n`` equal rows of its kind."""
    if not repeated:
        return classes.withColumn("nth", F.lit(0).cast("long"))
    starts = classes.withColumn("start", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n") - 1, F.lit(LISTED).cast("long"))))
    end = F.least(F.col("n"), F.col("start") + LISTED) - 1
    # dealt out, so that one kind is not listed by one task
    return starts.repartition("digest", "start").withColumn("nth", F.explode(F.sequence("start", end))).drop("start")


def plan(classes: DataFrame, weights: Sequence[float], most_copies: float, repeated: bool) -> DataFrame:
    """One row per source: target, level, and the rounds of its sample.

    ``classes`` has digest, source, size and the number n of equal rows. A round takes the documents with a rank between
    ``low`` and ``high`` that have at most ``most`` words.
    """
    spark = classes.sparkSession
    sums = classes.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).alias("source_size"), F.sum("n").alias("n_docs"))
    sums = store(sums, fresh_folder(spark, "mix-sums"))
    n_docs = sums.agg(F.sum("n_docs")).first()[0] or 0
    bins = min(MOST_BINS, max(LEAST_BINS, 1 << math.ceil(math.log2(math.sqrt(n_docs) + 1))))
    by_source = store(targets(sums.drop("n_docs"), weights, most_copies), fresh_folder(spark, "mix-targets"))
    by_source = store(levels(classes, by_source), fresh_folder(spark, "mix-levels"))
    level = by_source.select(F.col("source").alias("_source"), "certain", "level")
    wanted = expected(F.col("size"), F.col("certain"), F.col("level"))
    wide = classes.join(level, F.col("source").eqNullSafe(F.col("_source"))).withColumn("wanted", wanted)
    given = wide.groupBy(F.col("source").alias("_source")).agg(F.sum(F.floor("wanted") * F.col("size") * F.col("n")).alias("given"))
    p = F.col("wanted") - F.floor("wanted")
    drawn = _listed(wide.withColumn("p", p).where("p > 0").select("digest", "source", "size", "n", "p"), repeated)
    ranked = drawn.select("source", "size", rank(draw(F.col("digest"), F.col("nth")), F.col("p")).alias("rank"))
    ranked = store(ranked.withColumn("bin", bin_of(F.col("rank"), bins)), fresh_folder(spark, "mix-ranked"))
    gaps = by_source.join(given, F.col("source").eqNullSafe(F.col("_source"))).select(
        "_source",
        (F.lit(CLOSE) * F.col("target")).alias("enough"),
        F.lit(-1.0).alias("low"),
        (F.col("target") - F.col("given")).alias("gap"),
    )
    rounds = _rounds(ranked, store(gaps, fresh_folder(spark, "mix-gaps")), bins)
    taken = rounds.groupBy("_source").agg(F.collect_list(F.struct("low", "high", "most")).alias("rounds"))
    return store(
        by_source.join(taken, F.col("source").eqNullSafe(F.col("_source")), "left").drop("_source"),
        fresh_folder(spark, "mix-by-source"),
    )


def _rounds(ranked: DataFrame, gaps: DataFrame, bins: int) -> DataFrame:
    """_source, low, high, most of every round; ``gaps`` has the rank behind which a source goes on and what it misses.

    A round ends at the first document that would fit an empty gap but not what is left of it. What is left is less
    than that document, so the next round, behind it, looks at shorter ones.
    """
    spark, done = ranked.sparkSession, []
    same = F.col("source").eqNullSafe(F.col("_source"))
    while True:
        open_gaps = store(gaps.where("gap >= 1 AND gap > enough"), fresh_folder(spark, "mix-open"))
        if not open_gaps.limit(1).count():
            break
        behind = F.col("bin") >= bin_of(F.greatest(F.col("low"), F.lit(0.0)), bins)
        fitting = ranked.join(open_gaps, same).where(behind & (F.col("rank") > F.col("low")) & (F.col("size") <= F.col("gap")))
        binned = fitting.groupBy("_source", "bin").agg(F.sum("size").alias("words"), F.first("gap").alias("gap"))
        along = Window.partitionBy("_source").orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)
        # the bin in which the gap is filled: words before it fit, words with it do not
        last = (
            binned.withColumn("before", F.coalesce(F.sum("words").over(along), F.lit(0)))
            .where((F.col("before") <= F.col("gap")) & (F.col("before") + F.col("words") > F.col("gap")))
            .select(F.col("_source").alias("_ended"), F.col("bin").alias("last_bin"), "before")
        )
        last = store(last, fresh_folder(spark, "mix-last-bin"))
        inside = fitting.join(last, F.col("_source").eqNullSafe(F.col("_ended")) & (F.col("bin") == F.col("last_bin")))
        inside = inside.groupBy("_source", "rank").agg(F.sum("size").alias("words"), F.first("gap").alias("gap"), F.first("before").alias("before"))
        upto = Window.partitionBy("_source").orderBy("rank")
        reached = F.col("before") + F.sum("words").over(upto)
        stops = (
            inside.withColumn("reached", reached)
            .where(F.col("reached") > F.col("gap"))
            .groupBy(F.col("_source").alias("_ended"))
            .agg(F.min("rank").alias("high"), F.min_by(F.col("reached") - F.col("words"), "rank").alias("taken"))
        )
        # without a stop, all that fits is taken
        ended = open_gaps.join(stops, F.col("_source").eqNullSafe(F.col("_ended")), "left").select(
            "_source", "enough", "low", F.col("gap").alias("most"), "high", "taken"
        )
        ended = store(ended, fresh_folder(spark, "mix-round"))
        done.append(ended.select("_source", "low", F.coalesce("high", F.lit(math.inf)).alias("high"), "most"))
        gaps = ended.where("high IS NOT NULL").select(
            "_source", "enough", F.col("high").alias("low"), (F.col("most") - F.col("taken")).alias("gap")
        )
    return union_all(done) if done else gaps.select("_source", "low", "low", "gap").toDF("_source", "low", "high", "most").where("false")


def numbered(docs: DataFrame, salt: str, repeated: DataFrame | None) -> DataFrame:
    """The rows as ``doc`` with digest and ``nth`` of equal rows, which is 0 unless their kind is among ``repeated``."""
    rows = docs.select(F.struct("*").alias("doc"), digest(salt).alias("digest"))
    first = F.lit(0).cast("long").alias("nth")
    if repeated is None:
        return rows.select("*", first)
    spark = docs.sparkSession
    kinds = repeated.select(F.col("digest").alias("_digest"), F.col("source").alias("_source"))
    kind = (F.col("digest") == F.col("_digest")) & F.col("doc.source").eqNullSafe(F.col("_source"))
    single = rows.join(kinds, kind, "left_anti").select("*", first)
    # counted by task first: no task holds all rows of a kind
    many = rows.join(kinds, kind, "left_semi").withColumn("slot", F.monotonically_increasing_id())
    many = store(many.withColumn("part", F.spark_partition_id()), fresh_folder(spark, "mix-repeated"))
    own = Window.partitionBy("digest", "doc.source", "part").orderBy("slot")
    counts = many.groupBy("digest", F.col("doc.source").alias("_source"), "part").agg(F.count(F.lit(1)).alias("rows"))
    earlier = Window.partitionBy("digest", "_source").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.withColumn("before", F.coalesce(F.sum("rows").over(earlier), F.lit(0))).select(
        F.col("digest").alias("_digest"), "_source", F.col("part").alias("_part"), "before"
    )
    many = many.withColumn("place", F.row_number().over(own) - 1).join(counts, kind & (F.col("part") == F.col("_part")))
    return single.unionByName(many.select("doc", "digest", (F.col("before") + F.col("place")).cast("long").alias("nth")))


def mix(
    docs: DataFrame, weights: Sequence[float] = WEIGHTS, most_copies: float = MOST_COPIES, salt: str = "mix"
) -> DataFrame:
    """``doc`` and ``mix`` (size, source_size, target, copies) of every document; ``copies`` is how often the mix takes it."""
    spark = docs.sparkSession
    kinds = docs.select(digest(salt).alias("digest"), "source", size().alias("size")).groupBy("digest", "source")
    classes = store(kinds.agg(F.first("size").alias("size"), F.count(F.lit(1)).alias("n")), fresh_folder(spark, "mix-classes"))
    repeated = classes.where("n > 1")
    some = bool(repeated.limit(1).count())
    by_source = plan(classes, weights, most_copies, some).select(F.struct("*").alias("plan"))
    rows = numbered(docs, salt, repeated if some else None).withColumn("size", size("doc.text"))
    wide = rows.join(by_source, F.col("doc.source").eqNullSafe(F.col("plan.source")), "left")
    wide = wide.withColumn("wanted", expected(F.col("size"), F.col("plan.certain"), F.col("plan.level")))
    p = F.col("wanted") - F.floor("wanted")
    wide = wide.withColumn("rank", F.when(p > 0, rank(draw(F.col("digest"), F.col("nth")), p)))
    taken = F.exists(
        F.coalesce("plan.rounds", F.array().cast("array<struct<low:double,high:double,most:double>>")),
        lambda x: (F.col("rank") > x["low"]) & (F.col("rank") < x["high"]) & (F.col("size") <= x["most"]),
    )
    extra = F.when(F.coalesce(taken, F.lit(False)), 1).otherwise(0)
    return wide.select(
        "doc",
        F.struct(
            "size",
            F.col("plan.source_size").alias("source_size"),
            F.col("plan.target").alias("target"),
            (F.floor("wanted") + extra).cast("int").alias("copies"),
        ).alias("mix"),
    )
