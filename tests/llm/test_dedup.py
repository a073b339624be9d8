"""Line, near-copy and vector deduplication against brute force."""

import math
import random
import re
import unicodedata

import numpy as np
import pytest
import samples
import xxhash
from pyspark.sql import functions as F

from shelfwise.llm import components as graph, embedding_dedup, line_dedup, simhash

# ---- lines ----


def slow_lines(rows, min_sites):
    has_letters = lambda line: any(unicodedata.category(c)[0] in "LN" for c in line)
    sites: dict = {}
    for _, text, source in rows:
        for line in (text or "").split("\n"):
            if has_letters(line):
                sites.setdefault(line.strip(" "), set()).add(source)
    return {line for line, found in sites.items() if len(found) >= min_sites}


@pytest.mark.parametrize("min_sites", [2, 10])
def test_spread_lines_go(docs, min_sites):
    rows = samples.texts()
    spread = slow_lines(rows, min_sites)
    assert spread
    got = line_dedup.remove_spread_lines(docs, min_sites).collect()
    assert len(got) == len(rows)
    kept: dict = {}
    for r in got:
        assert r.doc.asDict().keys() >= set(samples.CLASHING.split())
        if r.doc.text is None:
            assert r.text is None and (r.n_lines, r.n_removed) == (0, 0)
            continue
        before, after = r.doc.text.split("\n"), r.text.split("\n") if r.n_removed < r.n_lines else []
        assert (len(before), len(before) - len(after)) == (r.n_lines, r.n_removed)
        assert [x for x in before if x.strip(" ") not in spread] == [x for x in after if x.strip(" ") not in spread]
        for line in after:
            if line.strip(" ") in spread:
                kept.setdefault(line.strip(" "), []).append(r.doc.doc_id)
    for line in spread:
        holders = [i for i, t, _ in rows if t and line in (x.strip(" ") for x in t.split("\n"))]
        least = min((i for i in holders if i is not None), default=None)
        # rows equal in id and text share the first occurrence
        assert set(kept[line]) == {least} and len(kept[line]) <= holders.count(least)


def test_exact_count_near_the_limit(spark):
    rows = [(i, "on ten\nalone %d" % i, f"s{i}") for i in range(10)] + [(50 + i, "on nine", f"s{i}") for i in range(9)]
    found = line_dedup.spread_lines(samples.documents(spark, rows), 10).collect()
    assert [r.n_sites for r in found] == [10]


def test_repeated_rows_lose_a_line_once(spark):
    spread = [(i, "on ten", f"s{i}") for i in range(10)]
    rows = [*spread, *[(50, "own\non ten\nmore", "s1")] * 3, *[(None, "on ten\nfree", "s2")] * 4]
    got = line_dedup.remove_spread_lines(samples.documents(spark, rows), 10).where("doc.doc_id >= 50 or doc.doc_id is null").collect()
    found = sorted((r.doc.doc_id or 0, r.text, r.n_lines, r.n_removed) for r in got)
    assert found == [(0, "free", 2, 1)] * 4 + [(50, "own\nmore", 3, 1)] * 3


def test_no_lines(no_docs):
    assert line_dedup.remove_spread_lines(no_docs).count() == 0


# ---- components ----


@pytest.mark.parametrize("shape", ["path", "star", "random"])
def test_components(spark, shape):
    random_ = random.Random(3)
    pairs = {
        "path": [(i, i + 1) for i in range(40)],
        "star": [(1000, i) for i in range(40)] + [(7, 2000)],
        "random": [(random_.randrange(-60, 60), random_.randrange(-60, 60)) for _ in range(70)],
    }[shape]
    parent = {x: x for pair in pairs for x in pair}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in pairs:
        a, b = sorted((root(a), root(b)))
        parent[b] = a
    expected = {x: root(x) for x in parent if any(x in p and p[0] != p[1] for p in pairs)}
    links = spark.createDataFrame(pairs + pairs[:5], "a long, b long")
    assert {r.node: r.component for r in graph.components(links).collect()} == expected


def test_no_links(spark):
    assert graph.components(spark.createDataFrame([], "a long, b long")).count() == 0


# ---- SimHash ----


def slow_fingerprint(text):
    lower = (text or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))
    words = re.findall(r"[^\x20\x09-\x0D]+", lower)
    if not words:
        return 0
    runs = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or [" ".join(words)]
    hashes = np.array([xxhash.xxh64_intdigest(x.encode(), 42) for x in runs], dtype=np.uint64)
    return sum(1 << b for b in range(64) if 2 * int((hashes >> np.uint64(b) & np.uint64(1)).sum()) > len(runs))


def test_near_copies(docs, monkeypatch):
    monkeypatch.setattr(simhash, "SHARD", 8)  # a tree over shards, and blocks of them
    monkeypatch.setattr(simhash, "ASKED", 16)
    rows = samples.texts()
    got = simhash.near_copies(docs).collect()
    assert len(got) == len(rows)
    fps = {t: slow_fingerprint(t) for _, t, _ in rows}
    by_row = sorted(((i, fps[t]) for i, t, _ in rows), key=str)
    assert sorted(((r.doc_id, r.fp % (1 << 64)) for r in got), key=str) == by_row
    # brute force over all pairs
    values = sorted(set(fps.values()))
    label = {v: v for v in values}
    for _ in values:
        for a in values:
            for b in values:
                if (a ^ b).bit_count() <= 3:
                    label[a] = label[b] = min(label[a], label[b])
    least: dict = {}
    for i, fp in by_row:
        least.setdefault(label[fp], []).extend([i] if i is not None else [])
    for r in got:
        assert r.component_id == min(least[label[r.fp % (1 << 64)]], default=None)
    kept = simhash.one_of_each(docs).collect()
    assert len(kept) == len(set(label.values()))
    assert kept[0].asDict().keys() == set(docs.columns)
    assert {label[fps[r.text]] for r in kept} == set(label.values())


def test_links_of_dense_and_sparse_fingerprints(spark, monkeypatch):
    monkeypatch.setattr(simhash, "SHARD", 64)
    monkeypatch.setattr(simhash, "ASKED", 256)
    monkeypatch.setattr(simhash, "LEAF", 16)
    random_ = random.Random(5)
    values = {random_.getrandbits(64) for _ in range(700)}
    for start in list(values)[:20]:  # chains of near copies
        for _ in range(15):
            for bit in random_.sample(range(64), random_.randint(1, 4)):
                start ^= 1 << bit
            values.add(start)
    centre = random_.getrandbits(64)
    values |= {centre ^ (1 << a) ^ (1 << b) for a in range(64) for b in range(a)}  # a dense group
    values = np.array(sorted(values), dtype=np.uint64)
    fps = spark.createDataFrame([(int(v),) for v in values.view(np.int64)], "fp long")
    links = {(r.a % (1 << 64), r.b % (1 << 64)) for r in simhash.near_links(fps).collect()}
    assert all((a ^ b).bit_count() <= 64 for a, b in links) and len(links) < 20 * len(values)
    slow = simhash.least_labels(
        len(values), *np.nonzero(np.bitwise_count(values[:, None] ^ values[None, :]) <= 3)
    )
    at = {int(v): i for i, v in enumerate(values)}
    fast = simhash.least_labels(
        len(values), np.array([at[a] for a, _ in links]), np.array([at[b] for _, b in links])
    )
    assert (slow == fast).all()


def test_no_near_copies(no_docs):
    assert simhash.near_copies(no_docs).count() == 0
    assert simhash.one_of_each(no_docs).count() == 0


# ---- vectors ----


def vectors():
    random_ = np.random.default_rng(4)
    rows = []
    for group in range(60):
        centre = random_.standard_normal(24)
        for _ in range(random_.integers(1, 9)):
            near = centre + random_.standard_normal(24) * random_.choice([0.02, 0.1, 0.15])
            rows.append((len(rows), near.astype("float32").tolist(), int(group % 3)))
    rows += [(1000 + k, rows[0][1], 0) for k in range(5)]  # copies
    rows += [(1010, rows[0][1], 1), (1011, rows[0][1], None)]
    rows += [(1020, None, 0), (1021, [], 0), (1022, [0.0] * 24, 0), (1023, [None, 1.0] * 12, 0)]
    rows += [(1024, [math.nan] * 24, 0), (1025, [math.inf] + [1.0] * 23, 0), (1026, [1.0, 2.0], 0), (1027, [1.0, 2.0], 0)]
    rows += [(1020, None, 0), (1000, rows[0][1], 0), (None, rows[0][1], 0), (None, None, None)]
    rows += [(1030, [1e30] * 24, 0), (1031, [1e-30] * 24, 0)]
    return rows


@pytest.mark.parametrize("block", [5, 2048])
def test_near_vectors(spark, monkeypatch, block):
    monkeypatch.setattr(embedding_dedup, "BLOCK", block)
    rows = vectors()
    table = spark.createDataFrame(
        [(*r, "x", "y") for r in rows], "vec_id long, embedding array<float>, label int, digest string, number string"
    )
    got = embedding_dedup.near_vectors(table).collect()
    assert len(got) == len(rows)

    def usable(v, label):
        return label is not None and v and None not in v and all(map(math.isfinite, v)) and any(v)

    parsed = [np.array(v, dtype="float32").astype(float) if usable(v, label) else None for _, v, label in rows]
    n = len(rows)
    linked = np.zeros((n, n), dtype=bool)
    for i in range(n):
        for j in range(n):
            a, b = parsed[i], parsed[j]
            if i != j and a is not None and b is not None and rows[i][2] == rows[j][2] and len(a) == len(b):
                linked[i, j] = a @ b / math.sqrt(a @ a) / math.sqrt(b @ b) >= 0.98
    label = simhash.least_labels(n, *np.nonzero(linked))
    expected = []
    for i in range(n):
        ids = [rows[j][0] for j in range(n) if label[j] == label[i] and rows[j][0] is not None]
        expected.append((rows[i][0], int(linked[i].sum()), min(ids, default=None)))
    assert sorted(map(tuple, got), key=str) == sorted(expected, key=str)


def test_no_vectors(spark):
    table = spark.createDataFrame([], "vec_id long, embedding array<float>, label int")
    assert embedding_dedup.near_vectors(table).count() == 0


def test_recall_at_the_limit():
    step, projections, tables = embedding_dedup.shape(10**6, 0.98, 0.998)
    near = embedding_dedup.collision(step / math.sqrt(2 - 2 * 0.98))
    assert 1 - (1 - near**projections) ** tables >= 0.998


def test_vectors_beyond_the_root_of_the_double_range(spark):
    """Squares of their numbers vanish or overflow; their cosines are those of the vectors ten to some power larger."""
    random_ = np.random.default_rng(9)
    base = random_.standard_normal(16)
    near, far = base + 0.01 * random_.standard_normal(16), random_.standard_normal(16)
    far = far + base  # of positive product, but not near
    rows = [(10 * k + i, (v * 10.0**e).tolist(), 0) for k, e in enumerate((0, -200, 200, -300, -310)) for i, v in enumerate((base, near, far))]
    rows += [(90, (base * 1e200).tolist(), 0)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    got = {r.vec_id: (r.n_links, r.component_id) for r in embedding_dedup.near_vectors(table).collect()}
    assert got == {i: (4, 2) if i % 10 == 2 else (10, 0) for i, _, _ in rows}


def test_cells_of_a_shard_are_dealt_to_tasks(spark, monkeypatch):
    monkeypatch.setattr(simhash, "SHARD", 64)
    fps = spark.range(1000).select(F.xxhash64("id").alias("fp"))
    plan = simhash.near_links(fps)._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(shard#" in plan
    last = plan.index("FlatMapGroupsInPandas")
    exchange = plan.index("Exchange hashpartitioning(", last)
    line = plan[exchange : plan.index("\n", exchange)]
    assert all(f"{c}#" in line for c in ("shard", "block", "ask")) and "REPARTITION_BY_NUM" in line
