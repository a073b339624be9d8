"""Merkle manifest and proofs against a plain build and climb."""

import hashlib
import zlib

import pytest
import samples
from pyspark.sql import functions as F

from shelfwise.llm import merkle

SCHEMA = "doc_id long, source string, lang string, n_chars long, text string, at string, tree string, place string, level string"


def h(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf(row, text):
    values = [row[0], row[1], row[2], row[3], text]
    return h("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def levels(digests):
    """All levels of a tree from its leaves to one node."""
    found = [digests]
    while len(found[-1]) > 1:
        found.append([h("".join(found[-1][i : i + 8])) for i in range(0, len(found[-1]), 8)])
    return found


def siblings(tree, place):
    for level in tree[:-1]:
        first = place // 8 * 8
        yield level[first:place], level[place + 1 : first + 8]
        place //= 8


def slow(rows):
    """(doc_id, leaf, subroot, root, proof, folded) per row, as text."""
    lower = lambda t: t and "".join(c.lower() if "A" <= c <= "Z" else c for c in t)
    hit = lambda i: i is not None and zlib.crc32(str(i).encode()) % 3 == 0
    groups: dict = {}
    for r in rows:
        groups.setdefault(r[2], []).append((r[0], leaf(r, r[4]), leaf(r, lower(r[4]) if hit(r[0]) else r[4])))
    order = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = []
    for g in order:
        groups[g].sort(key=lambda x: (x[0] is not None, x[0] or 0, x[1], x[2]))
        trees.append(levels([x[1] for x in groups[g]]))
    top = levels([t[-1][0] for t in trees])
    for n, g in enumerate(order):
        for place, (doc_id, digest, claim) in enumerate(groups[g]):
            folded, proof = claim, ""
            for before, behind in [*siblings(trees[n], place), *siblings(top, n)]:
                proof += "".join(before + behind)
                folded = h("".join([*before, folded, *behind]))
            yield doc_id, digest, trees[n][-1][0], top[-1][0], proof, folded


def found(spark, rows):
    filled = [(*r, "a", "b", "c", "d") for r in rows]
    docs = spark.createDataFrame(filled, SCHEMA)
    manifest = merkle.build(docs, merkle.leaf_digest(merkle.lower_cased_third(F.col("doc_id"), F.col("text"))))
    root = manifest.root.hex()
    return [
        (r.doc_id, r.leaf.hex(), r.subroot.hex(), root, r.proof.hex(), r.folded.hex())
        for r in merkle.prove(manifest).collect()
    ]


def row(i, lang, text="Some Text"):
    return (i, f"site{(i or 0) % 5}", lang, len(text) if text else None, text)


ODD = [(i, s, "xx" if n % 3 else None, len(t) if t else None, t) for n, (i, t, s) in enumerate(samples.texts())]
TABLES = {
    "one row": [row(3, "en")],
    "one group": [row(i, "en") for i in range(9)],
    "groups of one": [row(i, f"l{i:02}") for i in range(10)],
    "uneven": [row(i, "en") for i in range(75)] + [row(i, "de", "ÄB c") for i in range(100, 109)] + [row(7, None), row(8, "")],
    "odd": ODD,
    "ties": [row(5, "en")] * 20 + [row(None, "en")] * 3 + [row(5, "en", "Other"), row(None, None, None)],
}


@pytest.mark.parametrize("name", list(TABLES))
def test_proofs(spark, name):
    key = lambda x: tuple(map(str, x))
    assert sorted(found(spark, TABLES[name]), key=key) == sorted(slow(TABLES[name]), key=key)


def test_blocks_of_leaves(spark, monkeypatch):
    """Upper nodes are listed once per block, in the tree of a group and in the one above the groups."""
    monkeypatch.setattr(merkle, "BLOCK_LEVEL", 1)
    monkeypatch.setattr(merkle, "_CLIMB", merkle._CLIMB.replace("level + 1, 4)", "level + 1, 1)"))
    rows = [row(i, "en") for i in range(140)] + [row(1000 + i, f"l{i % 11:02}") for i in range(50)]
    assert sorted(map(str, found(spark, rows))) == sorted(map(str, slow(rows)))


def test_upper_nodes_serve_few_leaves_each(spark, monkeypatch):
    monkeypatch.setattr(merkle, "BLOCK_LEVEL", 1)
    docs = spark.createDataFrame([row(i, "en") for i in range(200)], "doc_id long, source string, lang string, n_chars long, text string")
    rungs = merkle.rungs(merkle.build(docs)).groupBy("level").count().collect()
    assert {r["level"]: r["count"] for r in rungs} == {1: 25, 2: 25, 3: 25}


def test_nothing(spark):
    docs = spark.createDataFrame([], SCHEMA)
    manifest = merkle.build(docs)
    assert manifest.root is None and merkle.prove(manifest).count() == 0
