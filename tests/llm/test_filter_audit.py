"""Filter interaction audit against removing documents filter by filter."""

import itertools
import math
import random
import re

import samples

from shelfwise.llm import filter_audit

WORD = r"[^\x20\x09-\x0D]+"


def failures(rows):
    """The letters of the filters that each row fails."""
    first: dict = {}
    for doc_id, text, _ in rows:
        if doc_id is not None:
            first[text or ""] = min(doc_id, first.get(text or "", doc_id))
    for doc_id, text, _ in rows:
        text = text or ""
        words = re.findall(WORD, text)
        failed = {
            "A": len(words) < 200,
            "B": 100 * len(set(words)) < 50 * len(words),
            "C": 100 * len(re.findall("[A-Z]", text)) > 3 * len(text),
            "D": bool(re.search(r"[#$%&*|]", text)),
            "E": doc_id is not None and doc_id > first[text],
        }
        yield {x for x, bad in failed.items() if bad}


def slow(rows, labels):
    good = {i for i, quality, _ in labels if quality == 1 and i is not None}
    toxic = {i for i, _, bad in labels if bad == 1 and i is not None}
    parts: dict = {}
    for row, failed in zip(rows, failures(rows), strict=True):
        parts.setdefault(row[2] or "", []).append((row[0], failed))
    for part, docs in parts.items():
        steps, shares = [], dict.fromkeys("ABCDE", 0)
        for order in itertools.permutations("ABCDE"):
            left = docs
            for i, x in enumerate(order, 1):
                gone = [d for d in left if x in d[1]]
                left = [d for d in left if x not in d[1]]
                shares[x] += len(gone)
                redundant = sum(x in f for _, f in docs) - len(gone)
                steps.append((x, part, "".join(order), i, len(left), len(gone), redundant, sum(f == {x} for _, f in docs),
                              sum(d in good for d, _ in gone), sum(d in toxic for d, _ in gone)))
        yield from ((*rest, shares[x]) for x, *rest in steps)


def check(spark, rows, labels):
    docs = spark.createDataFrame([(*r, "x", 1) for r in rows], "doc_id long, text string, lang string, part string, n int")
    marks = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    found = filter_audit.audit(filter_audit.failure_masks(docs, marks)).collect()
    assert sorted(map(tuple, found)) == sorted(slow(rows, labels))


def test_odd_documents(spark):
    langs = ["en", "en", "de", None, ""]
    rows = [(i, t, langs[n % 5]) for n, (i, t, _) in enumerate(samples.texts())]
    rows += [(2000 + i, samples.prose(i % 7, 250 + i % 7) + " $" * (i % 2), "en") for i in range(40)]
    rows += [(3000 + i, "ABC def " * 200, langs[i % 5]) for i in range(9)] + [(3000, "ABC def " * 200, "en")] * 2
    rows += [(None, samples.prose(1, 251) + " $", "en")] * 3
    labels = [(2000 + i, i % 2, None if i % 3 else 1) for i in range(0, 40, 2)] + [(None, 1, 1), (100, 1, 0), (100, 0, 1), (3000, 1, None)]
    check(spark, rows, labels)


def test_without_labels(spark):
    check(spark, [(1, "a", "x"), (2, "a", "y"), (3, None, None), (4, "", "x")], [])


def test_nothing(spark, no_docs):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert filter_audit.audit(filter_audit.failure_masks(no_docs, labels)).count() == 0


def test_neighbour_swaps_visit_all_orders():
    for n in range(7):
        order = list(range(n))
        seen = {tuple(order)}
        for place in filter_audit.neighbour_swaps(n):
            order[place], order[place + 1] = order[place + 1], order[place]
            seen.add(tuple(order))
        assert len(seen) == math.factorial(n)


def test_diagrams_share_equal_parts():
    """A filter that nothing fails adds one node per level at most, and a swap keeps the weights of all masks."""
    random_ = random.Random(2)
    weights = {mask: (random_.randint(1, 9),) for mask in range(32) if not mask & 4}
    diagram = filter_audit.Diagram("ABCDE", weights, 1)

    def ends(node, depth, path):
        if not depth:
            return {frozenset(path): node}
        letter = diagram.order[-depth]
        return ends(node[0], depth - 1, path) | ends(node[1], depth - 1, [*path, letter])

    before = ends(diagram.root, 5, [])
    for upper in (0, 3, 1, 2, 2, 0):
        diagram.swap(upper)
        assert ends(diagram.root, 5, []) == before
    assert filter_audit.Diagram("ABCDE", {}, 1).steps().__next__() == ("A", (0,), (0,))
