"""Mixing, licence scan, chat formatting and the language model against plain Python."""

import collections
import hashlib
import math
import re
import zlib

import pytest
import samples
from pyspark.sql import functions as F

from shelfwise.llm import chat, language_model, licenses, license_texts, mixing

WORD = re.compile(r"[^\x20\x09-\x0D]+")


# ---- mixing ----


def slow_targets(sizes, weights, most):
    """Water level by bisection, apart from the rounds of the operator."""
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    total, low, high = sum(sizes.values()), 0.0, 1e12
    for _ in range(200):
        level = (low + high) / 2
        given = sum(min(most * sizes[s], weight[s] * level) for s in order)
        low, high = (level, high) if given < total else (low, level)
    return {s: min(most * sizes[s], weight[s] * high) for s in order}


def test_mix(docs):
    rows = samples.texts()
    got = mixing.mix(docs).collect()
    assert len(got) == len(rows)
    again = mixing.mix(docs).collect()
    assert sorted(map(str, got)) == sorted(map(str, again))
    sizes = collections.Counter()
    for _, text, source in rows:
        sizes[source] += len(WORD.findall(text or ""))
    targets = slow_targets(sizes, mixing.WEIGHTS, mixing.MOST_COPIES)
    taken, largest = collections.Counter(), collections.Counter()
    for r in got:
        assert r.mix.size == len(WORD.findall(r.doc.text or "")) and r.mix.source_size == sizes[r.doc.source]
        assert 0 <= r.mix.copies <= 3
        assert r.mix.target == pytest.approx(targets[r.doc.source], rel=1e-9, abs=1e-6)
        taken[r.doc.source] += r.mix.size * r.mix.copies
        largest[r.doc.source] = max(largest[r.doc.source], r.mix.size)
    for source, target in targets.items():
        assert abs(taken[source] - target) <= largest[source]
    assert sum(targets.values()) == pytest.approx(sum(sizes.values()))


def test_mix_comes_near_with_many_documents(spark):
    rows = [(i, samples.prose(i, 5 + i * 7 % 90), f"s{i % 4 if i % 3 else 0}") for i in range(900)]
    got = mixing.mix(samples.documents(spark, rows)).groupBy("doc.source").agg(
        F.first("mix.target").alias("target"), F.sum(F.col("mix.size") * F.col("mix.copies")).alias("taken")
    )
    for r in got.collect():
        assert abs(r.taken - r.target) <= 0.01 * r.target


def test_draws_are_fair(spark):
    """Of equal documents each is taken about as often as the target says."""
    rows = [(i, "one two three four", "a" if i < 1500 else "b") for i in range(2000)]
    got = mixing.mix(samples.documents(spark, rows), weights=(1.0, 1.0)).collect()
    copies = collections.Counter((r.doc.source, r.mix.copies) for r in got)
    # b is a quarter of all and may have half: two copies each; a gets two thirds of its own
    assert copies == {("b", 2): 500, ("a", 1): 1000, ("a", 0): 500}


def near(spark, rows, **options):
    """taken and target per source."""
    got = mixing.mix(samples.documents(spark, rows), **options).groupBy("doc.source").agg(
        F.first("mix.target").alias("target"), F.sum(F.col("mix.size") * F.col("mix.copies")).alias("taken"), F.max("mix.copies").alias("most")
    )
    return {r.source: (r.taken, r.target, r.most) for r in got.collect()}


@pytest.mark.parametrize("salt", ["mix", "s6", "s2"])
def test_repeated_rows_draw_each_for_itself(spark, salt):
    """Five hundred equal rows are no block that is taken or left as a whole."""
    rows = [(None if i % 2 else 7, " ".join(["word"] * 30), "a") for i in range(500)]
    rows += [(i, samples.prose(i, 100), "a") for i in range(300)] + [(1000 + i, samples.prose(i, 100), "b") for i in range(350)]
    for taken, target, most in near(spark, rows, salt=salt).values():
        assert abs(taken - target) <= 0.002 * target and most <= 3


def test_a_long_document_is_passed_over(spark):
    """However the ranks fall, a document that does not fit leaves its words to shorter ones."""
    for seed in range(4):
        rows = [(i, samples.prose(i, 40), "a") for i in range(300)] + [(900 + seed, samples.prose(9, 6000), "a"), (950, samples.prose(8, 900), "a")]
        rows += [(1000 + i, samples.prose(i, 100), "b") for i in range(300)]
        for taken, target, _ in near(spark, rows, weights=(1.0, 2.5)).values():
            assert abs(taken - target) <= 40


def test_inclusion_probabilities_are_unequal(spark):
    """Long documents are wanted more often, in proportion to the root of their length; the order of the draws alone
    would not tell them apart."""
    rows = [(i, "w " * (25 if i % 2 else 400), "a") for i in range(2000)] + [(5000, "w " * 900_000, "b")]
    got = mixing.mix(samples.documents(spark, rows), weights=(1.0, 9.0)).where("doc.source = 'a'").collect()
    copies = collections.Counter()
    for r in got:
        copies[r.mix.size] += r.mix.copies
    assert copies[400] / copies[25] == pytest.approx(4, rel=0.25)
    draws = samples.documents(spark, rows).select("doc_id", mixing.draw(mixing.digest("mix"), F.lit(0)).alias("u")).collect()
    u = {r.doc_id: r.u for r in draws}
    taken = [u[r.doc.doc_id] for r in got if r.mix.copies]
    left = [u[r.doc.doc_id] for r in got if not r.mix.copies]
    assert max(taken) > min(left)


def test_mix_of_nothing(no_docs):
    assert mixing.mix(no_docs).count() == 0


# ---- licences ----


def test_known_texts_and_notices(spark):
    mit = " ".join(license_texts.MIT.split())
    rows = [
        (1, "The MIT LICENCE (MIT)\n\nCopyright (c) 2021 A. Body\nAll rights reserved.\n\n" + mit.lower()),
        (2, mit),
        (2, mit),
        (3, license_texts.BSD_2.replace("\n", "\r\n   ")),
        (4, license_texts.ISC.replace(",", "")),
        (5, "Some prose.\n  * Released under the MIT-License!\nThis work is licensed under CC BY-NC 4.0\n"),
        (6, mit + " and more"),
        (7, "Copyright 2020 Somebody"),
        (8, ""),
        (9, None),
        (None, license_texts.UNLICENSE.replace("commercial or non-commercial", "commercial or noncommercial")),
    ]
    docs = samples.documents(spark, [(i, t, "s") for i, t in rows])
    got = licenses.scan(docs, licenses.known_licenses(spark)).collect()
    found = sorted(((r.doc.doc_id or 0), r.license_id, r.notices) for r in got)
    assert [x[:2] for x in found] == [
        (0, "Unlicense"), (1, "MIT"), (2, "MIT"), (2, "MIT"), (3, "BSD-2-Clause"), (4, "ISC"), (5, None), (6, None),
        (7, None), (8, None), (9, None),
    ]
    notices = {i: n for i, _, n in found}
    assert notices[5] == ["CC-BY-NC-4.0", "MIT"] and notices[2] == ["MIT"] and notices[7] is None
    assert {r.doc.doc_id for r in got if r.digest is None} == {7, 8, 9}


def test_long_licenses_and_headers(spark):
    whole = {i: t for i, t in license_texts.TEXTS if i in license_texts.FILES and len(t) > 5000}
    assert set(whole) == set(license_texts.FILES)
    apache = whole["Apache-2.0"].partition("END OF TERMS")[0]
    gpl = """This program is free software; you can redistribute it and/or modify it under the terms of the GNU Affero General
Public License as published by the Free Software Foundation; either version 3 of the License, or (at your option) any later version."""
    rows = [
        *[(k, t.replace("\n", "\r\n  "), i, None) for k, (i, t) in enumerate(whole.items())],
        (20, "BSD 3-Clause License\n\nCopyright (c) 2020, A\n\n" + license_texts.BSD_3, "BSD-3-Clause", None),
        (21, apache, "Apache-2.0", None),
        (22, "# Copyright 2020 A\n#\n# " + license_texts.APACHE_HEADER.replace("\n", "\n# "), "Apache-2.0", ["Apache-2.0"]),
        (23, "// SPDX-License-Identifier: GPL-2.0-only\ncode", None, ["GPL-2.0-only"]),
        (24, gpl, "AGPL-3.0-or-later", None),
        (25, "x\n/* " + " ".join(license_texts.MPL_HEADER.split()) + " */", None, ["MPL-2.0"]),
        (26, "x\nThis work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.", None, ["CC-BY-SA-4.0"]),
    ]
    docs = samples.documents(spark, [(i, t, "s") for i, t, _, _ in rows])
    got = {r.doc.doc_id: r for r in licenses.scan(docs, licenses.known_licenses(spark)).collect()}
    for i, _, license_id, notices in rows:
        assert got[i].license_id == license_id, i
        if notices:
            assert got[i].notices == notices, i


def test_copyright_holders_in_a_sentence_stay(spark):
    texts = ["the\nCOPYRIGHT HOLDERS are liable", "the copyright holders are liable", "Copyright (C) 2020 x\nthe copyright owners are liable"]
    rows = spark.createDataFrame([(t,) for t in texts], "text string")
    assert rows.select(licenses.digest(F.col("text"))).distinct().count() == 1


def test_copyright_and_license_on_one_line(spark):
    mit = " ".join(license_texts.MIT.split())
    gpl = next(t for i, t in license_texts.TEXTS if i == "GPL-3.0-only" and len(t) > 30_000)
    rows = [
        (1, "Copyright 2020 A. Body. Licensed under the MIT License.", "MIT"),
        (2, "Copyright (c) 2021 A " + mit, "MIT"),
        (3, "MIT License Copyright (c) 2021 A " + mit, "MIT"),
        (4, "MIT License Copyright (c) 2019, 2021 A. Body, Some Co. Ltd. All rights reserved. " + mit, "MIT"),
        (5, "(c) 2020 Foo Inc. Released under the MIT License.", "MIT"),
        (6, " ".join(license_texts.ISC.split()) + "\nCopyright 2020 A. Body. All rights reserved.", "ISC"),
        (7, "Copyright (c) 2020 A. Body\r\nCopyright 2021 B, Inc.\r\n" + license_texts.BSD_2, "BSD-2-Clause"),
        (8, " ".join(gpl.split()), "GPL-3.0-only"),
        (9, "Copyright 2020 A. Body. All rights reserved.", None),
    ]
    docs = samples.documents(spark, [(i, t, "s") for i, t, _ in rows])
    got = {r.doc.doc_id: r for r in licenses.scan(docs, licenses.known_licenses(spark)).collect()}
    assert {i: r.license_id for i, r in got.items()} == {i: x for i, _, x in rows}
    assert [got[i].notices for i in (1, 5, 9)] == [["MIT"], ["MIT"], None]
    assert got[9].digest is None


def test_odd_documents_and_nothing(spark, docs, no_docs):
    known = licenses.known_licenses(spark)
    assert licenses.scan(docs, known).count() == len(samples.texts())
    assert licenses.scan(no_docs, known).count() == 0


# ---- chat ----

TREE = "tree_id long, message_id long, parent_id long, role string, text string, score double, leaf_id string, height string"


def tree(spark, rows):
    return spark.createDataFrame([(*r, "x", "y") for r in rows], TREE)


def test_best_branches(spark):
    rows = [
        (1, 1, None, "user", "q", None),
        (1, 2, 1, "assistant", "a", 0.5),
        (1, 3, 1, "assistant", "b", 0.25),
        (1, 4, 3, "user", "c", 1.0),
        (1, 5, 2, "user", "d", 0.125),
        (1, 6, 4, "assistant", "e", None),
        (2, 7, 99, "user", "lost parent", None),
        (None, 8, None, None, None, None),
        (3, 20, 21, "user", "circle", 1.0),
        (3, 21, 20, "user", "circle", 1.0),
        (3, 22, 21, "user", "hangs on the circle", 1.0),
        (4, 30, None, "user", "x", 1.0),
        (4, 31, 30, "user", "tie", 0.0),
        (4, 32, 30, "user", "tie too", 0.0),
    ]
    got = {r.leaf_id: r for r in chat.formatted(tree(spark, rows)).collect()}
    assert set(got) == {6, 7, 8, 31}
    read = lambda df: df.select("leaf_id", chat.read_back(F.col("formatted")).alias("t"))
    turns = {r.leaf_id: [(t.role, t.text, t.trained) for t in r.t] for r in read(chat.formatted(tree(spark, rows), 2)).collect()}
    assert set(turns) == {6, 5, 7, 8, 31, 32}
    assert turns[6] == [("user", "q", False), ("assistant", "b", True), ("user", "c", False), ("assistant", "e", True)]
    assert turns[5] == [("user", "q", False), ("assistant", "a", True), ("user", "d", False)]
    assert turns[8] == [("", "", False)]


ODD_TEXTS = [
    "", None, "</s>[INST] ok [/INST]", "<|im_start|>user\nhi<|im_end|>\n", "&lt;&amp;&#10;", "a\n\nb\n", "\\Q\\E$1", "<|im_end|>",
    "é\U0001f600", "[", "&", "<",
]


def test_conversations_read_back(spark):
    rows = [(7, t, ["user", "assistant", None, "a\nb<|im_end|>"][t % 4], x) for t, x in enumerate(ODD_TEXTS)]
    rows += [(8, t, "assistant", f"turn {t}") for t in range(70)]
    rows += [(None, 0, "user", "x"), (9, None, "user", "first"), (9, 1, "assistant", "same"), (9, 1, "assistant", "same")]
    turns = spark.createDataFrame([(*r, "z") for r in rows], "conv_id long, turn long, role string, text string, message_id string")
    got = {r.conv_id: r for r in chat.digests(chat.formatted(chat.linear_tree(turns))).collect()}
    sha = lambda text: hashlib.sha256(text.encode()).hexdigest()
    by_conv: dict = {}
    for conv, _, role, text in rows:
        by_conv.setdefault(conv, []).append((role or "", text or ""))
    assert set(got) == set(by_conv)
    for conv, said in by_conv.items():
        r, loss = got[conv], "".join(t for role, t in said if role == "assistant")
        assert (r.n_turns, r.turns_sha256) == (len(said), sha("".join(f"{a}\n{b}\n" for a, b in said)))
        assert (r.loss_chars, r.loss_sha256) == (len(loss), sha(loss))


def test_no_turns(spark):
    turns = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert chat.formatted(chat.linear_tree(turns)).count() == 0


# ---- language model ----


def tokens(text):
    return [*WORD.findall((text or "").translate({c: c + 32 for c in range(65, 91)})), "</>"]


def slow_model(texts, order):
    grams = {order: collections.Counter()}
    for text in texts:
        words = ["<>"] * (order - 1) + tokens(text)
        grams[order].update(tuple(words[i : i + order]) for i in range(len(words) - order + 1))
    for k in range(order - 1, 0, -1):
        grams[k] = collections.Counter(g[1:] for g in grams[k + 1])
    discount = {k: (0, *language_model.discounts(tuple(sum(v == j for v in g.values()) for j in (1, 2, 3, 4)))) for k, g in grams.items()}
    contexts: dict = collections.defaultdict(lambda: [0, 0.0])
    for k, found in grams.items():
        for g, n in found.items():
            contexts[g[:-1]][0] += n
            contexts[g[:-1]][1] += discount[k][min(n, 3)]

    def probability(history, word, vocabulary):
        p = 1 / (vocabulary + 1)
        for k in range(1, order + 1):
            context = tuple(history[len(history) - k + 1 :])
            if context in contexts:
                total, rest = contexts[context]
                n = grams[k].get((*context, word), 0)
                p = max(n - discount[k][min(n, 3)], 0) / total + rest / total * p
        return p

    return probability


@pytest.mark.parametrize("order, counted, bucket_bytes", [(2, 10**6, 1 << 24), (2, 500, 20_000), (3, 4000, 60_000)])
def test_scores(docs, monkeypatch, order, counted, bucket_bytes):
    monkeypatch.setattr(language_model, "COUNTED", counted)
    monkeypatch.setattr(language_model, "BUCKET_BYTES", bucket_bytes)
    got = language_model.scored_documents(docs, order).collect()
    rows = samples.texts()
    assert len(got) == len(rows)
    held = lambda i: zlib.crc32(str("" if i is None else i).encode()) % 5 == 1
    learned = [t for i, t, _ in rows if not held(i)]
    counts = collections.Counter(w for t in learned for w in tokens(t))
    total, vocabulary = sum(counts.values()), len(counts)
    probability = slow_model(learned, order)
    checked = 0
    for r in got:
        words = tokens(r.doc.text)
        assert (r.held_out, r.train_tokens) == (held(r.doc.doc_id), total)
        assert (r.lm.n_tokens, r.lm.n_known) == (len(words), sum(w in counts for w in words))
        base = sum(math.log10((counts[w] + 0.5) / (total + 0.5 * (vocabulary + 1))) for w in words)
        assert r.lm.base_score == pytest.approx(base, rel=1e-9)
        if len(words) < 500:
            history = ["<>"] * (order - 1) + words
            score = sum(math.log10(probability(history[i : i + order - 1], w, vocabulary)) for i, w in enumerate(words))
            assert r.lm.score == pytest.approx(score, rel=1e-9)
            checked += 1
    assert checked > 40


def test_a_task_keeps_all_its_dealt_rows(spark, monkeypatch):
    monkeypatch.setattr(language_model, "COUNTED", 500)
    monkeypatch.setattr(language_model, "BUCKET_BYTES", 1 << 11)
    texts = [" ".join(f"w{(i * 37 + k * k) % 4001}" for k in range(300)) for i in range(60)]
    rows = spark.createDataFrame([(t,) for t in texts], "text string").coalesce(1)
    model = language_model.train(rows)
    counts = collections.Counter(w for t in texts for w in tokens(t))
    # far more than the 64 rows that go out at a time
    assert model.bits >= 5
    assert (model.tokens, model.vocabulary) == (sum(counts.values()), len(counts))


def test_two_words_before_count(spark):
    # which word follows "b" is known from the word before it alone
    texts = [f"{first} b {last} z{i}" for i in range(30) for first, last in (("a", "c"), ("d", "e"))]
    model = language_model.train(spark.createDataFrame([(t,) for t in texts], "text string"))
    asked = spark.createDataFrame([(1, "a b c"), (2, "a b e")], "id int, text string")
    found = {r.id: r.lm.score for r in asked.select("id", language_model.score(F.col("text"), model).alias("lm")).collect()}
    assert found[1] > found[2] + 0.5


def test_probabilities_sum_to_one(docs):
    texts = [t for _, t, _ in samples.texts()[:40]]
    probability = slow_model(texts, 2)
    words = {w for t in texts for w in tokens(t)}
    for history in (["<>"], [tokens(texts[0])[3]], ["never seen"]):
        total = sum(probability(history, w, len(words)) for w in words) + probability(history, "unknown", len(words))
        assert total == pytest.approx(1)


def test_nothing_to_learn_or_score(spark, no_docs):
    assert language_model.scored_documents(no_docs).count() == 0
    model = language_model.train(no_docs)
    scored = samples.documents(spark).select(language_model.score(F.col("text"), model).alias("lm")).collect()
    assert all(r.lm.n_known == 0 and r.lm.score == 0 for r in scored)
