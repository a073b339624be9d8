"""Quality rules against plain Python."""

import re

import pytest
import samples
from pyspark.sql import functions as F

from shelfwise.llm import quality

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def slow_repeats(words, window=8):
    places = {}
    for i in range(len(words) - window + 1):
        places.setdefault(tuple(words[i : i + window]), []).append(i)
    return len({i + k for found in places.values() if len(found) > 1 for i in found for k in range(window)})


def slow(text):
    text = text or ""
    words = WORD.findall(text)
    lines = text.split("\n")
    dups = sum(bool(WORD.search(x)) and x in lines[:i] for i, x in enumerate(lines))
    repeats = slow_repeats(words)
    return {
        "n_words": len(words),
        "word_chars": sum(map(len, words)),
        "n_symbols": sum(c in "#*$%&|<>" for c in text),
        "n_dup_lines": dups,
        "n_repeat_words": repeats,
        "base_failed": len(words) < 20 or 100 * repeats > 30 * len(words),
    }


def test_signals(docs):
    rows = docs.select("text", quality.quality(F.col("text")).alias("q")).collect()
    assert len(rows) == len(samples.texts())
    for row in rows:
        got, expected = row.q.asDict(), slow(row.text)
        assert {k: got[k] for k in expected} == expected
        assert not (got["kept"] and got["base_failed"])


@pytest.mark.parametrize("words", [["a"] * 9, list("abcdefgh") * 2, list("abcdefgh"), ["x", "y"] * 30 + list("abc"), []])
def test_repeated_words(words):
    assert quality.repeated_words([w.encode() for w in words]) == slow_repeats(words)


def test_bands(spark):
    import random

    noise = "".join(random.Random(1).choices([chr(c) for c in range(0x4E00, 0x9FFF)], k=3000))
    spaced = " ".join(noise[i : i + 5] for i in range(0, 3000, 5))
    rising = " ".join(f"w{i // 7}" for i in range(800))  # seven times each word, in no window twice
    good = samples.prose(5, 500)
    mixed = good + "\n" + "\n".join(samples.prose(k, 400) for k in range(3))
    rows = spark.createDataFrame([(1, good), (2, rising), (3, spaced), (4, mixed)], "id long, text string")
    kept = {r.id: r.q for r in rows.select("id", quality.quality(F.col("text")).alias("q")).collect()}
    assert kept[1].kept and kept[4].kept
    assert not kept[2].base_failed and not kept[2].kept and kept[2].ratio > 3.8
    assert not kept[3].base_failed and not kept[3].kept and kept[3].ratio < 1.4


def test_chunks_are_judged(spark):
    part = samples.prose(9, 3000)
    rising = " ".join(f"w{i // 7}" for i in range(4000))
    ratio, fits, bad = quality.compression((part + rising).encode(), __import__("zstandard").ZstdCompressor(3).compress)
    assert bad > quality.BAD_CHUNK_SHARE


def test_no_documents(no_docs):
    assert no_docs.select(quality.quality(F.col("text")).alias("q")).count() == 0
