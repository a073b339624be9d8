"""Byte-level BPE against the tiktoken library."""

import hashlib
import random
import sys

import numpy as np
import public_tokenizers
import pytest
import regex
import samples
import tiktoken
from pyspark.sql import functions as F

from shelfwise.llm import byte_bpe

PATH = public_tokenizers.path("byte_bpe_50k.tiktoken")
ALPHABET = ["a", "b", "ll", "'", "'s", " ", "  ", "\n", "\t", "\x00", "\x1c", "\x85", " ", "é", "İ", "ß", "漢", "\U0001f600", "1", "½", ".", "!?", "<|endoftext|>"]


@pytest.fixture(scope="module")
def library():
    return tiktoken.Encoding("x", pat_str=public_tokenizers.PATTERN, mergeable_ranks=byte_bpe.ranks_of(PATH), special_tokens={})


def check(spark, library, texts, **sizes):
    docs = spark.createDataFrame([(i, t, "clash", "clash") for i, t in enumerate(texts)], "doc_id long, text string, ids string, part string")
    rows = byte_bpe.encode(docs, PATH, public_tokenizers.PATTERN, **sizes)
    rows = rows.withColumn("back", byte_bpe.decode(F.col("ids"), PATH)).withColumn("sha", byte_bpe.ids_sha256(F.col("ids"))).collect()
    assert sorted(r.doc_id for r in rows) == list(range(len(texts)))
    for r in rows:
        text = texts[r.doc_id] or ""
        assert list(r.ids) == library.encode_ordinary(text), repr(text[:80])
        assert bytes(r.back) == text.encode()
        assert r.sha == hashlib.sha256(np.array(r.ids, dtype="<u4").tobytes()).hexdigest()


def test_odd_texts(spark, library):
    check(spark, library, [t for _, t, _ in samples.texts()])


def test_short_chunks(spark, library):
    """Chunks of a few characters: every kind of boundary falls on a cut."""
    random_ = random.Random(4)
    texts = ["".join(random_.choices(ALPHABET, k=random_.randint(0, 300))) for _ in range(150)]
    for chunk, overlap in ((16, 12), (40, 9), (64, 40)):
        check(spark, library, texts, chunk=chunk, overlap=overlap)


def test_runs_longer_than_chunks(spark, library):
    """Nothing to meet at inside a run: its chunks become one."""
    texts = ["x " + "a" * 500 + " y", " " * 700, "\n" * 333 + "b", "7" * 129, "é" * 200 + "'" * 200, "a b " * 100 + "c" * 300 + " d" * 100 + "!" * 300]
    check(spark, library, texts, chunk=32, overlap=16)


def test_whole_chunks(spark, library):
    check(spark, library, [samples.prose(7, 20_000), "w" * (3 * byte_bpe.CHUNK) + samples.prose(8, 9_000), "x" * byte_bpe.CHUNK])


def test_the_pattern_splits_as_the_library_does(library):
    """A separate encoding of each match gives the same ids, whatever the character."""
    find = regex.compile(public_tokenizers.PATTERN).findall
    for start in range(0, sys.maxunicode + 1, 257):
        text = "".join(f"a{chr(c)}a 1{chr(c)}{chr(c)}  {chr(c)}." for c in range(start, min(start + 257, sys.maxunicode + 1)) if not 0xD800 <= c < 0xE000)
        assert [i for m in find(text) for i in library.encode_ordinary(m)] == library.encode_ordinary(text)


def test_unknown_ids_are_an_error(spark):
    rows = spark.createDataFrame([([70_000],)], "ids array<int>").select(byte_bpe.decode(F.col("ids"), PATH))
    with pytest.raises(Exception, match="70000"):
        rows.collect()


def test_null_ids(spark):
    rows = spark.createDataFrame([(None,), ([],)], "ids array<int>").select(byte_bpe.decode(F.col("ids"), PATH).alias("b"))
    assert [r.b for r in rows.collect()] == [None, bytearray()]


def test_nothing(no_docs):
    assert byte_bpe.encode(no_docs, PATH, public_tokenizers.PATTERN).count() == 0
