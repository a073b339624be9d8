"""Finds known licences by digests of canonical texts.

Texts that differ in case, punctuation, white space, copyright statements or equivalent spellings have one canonical text. Its
digest is looked up by a hash join among those of known licences: for the entire text of a document, and for each of its
lines as a text of its own, since a sentence that names a licence stands on a line.

Cases: a null or empty text, and one of copyright statements alone, has no digest and matches nothing; a null doc_id is
carried; rows equal in doc_id and text share their notices; a licence that is known under several texts, or
twice, is named once, the least id where digests are equal; very long texts are canonicalised whole and line by line;
an empty table gives no rows; further columns do not matter.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from shelfwise.llm.license_texts import NAMED, SENTENCES, TEXTS

# Statements whose a text is, not what is allowed: mark or year, then the holder up to the end of the sentence (not of an
# initial or a company's form), the words a licence opens with, or the end of the line. Inside a line a year is needed.
COPYRIGHT = (
    r"(?m)(?:^[ \t#*/;-]*(?:copyright[ \t:]*(?:\(c\)|©|by |\d{4})|(?:\(c\)|©)[ \t]*\d{4})"
    r"|\bcopyright[ \t:]*(?:(?:\(c\)|©)[ \t]*)?\d{4}|(?:\(c\)|©)[ \t]*\d{4})"
    r"[^\n]*?(?:(?<![\s.]\p{L})(?<!\b(?:inc|ltd|co|corp|jr|sr|st|dr|al))[.;!?](?=\s|\z)|(?=\n|\z)"
    r"|(?=\b(?:permission (?:is|to)|redistribution and use|(?:licen[cs]ed|released|distributed) under"
    r"|this (?:work|software|project|program|library|file|source code|is)|everyone is permitted|spdx-license-identifier"
    r"|all rights reserved|copyright[ \t:]*(?:\(c\)|©|\d{4}))))"
    r"|\ball rights reserved\b"
)
# One of them is in every text with such a statement.
COPYRIGHT_MARKS = ("copyright", "(c)", "©", "all rights reserved")
NO_LETTERS = r"[^\p{L}\p{N}]+"
# Equivalent spellings, on text in lower case with single blanks; the right one stands. Fixed values.
SPELLINGS = (
    ("licence", "license"),
    ("sub license", "sublicense"),
    ("non commercial", "noncommercial"),
    ("non infringement", "noninfringement"),
    ("merchantibility", "merchantability"),
    ("organisation", "organization"),
    ("recognise", "recognize"),
    ("favour", "favor"),
    ("wilful", "willful"),
    ("whilst", "while"),
    ("per cent", "percent"),
    ("copyright owner", "copyright holder"),
)


def canonical(text: Column) -> Column:
    lower = F.lower(text)
    marked = reduce(Column.__or__, [F.contains(lower, F.lit(mark)) for mark in COPYRIGHT_MARKS])
    bare = F.when(marked, F.regexp_replace(lower, COPYRIGHT, " ")).otherwise(lower)
    words = F.trim(F.regexp_replace(bare, NO_LETTERS, " "))
    for other, usual in SPELLINGS:
        words = F.replace(words, F.lit(other), F.lit(usual))
    return words


def digest(text: Column) -> Column:
    """Null where nothing is left of the text."""
    words = canonical(text)
    return F.when(words != "", F.md5(words))


def known_licenses(spark: SparkSession) -> DataFrame:
    """license_id, text: a few hundred rows."""
    sentences = [(i, sentence.format(name)) for i, name in NAMED for sentence in SENTENCES]
    return spark.createDataFrame([*TEXTS, *sentences], "license_id string, text string")


def scan(docs: DataFrame, licenses: DataFrame) -> DataFrame:
    """The rows as ``doc``, ``digest``, ``license_id`` of the entire text, and sorted ``notices`` of its lines."""
    known = licenses.select(digest(F.col("text")).alias("digest"), "license_id").where("digest is not null")
    known = known.groupBy("digest").agg(F.min("license_id").alias("license_id"))
    rows = docs.select(F.struct("*").alias("doc"), F.xxhash64("text").alias("text_hash"), digest(F.col("text")).alias("digest"))
    lines = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), F.explode(F.split("text", "\n")).alias("line"))
    notices = (
        lines.select("doc_id", "text_hash", digest(F.col("line")).alias("digest"))
        .join(known.withColumnRenamed("license_id", "notice"), "digest")
        .groupBy("doc_id", "text_hash")
        .agg(F.array_sort(F.collect_set("notice")).alias("notices"))
        .withColumnRenamed("doc_id", "_doc_id")
    )
    return (
        rows.join(known, "digest", "left")
        .join(notices, F.col("doc.doc_id").eqNullSafe(F.col("_doc_id")) & (rows["text_hash"] == notices["text_hash"]), "left")
        .select("doc", "digest", "license_id", "notices")
    )
