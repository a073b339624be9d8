"""Small documents with every kind of odd row, and the whole smallest test table."""

import os
import random

FOLDER = "/root/testdata/sf0.001"
HAVE_DATA = os.path.isdir(FOLDER)

# columns whose names operators use themselves
CLASHING = "doc mix text_hash gone lines key site plan copy kept n_words fp shard home slot part rank bin"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(
    f"`{c}` string" for c in CLASHING.split()
)


def prose(seed: int, words: int) -> str:
    random_ = random.Random(seed)
    syllables = "an be co de el fi ga ho in ka lo mi no or pe ra si to un ve".split()
    made = ["".join(random_.choices(syllables, k=random_.randint(1, 4))) for _ in range(words)]
    return " ".join(w + random_.choice(["", "", "", ",", ".", ".\n"]) for w in made)


def texts() -> list[tuple]:
    """(doc_id, text, source)"""
    shared = "One line that every site repeats below its pages."
    rows = [(i, f"{shared}\n{prose(i, 60 + i)}", f"site{i % 13}") for i in range(40)]
    rows += [
        (100, None, "site1"),
        (101, "", None),
        (102, " \n\t \x0b ", "site2"),
        (103, "word", None),
        (104, "two words", ""),
        (None, prose(1000, 40), "site3"),
        (None, None, None),
        (105, prose(1001, 30_000), "site4"),  # very long
        (106, "an " * 400, "site5"),  # repetitive
        (107, "Été ß İ \U0001f600 \x1c  x" * 20, "site6"),
        (108, prose(1002, 80), "site7"),
        (108, prose(1002, 80), "site7"),  # repeated row
        (108, prose(1003, 80), "site8"),  # repeated id
        (109, prose(1002, 80) + " end", "site9"),  # near copy
        (110, "a  b   c\n \nd\n\n e \n", "site9"),
        (111, "tab\t \there <|endoftext|> [INST] </s>", "site9"),
    ]
    return rows


def documents(spark, rows=None):
    filled = [(i, t, "en", s, len(t) if t else None, *["clash"] * len(CLASHING.split())) for i, t, s in rows or texts()]
    return spark.createDataFrame(filled, SCHEMA)


def no_documents(spark):
    return spark.createDataFrame([], SCHEMA)
