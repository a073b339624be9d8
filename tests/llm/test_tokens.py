"""Token ids, packing and token files against the tokenizers library."""

import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import samples
from tokenizers import Tokenizer

from shelfwise.llm import packing, token_files
from shelfwise.llm.text_ids import TextEncoder, encoded

FILES = [("byte_bpe_50k.json", True), ("word_bpe_49k.json", False)]
SPACES = [
    "", " ", "  ", "a  b", "a   b", " a", "a ", "a  ", "foo\n \nbar", "foo\n\n bar\n ", "x  y  z", "\n a", "  \n",
    "a \n\n  b\tc\t \td", "\t b", "it's IT'S don't 12 ½ x².", "café é ́ x",
    "<|startoftext|> x<|endoftext|> .", "ΑΣ Σ\x1c!\x1c a", "İstanbul ẞß", "foo!! ...bar. ,baz ###",
]


@pytest.mark.parametrize("name, keeps_blanks", FILES)
def test_same_ids_as_whole_texts(name, keeps_blanks):
    path = public_tokenizers.path(name)
    library, ours = Tokenizer.from_file(path), TextEncoder(path, keeps_blanks)
    texts = SPACES + [t or "" for _, t, _ in samples.texts()]
    for batch in (texts, texts[::-1], *[[x] for x in texts]):  # then from memory, then alone
        check(library, ours, batch)


def check(library, ours, texts):
    ids, counts = ours.encode(pa.array(texts, pa.string()))
    expected = [library.encode(x, add_special_tokens=False).ids for x in texts]
    assert counts.tolist() == [len(x) for x in expected]
    assert ids.tolist() == [i for x in expected for i in x]


def test_generations_forget(monkeypatch):
    monkeypatch.setattr("shelfwise.llm.text_ids.REMEMBERED", 3)
    path = public_tokenizers.path("byte_bpe_50k.json")
    library, ours = Tokenizer.from_file(path), TextEncoder(path, True)
    check(library, ours, [samples.prose(seed, 50) for seed in range(3)])


def test_slices_of_batches(monkeypatch):
    monkeypatch.setattr("shelfwise.llm.text_ids.CHUNK_BYTES", 100)
    path = public_tokenizers.path("byte_bpe_50k.json")
    texts = [None, *SPACES, samples.prose(1, 90), None, "", samples.prose(2, 3)]
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts))), pa.array(texts, pa.string())], ["doc_id", "text"])
    library, found, rows = Tokenizer.from_file(path), [], []
    for part, ids, counts in encoded([batch.slice(2), batch], path, True, 7):
        rows += part.column(0).to_pylist()
        at = 0
        for n in counts:
            found.append(ids[at : at + n].tolist())
            at += n
    order = [*range(2, len(texts)), *range(len(texts))]
    assert rows == order
    assert found == [[*library.encode(texts[i] or "", add_special_tokens=False).ids, 7] for i in order]


def whole(name, text, end):
    return [*Tokenizer.from_file(public_tokenizers.path(name)).encode(text or "", add_special_tokens=False).ids, end]


def test_packing(docs):
    pieces = packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"), sequence_length=128).collect()
    expected = sorted(whole("byte_bpe_50k.json", t, 0) for _, t, _ in samples.texts())
    # pieces of a document follow each other; equal documents are told apart by their sequences only
    by_doc: dict = {}
    for p in pieces:
        assert p.length == len(p.ids) and 1 <= p.length <= 128
        by_doc.setdefault((p.doc_id, p.doc_tokens), {}).setdefault(p.start, []).append(list(p.ids))
    rebuilt = []
    for starts in by_doc.values():
        for copies in zip(*[starts[s] for s in sorted(starts)], strict=True):
            rebuilt.append([i for part in copies for i in part])
    assert sorted(rebuilt) == expected
    sequences: dict = {}
    for p in pieces:
        sequences.setdefault(p.sequence_id, []).append((p.offset, p.length))
    assert sorted(sequences) == list(range(len(sequences)))
    for places in sequences.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 128
    assert sum(p.length for p in pieces) / (128 * len(sequences)) > 0.9


def test_shortest_pack_first_covers_the_histogram():
    histogram = {7: 5, 6: 1, 5: 4, 3: 9, 2: 2, 1: 30, 10: 3}
    patterns = packing.plan_packs(histogram, 10)
    placed: dict = {}
    for packs, lengths in patterns:
        assert sum(lengths) <= 10
        for length in lengths:
            placed[length] = placed.get(length, 0) + packs
    assert placed == histogram
    # the emptiest pack takes a piece: sevens are filled before tens are opened anew
    assert sum(packs for packs, _ in patterns) <= 16


def test_packing_nothing(no_docs):
    assert packing.pack(no_docs, public_tokenizers.path("byte_bpe_50k.json")).count() == 0


def test_token_files(spark, docs, tmp_path):
    folder = f"file://{tmp_path}/ids"
    token_files.write_ids(docs, folder, public_tokenizers.path("word_bpe_49k.json"))
    rows = token_files.read_ids(spark, folder).withColumn("crc", token_files.ids_crc32("ids")).collect()
    rows = sorted(rows, key=lambda r: r.start)
    ids = [r.doc_id for r in rows]
    assert ids == sorted(ids, key=lambda i: (i is not None, i or 0))
    at = 0
    for r in rows:
        assert r.start == at and r.n_tokens == len(r.ids)
        assert r.crc == zlib.crc32(np.array(r.ids, dtype="<u4").tobytes())
        at += r.n_tokens
    expected = sorted(((i or -1), whole("word_bpe_49k.json", t, 1)) for i, t, _ in samples.texts())
    assert sorted(((r.doc_id or -1), list(r.ids)) for r in rows) == expected


def test_token_files_carry_index_and_bloom_filter(docs, tmp_path):
    from pyarrow import orc

    token_files.write_ids(docs, f"file://{tmp_path}/ids", public_tokenizers.path("word_bpe_49k.json"))
    file = orc.ORCFile(next(p for p in (tmp_path / "ids").glob("*.orc")))
    assert file.row_index_stride == 1000 and file.compression == "ZSTD"


def test_token_files_of_nothing(no_docs):
    assert token_files.token_table(no_docs, public_tokenizers.path("word_bpe_49k.json")).count() == 0


@pytest.mark.parametrize("name, keeps_blanks", FILES)
def test_fuzzed_texts(name, keeps_blanks):
    """Control characters, letters whose small form is longer, marks, signs and blanks in any order, from memory too."""
    random_ = random.Random(11)
    path = public_tokenizers.path(name)
    library, ours = Tokenizer.from_file(path), TextEncoder(path, keeps_blanks)
    letters = "\0 \x01 \x1c \x7f \x85   ́ ̇ ​ क़ ྲ שׁ İ I i ẞ ß Σ ς Ω Å K ǅ ﬁ é e a b 1 ½ . , ! # ' & * _ - 漢 \U0001f600".split(" ")
    letters += [" ", " ", " ", "\n", "the", "'s", "."]
    for _ in range(300):
        check(library, ours, ["".join(random_.choices(letters, k=random_.randint(1, 12))) for _ in range(60)])


@pytest.mark.parametrize("text", [" \0Ω", "Ω \0Ω", "İ.", "aİ. İ.b", "क़. x", "\0a \0a. a"])
def test_control_characters_and_marks(text):
    for name, keeps_blanks in FILES:
        path = public_tokenizers.path(name)
        library, ours = Tokenizer.from_file(path), TextEncoder(path, keeps_blanks)
        check(library, ours, ["a Ω \0Ω Ω", text, text + text])
