"""Token ids of whole texts with a tokenizers file, in Arrow batches.

Both tokenizers used here break a text before a blank, and between a letter and a sign, before they merge. So
the ids of a text are the ids of its pieces between blanks one after another. Arrow cuts a batch of texts into
pieces and finds the distinct ones; each worker remembers the ids of pieces it met lately and asks the tokenizers
library for the others only; numpy puts the ids of all texts together.
"""

from __future__ import annotations

import os
import re
import struct
from collections.abc import Iterable, Iterator

# Bytes of text worked on at a time.
CHUNK_BYTES = 8 << 20
# Words remembered by a worker: two generations of this many.
REMEMBERED = 300_000

# A segment is a run without blanks and line feeds, cut where a stop or a sign follows letters. A tokenizer that
# encodes white space gets it at the start of the segment. The last of the letters is a Latin one: others may become
# a letter and a mark in the tokenizer's own spelling (a dotted capital I in small letters), and marks stay with signs.
_SIGNS = ".,;:!?#$%&*"
_LATIN = r"[A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff]"
_RUN = rf"(?:[^\W\d_]+(?<={_LATIN})(?=[{_SIGNS}])|[^ \n]+)"
_WITH_BLANKS = re.compile(rf"[ \n]*{_RUN}|[ \n]+").findall
_WITHOUT_BLANKS = re.compile(_RUN).findall
_OTHER_SPACE = re.compile(r"[^\S \n]").search
# A run of white space that the tokenizer would cut elsewhere than before its last blank.
_BLANK_RUN = re.compile(r"\s (?:\s|\Z)").search
# One word of Latin letters: nothing to normalise or split, so the merges alone are asked for.
_LETTERS = rf"{_LATIN}+"
_PLAIN_WORD = re.compile(_LETTERS).fullmatch
_WORD_AND_SIGNS = re.compile(rf"({_LETTERS})([{_SIGNS}]+)").fullmatch
# Byte-level vocabularies write a byte without a printable Latin-1 character as one from 256 on, in order.
_PRINTABLE = {*range(33, 127), *range(161, 173), *range(174, 256)}
_HIDDEN = [b for b in range(256) if b not in _PRINTABLE]
_BYTE_LETTERS = {b: 256 + i for i, b in enumerate(_HIDDEN)}


class TextEncoder:
    """Ids as little-endian unsigned 32-bit bytes.

    ``keeps_blanks`` says that the tokenizer encodes white space. It then joins blanks with white space before
    them, so the few texts with such runs are encoded in one go.
    """

    def __init__(self, path: str, keeps_blanks: bool) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs a task per core already
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.merge = self.tokenizer.model.tokenize
        self.keeps_blanks = keeps_blanks
        self.segments = _WITH_BLANKS if keeps_blanks else _WITHOUT_BLANKS
        self.blank = chr(_BYTE_LETTERS[32]) if keeps_blanks else ""
        self.signs = {sign: self._ask(sign) for sign in _SIGNS}
        # words by themselves, that is after a blank; segments as they stand, apart from the words
        self.recent: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.recent_segments: dict[str, bytes] = {}
        self.older_segments: dict[str, bytes] = {}

    def _ask(self, text: str) -> bytes:
        ids = self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids
        return struct.pack(f"<{len(ids)}I", *ids)

    def _cut(self, text: str) -> bytes:
        """A text without runs of white space that its segments would break."""
        if self.keeps_blanks and _OTHER_SPACE(text):
            return self._ask(text)
        return b"".join([self._segment(x) for x in self.segments(text)])

    def _segment(self, segment: str) -> bytes:
        start = 1 if self.keeps_blanks and segment[0] == " " else 0
        if start == self.keeps_blanks and _PLAIN_WORD(segment, start):
            word = segment[start:]
            ids = self.recent.get(word)
            return self._word(word) if ids is None else ids
        if (ids := self.signs.get(segment)) is not None:
            return ids
        if (ids := self.recent_segments.get(segment)) is None:
            if (ids := self.older_segments.get(segment)) is None:
                ids = self._ask(segment)
            if len(self.recent_segments) >= REMEMBERED:
                self.older_segments, self.recent_segments = self.recent_segments, {}
            self.recent_segments[segment] = ids
        return ids

    def _word(self, word: str) -> bytes:
        """Ids of a plain word with the blank before it, which is not among the recent ones."""
        if (ids := self.older.get(word)) is None:
            cased = word if self.keeps_blanks else word.lower()
            written = cased if cased.isascii() else cased.encode().decode("latin-1").translate(_BYTE_LETTERS)
            found = [x.id for x in self.merge(self.blank + written)]
            ids = struct.pack(f"<{len(found)}I", *found)
        if len(self.recent) >= REMEMBERED:
            self.older, self.recent = self.recent, {}
        self.recent[word] = ids
        return ids

    def _piece(self, piece: str) -> bytes:
        """Ids of a piece with the blank before it."""
        if _PLAIN_WORD(piece):
            return self._word(piece)
        if found := _WORD_AND_SIGNS(piece):
            word, tail = found.groups()
            ids = self.recent.get(word)
            signs = self.signs.get(tail)
            return (self._word(word) if ids is None else ids) + (self._segment(tail) if signs is None else signs)
        return self._cut(" " + piece)

    def encode(self, texts):
        """Ids of an Arrow array of texts one after another, and how many each text has."""
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc

        plain = texts.to_pylist()
        whole = [i for i, x in enumerate(plain) if self.keeps_blanks and _BLANK_RUN(x)]
        alone = {i: self._ask(plain[i]) for i in whole}
        if alone:
            texts = pa.array(["" if i in alone else x for i, x in enumerate(plain)], pa.string())
        cut = pc.split_pattern(texts, " ")
        starts = cut.offsets.to_numpy()
        known = pc.dictionary_encode(cut.flatten())
        # several times as fast as to_pylist
        pieces = known.dictionary.to_numpy(zero_copy_only=False).tolist()
        ids = [self._piece(x) if y is None else y for x, y in zip(pieces, map(self.recent.get, pieces), strict=True)]
        # the first piece of a text has no blank before it
        at = np.array(known.indices, dtype=np.int64)
        first = starts[:-1] - starts[0]
        heads = [alone[i] if i in alone else self._cut(pieces[k]) for i, k in enumerate(at[first])]
        at[first] = len(ids) + np.arange(len(first))
        ids += heads

        lengths = np.fromiter(map(len, ids), dtype=np.int64, count=len(ids)) // 4
        flat = np.frombuffer(b"".join(ids), dtype="<u4")
        taken = lengths[at]
        ends = np.cumsum(taken)
        # where each id of the result stands among those of the distinct pieces
        source = np.repeat(((np.cumsum(lengths) - lengths)[at] - ends + taken).astype(np.int32), taken)
        source += np.arange(len(source), dtype=np.int32)
        return flat[source], np.add.reduceat(taken, first)


_encoders: dict[tuple[str, bool], TextEncoder] = {}


def encoder(path: str, keeps_blanks: bool) -> TextEncoder:
    """The worker's encoder of a file; loaded once per Python worker."""
    if (path, keeps_blanks) not in _encoders:
        _encoders[path, keeps_blanks] = TextEncoder(path, keeps_blanks)
    return _encoders[path, keeps_blanks]


def forget_words() -> None:
    """Give the memory of the worker's encoders back."""
    _encoders.clear()


def encoded(batches: Iterable, path: str, keeps_blanks: bool, end_id: int) -> Iterator[tuple]:
    """(rows, ids, counts) of Arrow batches whose second column is the text, in slices; a null text is empty.

    ``end_id`` is the last id of every text.
    """
    import numpy as np
    import pyarrow.compute as pc

    encode = encoder(path, keeps_blanks).encode
    for batch in batches:
        texts = pc.fill_null(batch.column(1), "")
        held = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False).astype(np.int64))
        start = 0
        while start < len(texts):
            before = held[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(held, before + CHUNK_BYTES, side="right")))
            ids, counts = encode(texts.slice(start, stop - start))
            yield batch.slice(start, stop - start), np.insert(ids, np.cumsum(counts), end_id), counts + 1
            start = stop
