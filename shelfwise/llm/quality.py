"""Quality rules: counts over words and lines, and compression bands.

Text that repeats itself compresses too well, noise too badly. The whole text and each fixed chunk of it
are compressed with zstandard; the ratio must lie in the band for that length, since short texts always
compress less. A document is rejected if the whole is out of band, or more than a share of its bytes lies in
chunks that are.

Cases: a null or empty text has no words, fails the base rules and is not kept; null ids, ties, repeated
rows and further columns do not matter, since the verdict is a function of the text alone; an empty table
gives no rows; texts of any length are read whole.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, functions as F

# (bytes from, least ratio, greatest ratio): plain prose at level 3 stays well inside.
BANDS = (
    (0, 0.5, 2.0),
    (128, 0.85, 2.6),
    (256, 1.05, 3.0),
    (512, 1.15, 3.4),
    (1024, 1.25, 3.8),
    (4096, 1.4, 4.5),
    (16384, 1.5, 5.5),
    (65536, 1.6, 6.5),
)
LEVEL = 3
CHUNK_BYTES = 4096
BAD_CHUNK_SHARE = 0.25

MIN_WORDS = 20
WINDOW = 8
MAX_REPEAT_PERCENT = 30
SYMBOLS = "#*$%&|<>"
SPACES = " \t\n\x0b\x0c\r"

SIGNALS = (
    "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean,"
    " ratio double, bad_chunk_share double, kept boolean"
)


def repeated_words(words: list[bytes], window: int = WINDOW) -> int:
    """Words inside a window of words that occurs twice or more in the text."""
    import numpy as np

    if len(words) <= window:
        return 0
    numbers: dict[bytes, int] = {}
    ids = np.array([numbers.setdefault(w, len(numbers)) for w in words], dtype=np.uint64)
    starts = len(ids) - window + 1
    # Windows with unlike hashes differ; only texts with equal hashes need the exact comparison.
    mixed = (ids + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
    mixed ^= mixed >> np.uint64(29)
    hashes = np.zeros(starts, dtype=np.uint64)
    for k in range(window):
        hashes = hashes * np.uint64(0xD6E8FEB86659FD93) + mixed[k : k + starts]
    hashes.sort()
    if not (hashes[1:] == hashes[:-1]).any():
        return 0
    places: dict[bytes, list[int]] = {}
    flat, width = ids.astype("<u4").tobytes(), 4
    for i in range(starts):
        places.setdefault(flat[i * width : (i + window) * width], []).append(i)
    covered = np.zeros(len(ids) + 1, dtype=np.int64)
    for found in places.values():
        if len(found) > 1:
            np.add.at(covered, found, 1)
            np.add.at(covered, np.array(found) + window, -1)
    return int((np.cumsum(covered) > 0).sum())


def band(n_bytes: int, bands: Sequence[tuple[int, float, float]]) -> tuple[float, float]:
    return next((low, high) for start, low, high in reversed(bands) if n_bytes >= start)


def compression(
    data: bytes, compress, bands: Sequence[tuple[int, float, float]] = BANDS, chunk: int = CHUNK_BYTES
) -> tuple[float, bool, float]:
    """Ratio of the whole, whether it is in its band, and the share of bytes in chunks out of theirs."""
    if not data:
        return 0.0, False, 0.0

    def judged(part: bytes) -> tuple[float, bool]:
        ratio = len(part) / len(compress(part))
        low, high = band(len(part), bands)
        return ratio, low <= ratio <= high

    ratio, fits = judged(data)
    if len(data) <= chunk:
        return ratio, fits, 0.0 if fits else 1.0
    parts = [data[i : i + chunk] for i in range(0, len(data), chunk)]
    return ratio, fits, sum(len(p) for p in parts if not judged(p)[1]) / len(data)


def quality(text: Column, bands: Sequence[tuple[int, float, float]] = BANDS) -> Column:
    """Struct of signals and the verdict ``kept`` for a text."""

    @F.pandas_udf(SIGNALS)
    def signals(texts):
        import pandas as pd
        import zstandard

        compress = zstandard.ZstdCompressor(level=LEVEL).compress
        rows = []
        for text in texts:
            text = text or ""
            data = text.encode()
            words = data.split()  # on the six ASCII spaces
            seen: set[str] = set()
            dup_lines = 0
            for line in text.split("\n"):
                if line in seen:
                    dup_lines += 1
                elif line.strip(SPACES):
                    seen.add(line)
            repeats = repeated_words(words)
            failed = len(words) < MIN_WORDS or 100 * repeats > MAX_REPEAT_PERCENT * len(words)
            ratio, fits, bad = compression(data, compress, bands)
            rows.append(
                (
                    len(words),
                    len(text) - sum(map(text.count, SPACES)),
                    sum(map(text.count, SYMBOLS)),
                    dup_lines,
                    repeats,
                    failed,
                    ratio,
                    bad,
                    not failed and fits and bad <= BAD_CHUNK_SHARE,
                )
            )
        names = [field.split()[0] for field in SIGNALS.split(",")]
        return pd.DataFrame(rows, columns=names)

    return signals(text)
