"""Sorted arrays of hashes with numbers beside them, one file per bucket, searched through memory maps.

A bucket is named by the leading bits of its hashes. A file lists where each of the next bits starts and keeps the 40
bits after those, about 5 bytes a hash. Numbers below 15 take half a byte, the few others are listed apart; a column of
mostly larger ones is kept as it is. Two hashes that agree in all bits kept count as one: for a bucket of 2 million that
is 58 bits beside the bucket's.
"""

from __future__ import annotations

from shelfwise.llm.shared_files import mapped, write_once

TAIL, LARGE = 40, 15


def bucket_of(key, bits: int):
    import numpy as np

    return (key >> np.uint64(64 - bits)).astype(np.int64) if bits else np.zeros(len(key), dtype=np.int64)


def width(numbers) -> int:
    """Bytes of the largest number."""
    most = int(numbers.max()) if len(numbers) else 0
    return next(w for w in (1, 2, 4, 8) if w == 8 or most < 1 << 8 * w)


def _split(key, bits: int, index: int) -> tuple:
    """The index bits and the tail after the bucket's bits."""
    import numpy as np

    rest = key << np.uint64(bits)
    prefix = rest >> np.uint64(64 - index) if index else np.zeros_like(rest)
    return prefix.astype(np.int64), (rest << np.uint64(index)) >> np.uint64(64 - TAIL)


def write(folder: str, bucket: int, bits: int, key, columns: list) -> None:
    """``key`` ascends and lies in the bucket; each column has a number per key."""
    import numpy as np

    n = len(key)
    index = max(n.bit_length() - 3, 0)
    prefix, tail = _split(key, bits, index)
    starts = np.searchsorted(prefix, np.arange((1 << index) + 1))
    head, parts = [n, index], [starts.astype("<u4"), (tail >> np.uint64(8)).astype("<u4"), tail.astype(np.uint8)]
    for column in columns:
        large = np.flatnonzero(column >= LARGE)
        if len(large) * 16 > n:
            head += [width(column), 0]
            parts.append(column.astype(f"<u{width(column)}"))
            continue
        head += [0, len(large)]
        halves = np.minimum(column, LARGE).astype(np.uint8)
        if n % 2:
            halves = np.append(halves, np.uint8(0))
        parts += [large.astype("<u4"), column[large].astype("<u8"), halves[::2] | halves[1::2] << 4]
    data = [np.array([len(columns), *head], dtype="<i8").tobytes(), *[p.tobytes() for p in parts]]
    write_once(folder, str(bucket), [x + bytes(-len(x) % 8) for x in data])


class Bucket:
    """One file."""

    def __init__(self, data, bits: int) -> None:
        import numpy as np

        values = int(data[:8].view("<i8")[0])
        head = data[8 : 24 + 16 * values].view("<i8").tolist()
        self.n, self.index, self.bits = head[0], head[1], bits
        at = 24 + 16 * values

        def part(kind: str, size: int):
            nonlocal at
            stop = at + np.dtype(kind).itemsize * size
            found, at = data[at:stop].view(kind), stop + -stop % 8
            return found

        self.starts = part("<u4", (1 << self.index) + 1)
        self.high, self.low = part("<u4", self.n), part("u1", self.n)
        self.columns: list[tuple] = []
        for size, large in zip(head[2::2], head[3::2], strict=True):
            if size:
                self.columns.append((part(f"<u{size}", self.n),))
            else:
                self.columns.append((part("<u4", large), part("<u8", large), part("u1", (self.n + 1) // 2)))

    def places(self, keys) -> tuple:
        """Where each key is, or would be, and whether it is there."""
        import numpy as np

        prefix, tail = _split(keys, self.bits, self.index)
        tail_at = lambda at: (self.high[at].astype(np.uint64) << np.uint64(8)) | self.low[at]
        low = self.starts[prefix].astype(np.int64)
        end = high = self.starts[prefix + 1].astype(np.int64)
        for _ in range(int((high - low).max()).bit_length()):
            middle = np.minimum((low + high) >> 1, self.n - 1)
            less = tail_at(middle) < tail
            searched = low < high
            low, high = np.where(searched & less, middle + 1, low), np.where(searched & ~less, middle, high)
        at = np.minimum(low, self.n - 1)
        return at, (low < end) & (tail_at(at) == tail)

    def numbers(self, value: int, at):
        import numpy as np

        if len(self.columns[value]) == 1:
            return self.columns[value][0][at].astype(np.int64)
        large, most, halves = self.columns[value]
        found = (halves[at >> 1] >> (at & 1) * 4 & 15).astype(np.int64)
        more = np.flatnonzero(found == LARGE)
        found[more] = most[np.searchsorted(large, at[more])]
        return found


class Arrays:
    """All buckets of a folder, each mapped when first asked for."""

    def __init__(self, folder: str, bits: int, values: int) -> None:
        self.folder, self.bits, self.values = folder, bits, values
        self.buckets: dict[int, Bucket | None] = {}

    def _bucket(self, bucket: int) -> Bucket | None:
        import numpy as np

        if bucket not in self.buckets:
            data = mapped(self.folder, str(bucket))
            self.buckets[bucket] = None if data is None else Bucket(data.view(np.ndarray), self.bits)
        return self.buckets[bucket]

    def find(self, keys):
        """A row of numbers per column for the keys, 0 where there is none."""
        import numpy as np

        order = np.argsort(keys)
        ordered = keys[order]
        found = np.zeros((self.values, len(keys)), dtype=np.int64)
        buckets, starts = np.unique(bucket_of(ordered, self.bits), return_index=True)
        for bucket, lo, hi in zip(buckets.tolist(), starts, np.append(starts, len(keys))[1:], strict=True):
            if file := self._bucket(bucket):
                at, hit = file.places(ordered[lo:hi])
                at, to = at[hit], order[lo:hi][hit]
                for value in range(self.values):
                    found[value, to] = file.numbers(value, at)
        return found
