"""Sorted arrays of hashes against dictionaries, and the columns of dealt rows against themselves."""

import numpy as np
import pytest

from shelfwise.llm import hash_arrays, language_model


@pytest.mark.parametrize("bits", [0, 1, 4])
@pytest.mark.parametrize("n", [1, 2, 17, 5001])
def test_look_ups(tmp_path, bits, n):
    random = np.random.default_rng(n)
    key = np.unique(np.append(random.integers(0, 1 << 63, n, dtype=np.uint64) * np.uint64(2), np.uint64((1 << 64) - 1)))
    rare = np.where(random.random(len(key)) < 0.03, random.integers(15, 1 << 40, len(key)), random.integers(0, 15, len(key)))
    columns = [rare, random.integers(0, 1 << 33, len(key)), np.full(len(key), 15), np.zeros(len(key), dtype=np.int64)]
    bucket = hash_arrays.bucket_of(key, bits)
    for b in np.unique(bucket):
        rows = bucket == b
        hash_arrays.write(tmp_path.as_uri(), int(b), bits, key[rows], [c[rows] for c in columns])
    # odd ones, but for the greatest, are not there
    asked = random.permutation(np.concatenate([key, key, key[:-1] + np.uint64(1 << 24)]))
    known = dict(zip(key.tolist(), zip(*[c.tolist() for c in columns], strict=True), strict=True))
    found = hash_arrays.Arrays(tmp_path.as_uri(), bits, 4).find(asked)
    assert [tuple(x) for x in found.T.tolist()] == [known.get(k, (0, 0, 0, 0)) for k in asked.tolist()]


def test_nothing_written_or_asked(tmp_path):
    arrays = hash_arrays.Arrays(tmp_path.as_uri(), 2, 1)
    assert arrays.find(np.array([5, 1 << 63], dtype=np.uint64)).tolist() == [[0, 0]]
    assert arrays.find(np.zeros(0, dtype=np.uint64)).shape == (1, 0)


def test_dealt_rows_come_back():
    random = np.random.default_rng(3)
    first = np.sort(random.integers(0, 1 << 40, 900))
    columns, counts = [first, random.integers(0, 300, 900)], [random.integers(1, 70000, 900)]
    key = language_model.whole(columns)
    back = []
    for level, bucket, data in language_model.deal("g2", 3, key, columns, counts):
        words, (n,) = language_model.dealt(data, 2)
        assert level == "g2" and set(hash_arrays.bucket_of(language_model.whole(words), 3)) == {bucket}
        back += zip(*[c.tolist() for c in (*words, n)], strict=True)
    assert sorted(back) == sorted(zip(*[c.tolist() for c in (*columns, *counts)], strict=True))


@pytest.mark.parametrize("base", [50, 1 << 22, 1 << 31])
def test_distinct_rows(base):
    random = np.random.default_rng(base)
    columns = [random.integers(0, 40, 3000) * (base // 40) for _ in range(3)]
    columns[2] = columns[2] % (base // 40 * 3 + 1)
    found, n = language_model.distinct_rows(columns, base)
    rows, expected = np.unique(np.stack(columns, axis=1), axis=0, return_counts=True)
    assert np.array_equal(np.stack(found, axis=1), rows) and np.array_equal(n, expected)
