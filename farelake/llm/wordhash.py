"""Words of Arrow text columns as arrays of 64-bit hashes, inside of tasks."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash

#: Words whose hashes a worker remembers; further ones are hashed each time.
REMEMBERED = 500_000


class _Hashes(dict):
    def __missing__(self, word: bytes) -> int:
        value = xxhash.xxh3_64_intdigest(word)
        if len(self) < REMEMBERED:
            self[word] = value
        return value


_HASHES = _Hashes()


def word_hashes(text: bytes | None) -> np.ndarray:
    """Hash of each word. bytes.split() splits at space and the control characters from tab to carriage return."""
    found = text.split() if text else []
    return np.fromiter(map(_HASHES.__getitem__, found), np.uint64, len(found))


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective scrambling of 64-bit values (finaliser of a public hash)."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def constants(n: int, seed: int) -> np.ndarray:
    """``n`` odd 64-bit multipliers."""
    return np.random.default_rng(seed).integers(0, 2**64 - 1, n, np.uint64, endpoint=True) | np.uint64(1)


def texts(column: pa.Array) -> list[bytes | None]:
    return column.cast(pa.binary()).to_pylist()


def slices(batches: Iterator[pa.RecordBatch], rows: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)
