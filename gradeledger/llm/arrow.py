"""Small helpers for functions that run on Arrow batches inside tasks."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from xxhash import xxh3_64_intdigest

#: Odd multipliers of the mixing steps.
MIX_A, MIX_B = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9)


def raw_texts(batch: pa.RecordBatch, name: str) -> list[bytes | None]:
    """A text column as UTF-8 bytes, without decoding."""
    return batch.column(name).cast(pa.binary()).to_pylist()


def list_column(rows: Sequence[np.ndarray], dtype=np.int64) -> pa.ListArray:
    """One list per array."""
    ends = np.zeros(len(rows) + 1, np.int32)
    np.cumsum([len(r) for r in rows], out=ends[1:])
    values = np.concatenate(rows) if rows else np.zeros(0, dtype)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(values.astype(dtype, copy=False)))


def list_rows(batch: pa.RecordBatch, name: str) -> list[np.ndarray]:
    """The arrays of a list column of numbers; null gives an empty one."""
    column = batch.column(name)
    values, offsets = column.values.to_numpy(zero_copy_only=False), column.offsets.to_numpy()
    return [values[offsets[i] : offsets[i + 1]] for i in range(len(column))]


def mix(x: np.ndarray) -> np.ndarray:
    """Spreads the bits of 64-bit integers."""
    x = (x ^ (x >> np.uint64(30))) * MIX_B
    x = (x ^ (x >> np.uint64(27))) * MIX_A
    return x ^ (x >> np.uint64(31))


def word_hashes(words: Sequence[bytes]) -> np.ndarray:
    return np.fromiter(map(xxh3_64_intdigest, words), np.uint64, len(words))


def shingle_hashes(raw: bytes | None, width: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the runs of ``width`` words, A-Z lower-cased.

    Words are separated by space and the five ASCII control spaces, which is what
    ``bytes.split`` separates by. A text with fewer words is one run; without words, none.
    """
    words = raw.lower().split() if raw else []
    if not words:
        return np.zeros(0, np.int64)
    hashes = word_hashes(words)
    runs = max(len(words) - width + 1, 1)
    out = np.full(runs, min(len(words), width), np.uint64)
    for i in range(min(len(words), width)):
        out = mix(out + MIX_A) + hashes[i : i + runs]
    return np.unique(mix(out).view(np.int64))
