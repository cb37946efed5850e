"""CRC-32C of many byte strings at once, and the mask that record files put over it.

The remainder is linear in the message, so each block of 64 bytes is looked up byte by byte
for all blocks together, and blocks are joined in pairs: the left one is shifted by the right
one's length with four tables, level by level.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import cache

import numpy as np

#: The reversed Castagnoli polynomial and the mask's summand.
POLYNOMIAL = 0x82F63B78
MASK_DELTA = 0xA282EAD8

BLOCK = 64
_ONES = np.uint32(0xFFFFFFFF)


def _byte_table() -> np.ndarray:
    """Remainder of each single byte."""
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & 1, (table >> 1) ^ np.uint32(POLYNOMIAL), table >> 1)
    return table


@cache
def _positions() -> np.ndarray:
    """[i, v]: remainder of byte v at place i of a block, zeros behind it."""
    one = _byte_table()
    tables = [one]
    for _ in range(BLOCK - 1):
        last = tables[-1]
        tables.append((last >> 8) ^ one[last & 0xFF])
    return np.stack(tables[::-1])


def _apply(tables: np.ndarray, x: np.ndarray) -> np.ndarray:
    return tables[0][x & 0xFF] ^ tables[1][(x >> 8) & 0xFF] ^ tables[2][(x >> 16) & 0xFF] ^ tables[3][x >> 24]


def _tables(images: np.ndarray) -> np.ndarray:
    """Four look-up tables of the linear map that sends bit i to ``images[i]``."""
    out = np.zeros((4, 256), np.uint32)
    values = np.arange(256)
    for i, image in enumerate(images):
        out[i // 8] ^= np.where(values >> (i % 8) & 1, image, np.uint32(0))
    return out


@cache
def _shift(level: int) -> np.ndarray:
    """Tables that shift a remainder by ``BLOCK * 2**level`` zero bytes."""
    bits = np.uint32(1) << np.arange(32, dtype=np.uint32)
    if level:
        half = _shift(level - 1)
        return _tables(_apply(half, _apply(half, bits)))
    one = _byte_table()
    for _ in range(BLOCK):
        bits = (bits >> 8) ^ one[bits & 0xFF]
    return _tables(bits)


def crc32c(messages: Sequence[bytes]) -> np.ndarray:
    """CRC-32C of each message of at least 4 bytes."""
    lengths = np.fromiter(map(len, messages), np.int64, len(messages))
    if len(lengths) == 0:
        return np.zeros(0, np.uint32)
    if lengths.min() < 4:
        raise ValueError("messages have at least 4 bytes")
    counts = -(-lengths // BLOCK)
    ends = np.cumsum(counts)
    flat = np.zeros(int(ends[-1]) * BLOCK, np.uint8)
    for message, end, length in zip(messages, ends * BLOCK, lengths, strict=True):
        flat[end - length : end] = np.frombuffer(message, np.uint8)
    first = (ends * BLOCK - lengths)[:, None] + np.arange(4)
    flat[first] ^= 0xFF
    blocks, tables = flat.reshape(-1, BLOCK), _positions()
    sums = np.zeros(len(blocks), np.uint32)
    for i in range(BLOCK):
        sums ^= tables[i][blocks[:, i]]
    level = 0
    while counts.max() > 1:
        halves = (counts + 1) // 2
        ends, new_ends = np.cumsum(counts), np.cumsum(halves)
        back = np.repeat(new_ends, halves) - 1 - np.arange(new_ends[-1])  # pairs behind this one
        right = np.repeat(ends, halves) - 1 - 2 * back
        paired = right > np.repeat(ends - counts, halves)
        left = np.where(paired, sums[right - 1], np.uint32(0))
        sums, counts, level = _apply(_shift(level), left) ^ sums[right], halves, level + 1
    return sums ^ _ONES


def masked(crcs: np.ndarray) -> np.ndarray:
    """Checksums as they are stored: rotated, plus a constant."""
    x = crcs.astype(np.uint32)
    return ((x >> 15) | (x << 17)) + np.uint32(MASK_DELTA)
