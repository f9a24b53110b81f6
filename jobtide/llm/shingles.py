"""Word shingles of whole texts as 64-bit hashes, and MinHash signatures, on numpy arrays over many texts at once."""

from __future__ import annotations

from functools import lru_cache

import numpy as np

MIX_A, MIX_B = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
BASE = 0x9E3779B97F4A7C15
BLOCK_BYTES = 1 << 20


def mixed(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit values over all bits (a bijection)."""
    x = (x ^ (x >> np.uint64(30))) * MIX_A
    x = (x ^ (x >> np.uint64(27))) * MIX_B
    return x ^ (x >> np.uint64(31))


@lru_cache
def _byte_codes() -> tuple[np.ndarray, np.ndarray]:
    """A 64-bit code per byte, A-Z coded as a-z, and which bytes are white space."""
    byte = np.arange(256, dtype=np.uint64)
    lower = np.where((byte >= 65) & (byte <= 90), byte + np.uint64(32), byte)
    return mixed(lower + np.uint64(0x1000)), (byte == 32) | ((byte >= 9) & (byte <= 13))


@lru_cache(maxsize=4)
def _powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd number and of its inverse modulo 2 ** 64."""
    up, down = np.full(size, BASE, dtype=np.uint64), np.full(size, pow(BASE, -1, 1 << 64), dtype=np.uint64)
    up[0] = down[0] = 1
    return np.multiply.accumulate(up), np.multiply.accumulate(down)


def word_hashes(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Hash and start of each word in ``data``, A-Z lower-cased."""
    codes, space = _byte_codes()
    raw = np.frombuffer(data, dtype=np.uint8)
    inside = np.concatenate(([False], ~space[raw], [False]))
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    starts, ends = edges[::2], edges[1::2]
    if not len(starts):
        return np.empty(0, np.uint64), starts
    up, down = _powers(1 << max(16, (len(raw)).bit_length()))
    total = np.concatenate((np.zeros(1, np.uint64), np.cumsum(codes[raw] * up[: len(raw)], dtype=np.uint64)))
    return mixed((total[ends] - total[starts]) * down[starts] + (ends - starts).astype(np.uint64)), starts


def shingle_sets(texts: list[bytes], width: int = 5) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text. With fewer words than ``width`` the whole sequence is the one shingle;
    without words the set is empty."""
    out: list[np.ndarray] = []
    block: list[bytes] = []
    size = 0
    for text in texts:
        block.append(text)
        size += len(text) + 1
        if size >= BLOCK_BYTES:
            out += _block_sets(block, width)
            block, size = [], 0
    return out + _block_sets(block, width)


def _block_sets(texts: list[bytes], width: int) -> list[np.ndarray]:
    if not texts:
        return []
    words, starts = word_hashes(b" ".join(texts))
    limits = np.cumsum([len(t) + 1 for t in texts])
    edges = np.concatenate(([0], np.searchsorted(starts, limits)))
    rolled = np.zeros(len(words), np.uint64)
    for k in range(width):
        rolled[: len(words) - k] += mixed(words[k:] + np.uint64(k + 1)) if k < len(words) else np.uint64(0)
    rolled = mixed(rolled)
    out = []
    for a, b in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
        if b - a >= width:
            out.append(np.unique(rolled[a : b - width + 1]))
        elif b > a:
            some = words[a:b] + np.arange(1, b - a + 1, dtype=np.uint64)
            out.append(mixed(np.array([mixed(some).sum(dtype=np.uint64) + np.uint64(b - a)], dtype=np.uint64)))
        else:
            out.append(rolled[:0])
    return out


@lru_cache(maxsize=4)
def _coordinates(count: int) -> tuple[np.ndarray, np.ndarray]:
    seeds = mixed(np.arange(1, 2 * count + 1, dtype=np.uint64) * np.uint64(BASE))
    return seeds[:count] | np.uint64(1), seeds[count:]


def signature(shingles: np.ndarray, count: int) -> np.ndarray:
    """The least of each of ``count`` 32-bit hashes over the set; for the empty set an empty array."""
    if not len(shingles):
        return np.empty(0, np.uint32)
    factors, shifts = _coordinates(count)
    least = np.full(count, 0xFFFFFFFF, np.uint32)
    for a in range(0, len(shingles), 2048):
        part = shingles[a : a + 2048]
        values = ((part[None, :] * factors[:, None] + shifts[:, None]) >> np.uint64(32)).astype(np.uint32)
        np.minimum(least, values.min(axis=1), out=least)
    return least
