"""HyperMinHash registers: what they are made of, and what two rows of them say about two sets.

A register belongs to one bucket. It stores the smallest hash that fell into the bucket as a count of leading
zeros (6 bits) and the ``MANTISSA`` bits that follow the leading one: 16 bits instead of 64, for any size of set. Every bucket has a
hash function of its own and sees the whole set; dealing one hash's values over the buckets would leave most of
them empty for short documents, whose registers would then say nothing.

Two registers of different minima are equal by accident with a small probability; :func:`estimate` takes it out.
"""

from __future__ import annotations

import numpy as np
import xxhash

BUCKETS = 256
MANTISSA = 10
BANDED = 128  # registers that make bands
PER_BAND = 4
# Fixed value: share of accidental collisions for sets of equal size, times 2**bits of mantissa (Yu and Weber, HyperMinHash).
COLLISIONS = 0.169919487159739
MULTIPLIERS = np.random.default_rng(20260102).integers(0, 1 << 63, BUCKETS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
MIX = np.uint64(0xD6E8FEB86659FD93)


def shingles(body: bytes | None, size: int) -> np.ndarray:
    """Sorted 64-bit hashes of the distinct shingles of the text in lower case (A-Z); a shorter text is one shingle."""
    words = (body or b"").lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    size = min(size, len(h))
    total = np.full(len(h) - size + 1, size, np.uint64)
    for i in range(size):
        total = (total * np.uint64(0x9E3779B97F4A7C15)) ^ h[i:i + len(total)]
        total = (total ^ (total >> np.uint64(32))) * MIX
    return np.unique(total ^ (total >> np.uint64(29)))


def registers(found: np.ndarray) -> np.ndarray:
    """The registers of a set that is not empty."""
    low = np.full(BUCKETS, np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(found), 1024):
        np.minimum(low, (found[at:at + 1024, None] * MULTIPLIERS).min(0), out=low)
    low = np.maximum(low, np.uint64(1 << 11))
    bits = np.frexp((low >> np.uint64(11)).astype(np.float64))[1] + 11  # 53 bits, so the conversion is exact
    zeros = (64 - bits).astype(np.uint64)
    mantissa = (low << zeros << np.uint64(1)) >> np.uint64(64 - MANTISSA)
    return ((zeros << np.uint64(MANTISSA)) | mantissa).astype("<u2")


def band_values(rows: np.ndarray) -> np.ndarray:
    """For each row of registers those of each band side by side, in one number."""
    return np.ascontiguousarray(rows[:, :BANDED]).view("<u8").reshape(len(rows), -1)


def band_keys(rows: np.ndarray) -> np.ndarray:
    """For each row of registers a key for each band: its registers, mixed with the band's number."""
    keys = band_values(rows)
    n = np.arange(1, keys.shape[1] + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    keys = (keys ^ n) * MIX
    keys = (keys ^ (keys >> np.uint64(31))) * MIX
    return (keys ^ (keys >> np.uint64(29))).view(np.int64)


def estimate(one: np.ndarray, many: np.ndarray, size: int, sizes: np.ndarray) -> np.ndarray:
    """Jaccard similarity of one set to many, from registers and set sizes, without accidental collisions."""
    equal = (many == one).mean(1)
    ratio = size / sizes
    accident = COLLISIONS * 2.0**-MANTISSA * 4 * ratio / (1 + ratio) ** 2
    return np.maximum(0, (equal - accident) / (1 - accident))
