"""Compact exchange of sorted 64-bit keys between tasks.

Statistics of a corpus' n-grams are gathered by dealing (key, small numbers) out by key range. As table rows they would
cost several times their size; here each task packs what it has for one range into one binary value: keys ascending, as
differences, the bytes of equal significance side by side, so that Spark's own block compression drops the empty ones.
"""

from __future__ import annotations

import numpy as np
import xxhash

_MIX, _STEP = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads their bits."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def chain(hashes: np.ndarray, size: int) -> np.ndarray:
    """Hashes of the windows of `size` neighbours."""
    n = len(hashes) - size + 1
    out = np.zeros(max(n, 0), np.uint64)
    for k in range(size):
        out = mix(out * _MIX + hashes[k : k + n] * _STEP + np.uint64(k))
    return out


class _Memory(dict):
    def __missing__(self, token: bytes) -> int:
        found = self[token] = xxhash.xxh3_64_intdigest(token)
        return found


class Words:
    """64-bit hashes of words, remembered for a while."""

    def __init__(self, most: int = 120_000):
        self.known, self.most = _Memory(), most

    def __call__(self, tokens: list[bytes]) -> np.ndarray:
        if len(self.known) > self.most:
            self.known.clear()
        return np.fromiter(map(self.known.__getitem__, tokens), np.uint64, len(tokens))


def pack(values: np.ndarray, ascending: bool = False) -> bytes:
    """Whole numbers without a sign, as planes of bytes; ascending ones as differences."""
    values = values.astype(np.uint64)
    if ascending and len(values):
        values = np.diff(values, prepend=np.uint64(0))
    width = max(1, (int(values.max()).bit_length() + 7) // 8) if len(values) else 1
    planes = values.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width]
    return bytes([width, ascending]) + np.ascontiguousarray(planes.T).tobytes()


def unpack(raw: bytes) -> np.ndarray:
    width, ascending = raw[0], raw[1]
    planes = np.frombuffer(raw, np.uint8, offset=2).reshape(width, -1)
    out = np.zeros((planes.shape[1], 8), np.uint8)
    out[:, :width] = planes.T
    values = out.reshape(-1).view("<u8").astype(np.uint64)
    return np.cumsum(values, dtype=np.uint64) if ascending else values


def ranges(keys: np.ndarray, parts: int) -> np.ndarray:
    """Where each of `parts` equal ranges of the 64-bit numbers begins and ends in the ascending keys: parts + 1 positions."""
    edges = np.array([(i << 64) // parts for i in range(1, parts)], dtype=np.uint64)
    return np.concatenate([[0], np.searchsorted(keys, edges), [len(keys)]]).astype(np.int64)
