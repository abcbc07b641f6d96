"""Polynomial hashes of all substrings of a text, vectorised; the same in every process."""

from __future__ import annotations

import numpy as np

_BASE = 0x9E3779B97F4A7C15 | 1
_UNDO = pow(_BASE, -1, 1 << 64)


class _Powers:
    up = np.ones(1, np.uint64)
    down = np.ones(1, np.uint64)


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first ``n`` powers of the base and of its inverse modulo 2^64."""
    if len(_Powers.up) < n:
        size = max(n, 2 * len(_Powers.up), 1 << 16)
        for name, base in (("up", _BASE), ("down", _UNDO)):
            row = np.full(size, base, np.uint64)
            row[0] = 1
            setattr(_Powers, name, np.multiply.accumulate(row))
    return _Powers.up[:n], _Powers.down[:n]


def mix(x: np.ndarray) -> np.ndarray:
    """Bits spread over the word, in place."""
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    return x


def prefix_sums(data: np.ndarray) -> np.ndarray:
    """Sums from which the hash of any substring follows."""
    up, _ = powers(len(data))
    sums = np.empty(len(data) + 1, np.uint64)
    sums[0] = 0
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up, out=sums[1:])
    return sums


def substring_hashes(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of the substrings from ``starts`` to ``ends``."""
    _, down = powers(len(sums))
    return mix((sums[ends] - sums[starts]) * down[starts])


def gram_hashes(data: np.ndarray, k: int) -> np.ndarray:
    """64-bit hashes of all substrings of length ``k``."""
    sums = prefix_sums(data)
    _, down = powers(len(sums))
    return mix((sums[k:] - sums[:-k]) * down[: len(sums) - k])


def sliding_min(x: np.ndarray, w: int) -> np.ndarray:
    """Least value of each window of ``w`` values; two running minima over blocks."""
    n = len(x) - w + 1
    blocks = -(-len(x) // w)
    padded = np.full(blocks * w, np.iinfo(x.dtype).max, x.dtype)
    padded[: len(x)] = x
    padded = padded.reshape(blocks, w)
    ahead = np.minimum.accumulate(padded, axis=1).ravel()
    behind = np.minimum.accumulate(padded[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[:n], ahead[w - 1 : w - 1 + n])
