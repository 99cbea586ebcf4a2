"""Words of many texts at once, as 64-bit hashes in numpy arrays.

A word is a run of bytes other than space and 0x09-0x0D. Its hash is a polynomial over table entries of its
bytes, taken as the difference of two running sums, so no Python runs for a word.
"""

from __future__ import annotations

import numpy as np

_U = np.uint64
_BASE = _U(0x9E3779B97F4A7C15)
_WINDOW = 1 << 20
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit (the splitmix64 finalizer)."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


BYTE_VALUES = mixed(np.arange(1, 257, dtype=np.uint64) * _BASE)
_POWERS = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    if _POWERS[0].size < size:
        inverse = _U(pow(int(_BASE), -1, 1 << 64))
        for k, base in enumerate((_BASE, inverse)):
            _POWERS[k] = np.cumprod(np.r_[_U(1), np.full(size - 1, base, np.uint64)], dtype=np.uint64)
    return _POWERS[0], _POWERS[1]


def _hashed(a: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and hashes of the words of a buffer that ends in a space."""
    space = _SPACE[a]
    word = ~space
    starts = np.flatnonzero(word & np.r_[True, space[:-1]])
    if not starts.size:
        return starts, np.empty(0, np.uint64)
    ends = np.flatnonzero(space & np.r_[False, word[:-1]])
    up, down = powers(max(a.size, _WINDOW))
    sums = np.r_[_U(0), np.cumsum(BYTE_VALUES[a] * up[: a.size], dtype=np.uint64)]
    return starts, mixed((sums[ends] - sums[starts]) * down[starts] ^ (ends - starts).astype(np.uint64))


def word_hashes(texts: list[str | None], lower: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of all texts in order, and each text's number of words; null is empty."""
    parts = [(t or "").encode("utf-8", "surrogatepass") for t in texts]
    buffer = b" ".join(parts) + b" "
    if lower:
        buffer = buffer.lower()
    bounds = np.cumsum([0, *(len(p) + 1 for p in parts)])
    whole = np.frombuffer(buffer, np.uint8)
    starts, hashes, at = [], [], 0
    while at < whole.size:
        end = min(at + _WINDOW, whole.size)
        while end < whole.size and not _SPACE[whole[end - 1]]:
            end = next((end + k for k in np.flatnonzero(_SPACE[whole[end:end + _WINDOW]])[:1] + 1), end + _WINDOW)
            end = min(end, whole.size)
        s, h = _hashed(whole[at:end])
        starts.append(s + at)
        hashes.append(h)
        at = end
    every = np.concatenate(starts)
    return np.concatenate(hashes), np.diff(np.searchsorted(every, bounds))


def portions(texts: list[str | None], limit: int = 4 << 20) -> list[tuple[int, int]]:
    """Ranges of texts of about `limit` characters in all, so that arrays over them stay small."""
    out, first, size = [], 0, 0
    for k, text in enumerate(texts):
        size += len(text or "")
        if size >= limit:
            out.append((first, k + 1))
            first, size = k + 1, 0
    return out + ([(first, len(texts))] if first < len(texts) else [])
