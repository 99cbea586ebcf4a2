"""Fragments of many texts at once: equal ones are found in numpy, and each distinct one is encoded once.

Fragments are ranges of one buffer. Their hashes are differences of a running sum, so no Python runs for a
fragment; those with one hash are compared byte by byte with the first of them, so that results do not rest on
hashes. Only distinct fragments are sliced and looked up.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np

from waymeter.llm.words import BYTE_VALUES, mixed, powers

#: Fragments remembered by a worker, in two halves, and the longest of them.
ENTRIES, LONGEST = 250_000, 64
WINDOW = 1 << 20


class Remembered:
    """Values by fragment, made for many at once. When the young half is full, the old one goes and what is in use is
    young again."""

    def __init__(self, make: Callable[[list[bytes]], list], entries: int = ENTRIES):
        self.make, self.half = make, max(1, entries // 2)
        self.young: dict[bytes, object] = {}
        self.old: dict[bytes, object] = {}

    def _keep(self, fragment: bytes, value) -> None:
        if len(fragment) <= LONGEST:
            if len(self.young) >= self.half:
                self.old, self.young = self.young, {}
            self.young[fragment] = value

    def many(self, fragments: list[bytes]) -> list:
        """The values of distinct fragments. Only those that are not young are looked at one by one."""
        values, fresh = list(map(self.young.get, fragments)), []
        for k in [k for k, value in enumerate(values) if value is None]:
            values[k] = self.old.get(fragments[k])
            if values[k] is None:
                fresh.append(k)
            else:
                self._keep(fragments[k], values[k])
        for k, value in zip(fresh, self.make([fragments[k] for k in fresh]) if fresh else []):
            values[k] = value
            self._keep(fragments[k], value)
        return values

    def __len__(self) -> int:
        return len(self.young) + len(self.old)


def ranges(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The positions start, start + 1, ... of every range, one range behind the other."""
    ends = np.cumsum(sizes)
    total = int(ends[-1]) if ends.size else 0
    return np.arange(total) + np.repeat(starts - (ends - sizes), sizes)


def distinct(whole: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of the fragments whole[starts:ends] the numbers of the distinct ones, and for each fragment its place there. No
    fragment is empty."""
    up, down = powers(whole.size)
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(BYTE_VALUES[whole] * up[: whole.size], dtype=np.uint64)])
    sizes = ends - starts
    hashes = mixed((sums[ends] - sums[starts]) * down[starts] ^ sizes.astype(np.uint64))
    order = np.argsort(hashes)
    hashes = hashes[order]
    new = np.r_[True, hashes[1:] != hashes[:-1]]
    first, place = order[new], np.empty(order.size, np.int64)
    place[order] = np.cumsum(new) - 1
    twin = order[new][place]
    rest = np.flatnonzero(twin != np.arange(order.size))
    size = sizes[rest]
    other = (size != sizes[twin[rest]]).any()
    if not other and rest.size:
        other = not (whole[ranges(starts[rest], size)] == whole[ranges(starts[twin[rest]], size)]).all()
    if other:  # two fragments with one hash: told apart by their bytes
        seen: dict[bytes, int] = {}
        data = whole.tobytes()
        place = np.array([seen.setdefault(data[i:j], len(seen)) for i, j in zip(starts.tolist(), ends.tolist())])
        first = np.unique(place, return_index=True)[1]
    return first, place


def gathered(values: list[bytes], place: np.ndarray, kind: str = "<u4") -> tuple[np.ndarray, np.ndarray]:
    """The numbers of all fragments in order, each fragment holding those of values[place], and how many each holds."""
    width = np.dtype(kind).itemsize
    sizes = np.fromiter(map(len, values), np.int64, len(values)) // width
    flat = np.frombuffer(b"".join(values), kind)
    counts = sizes[place]
    return flat[ranges((np.cumsum(sizes) - sizes)[place], counts)], counts


def _windows(starts: np.ndarray, ends: np.ndarray) -> list[tuple[int, int]]:
    """Ranges of fragments of at most WINDOW bytes, or of one fragment, so that arrays over bytes stay small."""
    out, at = [], 0
    while at < starts.size:
        upto = max(at + 1, int(np.searchsorted(ends, starts[at] + WINDOW, side="right")))
        out.append((at, upto))
        at = upto
    return out


def numbers(buffer: bytes, starts: np.ndarray, ends: np.ndarray, known: Remembered) -> tuple[np.ndarray, np.ndarray]:
    """The ids of the fragments in order, and how many each one has."""
    whole = np.frombuffer(buffer, np.uint8)
    ids, counts = [np.empty(0, "<u4")], [np.empty(0, np.int64)]
    for at, upto in _windows(starts, ends):
        base, some, other = starts[at], starts[at:upto], ends[at:upto]
        if some.size > 1:
            first, place = distinct(whole[base:other[-1]], some - base, other - base)
        else:
            first = place = np.zeros(1, np.int64)
        values = known.many([buffer[i:j] for i, j in zip(some[first].tolist(), other[first].tolist())])
        for made, part in zip((ids, counts), gathered(values, place)):
            made.append(part)
    return np.concatenate(ids), np.concatenate(counts)
