"""Two-stage suffix sorting of one byte buffer, with numpy over whole buckets.

Only suffixes smaller than their successors are sorted directly. The others follow from scans of the buckets of first
bytes in ascending order: whoever precedes a suffix just scanned, and is larger than it, is the next of its own
bucket. All elements of a bucket that are known are scanned at once.
"""

from __future__ import annotations

import numpy as np


def _words(data: np.ndarray) -> np.ndarray:
    """The eight bytes from each position as a big-endian integer, zero bytes past the end."""
    padded = np.concatenate((data, np.zeros(8, dtype=np.uint8))).astype(np.uint64)
    out = np.zeros(len(data), dtype=np.uint64)
    for k in range(8):
        out |= padded[k : k + len(data)] << np.uint64(56 - 8 * k)
    return out


def smaller_than_next(data: np.ndarray) -> np.ndarray:
    """For each position whether its suffix is smaller than the next one; the last is not."""
    n = len(data)
    ends = np.append(np.flatnonzero(data[1:] != data[:-1]), n - 1)  # last position of each run of equal bytes
    rises = np.append(data[ends[:-1]] < data[ends[:-1] + 1], False)
    return np.repeat(rises, np.diff(np.concatenate(([-1], ends))))


def _sort_directly(starts: np.ndarray, words: np.ndarray, depth: int) -> np.ndarray:
    """Suffixes in order of their first ``depth`` bytes (a multiple of eight, at least)."""
    if not len(starts):
        return starts
    order = starts[np.argsort(words[starts])]
    value = words[order]
    words = np.concatenate((words, np.zeros(depth, dtype=np.uint64)))
    tied = np.arange(len(order))
    same = np.concatenate(([False], value[1:] == value[:-1]))
    group = np.cumsum(~same)
    for at in range(8, depth, 8):
        # Only those that equal a neighbour so far take part.
        more = same | np.append(same[1:], False)
        tied, group = tied[more], group[more]
        if not len(tied):
            break
        value = words[order[tied] + at]
        within = group[1:] == group[:-1]
        falls = np.flatnonzero(within & (value[1:] < value[:-1]))
        if len(falls):
            # Copies stay in order however far they are compared: only groups that are out of it are sorted.
            mixed = np.zeros(group[-1] + 1, dtype=bool)
            mixed[group[falls]] = True
            some = np.flatnonzero(mixed[group])
            index = some[np.lexsort((value[some], group[some]))]
            order[tied[some]] = order[tied[index]]
            value[some] = value[index]
        same = np.concatenate(([False], within & (value[1:] == value[:-1])))
        group = np.cumsum(~same)
    return order


def suffix_array(data: np.ndarray, depth: int) -> np.ndarray:
    """All suffixes of ``data`` in order of their first ``depth`` bytes, at least."""
    n = len(data)
    if not n:
        return np.zeros(0, dtype=np.int64)
    small = smaller_than_next(data)
    direct = _sort_directly(np.flatnonzero(small), _words(data), -(-depth // 8) * 8 + 8)
    cuts = np.searchsorted(data[direct], np.arange(257))
    larger: list[list[np.ndarray]] = [[] for _ in range(256)]
    larger[data[n - 1]].append(np.array([n - 1]))

    def induce(scanned: np.ndarray, byte: int) -> np.ndarray:
        """Hand the larger predecessors to their buckets; those of this bucket are returned."""
        before = scanned[scanned > 0] - 1
        before = before[~small[before]]
        first = data[before]
        own = first == byte
        others, first = before[~own], first[~own]
        if len(others):
            by_bucket = np.argsort(first, kind="stable")
            others, first = others[by_bucket], first[by_bucket]
            starts = np.flatnonzero(np.concatenate(([True], first[1:] != first[:-1])))
            for a, b in zip(starts, [*starts[1:], len(others)]):
                larger[first[a]].append(others[a:b])
        return before[own]

    out = []
    for byte in range(256):
        waiting = np.concatenate(larger[byte]) if larger[byte] else np.zeros(0, dtype=np.int64)
        while len(waiting):
            out.append(waiting)
            waiting = induce(waiting, byte)
        own = direct[cuts[byte] : cuts[byte + 1]]
        if len(own):
            out.append(own)
            induce(own, byte)
    return np.concatenate(out)


def equal_to_previous(data: np.ndarray, order: np.ndarray, length: int) -> np.ndarray:
    """For each of the sorted positions whether its common prefix with the one before is at least ``length``.

    Every position must have ``length`` bytes from it on.
    """
    words = _words(data)
    a, b = order[:-1], order[1:]
    same = np.ones(len(b), dtype=bool)
    for at in [*range(0, length - 8, 8), length - 8]:
        left = np.flatnonzero(same)
        same[left] = words[a[left] + at] == words[b[left] + at]
    return np.concatenate(([False], same))[: len(order)]
