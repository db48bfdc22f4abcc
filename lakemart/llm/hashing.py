"""64-bit hashes of words and word windows for whole batches of texts, without a loop over words.

A word's hash is a polynomial over random per-byte values, taken from prefix sums and mixed.
Two different words, or windows, agree with a probability of about 2^-64.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# Bytes of text hashed at once: bounds the memory of a task, whatever a text's length.
CHUNK = 1 << 20

_U = np.uint64
_P = 0x9E3779B97F4A7C15 | 1
_Q = _U(0xD6E8FEB86659FD93)
_RNG = np.random.Generator(np.random.PCG64(20240101))
_BYTE = _RNG.integers(0, 1 << 63, 256, dtype=np.uint64) * _U(2) + _U(1)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True
#: Bytes between words where punctuation does not count: ASCII but for letters and digits.
NOT_ALNUM = np.array([b < 128 and not chr(b).isalnum() for b in range(256)])


def mix(x: np.ndarray) -> np.ndarray:
    """Spread every input bit over the whole word."""
    x = x ^ (x >> _U(30))
    x = x * _U(0xBF58476D1CE4E5B9)
    x = x ^ (x >> _U(27))
    x = x * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


@lru_cache(maxsize=4)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    def run(base: int) -> np.ndarray:
        out = np.full(n, base & (2**64 - 1), dtype=np.uint64)
        out[0] = 1
        return np.multiply.accumulate(out)

    return run(_P), run(pow(_P, -1, 2**64))


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """At least n powers of the base and of its inverse."""
    return _powers(max(CHUNK * 2, 1 << max(0, n - 1).bit_length()))


def _as_bytes(column: pa.Array) -> pa.Array:
    return column.cast(pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary())


def byte_lists(column: pa.Array) -> list[bytes]:
    """Texts as UTF-8; a null is empty."""
    return [b or b"" for b in _as_bytes(column).to_pylist()]


def slices(column: pa.Array, most: int = CHUNK) -> Iterator[tuple[int, list[bytes]]]:
    """Runs of texts of about ``most`` bytes, each with the index of its first; long texts alone.

    Only the texts of one run are copied out of the column at a time.
    """
    lengths = pc.fill_null(pc.binary_length(_as_bytes(column)), 0).to_numpy(zero_copy_only=False)
    ends = np.cumsum(lengths.astype(np.int64) + 1)
    at = base = 0
    while at < len(ends):
        end = max(at + 1, int(np.searchsorted(ends, base + most + 1, side="right")))
        yield at, byte_lists(column.slice(at, end - at))
        at, base = end, int(ends[end - 1])


def _chunk_words(buf: np.ndarray, between: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    space = between[buf]
    edge = np.flatnonzero(np.diff(np.concatenate(([True], space, [True])).view(np.int8)))
    starts, ends = edge[::2], edge[1::2]
    if not len(starts):
        return starts, ends, np.zeros(0, dtype=np.uint64)
    up, down = powers(len(buf))
    values = _BYTE[_LOWER[buf]]
    values *= up[: len(buf)]
    sums = np.zeros(len(buf) + 1, dtype=np.uint64)
    np.cumsum(values, out=sums[1:])
    return starts, ends, mix((sums[ends] - sums[starts]) * down[starts])


def words(texts: list[bytes], between: np.ndarray = _SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Hash, text index, first byte and end byte (within the text) of every word of some texts.

    Words are runs of anything but the bytes marked in ``between``: the six ASCII white-space bytes, or
    a table that holds the space too. A-Z count as a-z.
    """
    joined = np.frombuffer(b" ".join(texts) + b" ", dtype=np.uint8)
    lengths = np.fromiter(map(len, texts), dtype=np.int64, count=len(texts))
    firsts = np.concatenate(([0], np.cumsum(lengths + 1)[:-1])) if len(texts) else np.zeros(0, np.int64)
    parts, at = [], 0
    while at < len(joined):
        end = min(len(joined), at + CHUNK)
        while end < len(joined):  # never cut a word
            gap = np.flatnonzero(between[joined[end - 1 : end + CHUNK]])
            if len(gap):
                end += int(gap[0])
                break
            end = min(len(joined), end + CHUNK)
        s, e, h = _chunk_words(joined[at:end], between)
        parts.append((s + at, e + at, h))
        at = end
    if not parts:
        empty = np.zeros(0, np.int64)
        return np.zeros(0, np.uint64), empty, empty, empty
    starts, ends, hashes = (np.concatenate(x) for x in zip(*parts))
    text = np.searchsorted(firsts, starts, side="right") - 1
    return hashes, text, starts - firsts[text], ends - firsts[text]


def windows(hashes: np.ndarray, text: np.ndarray, n_texts: int, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash and text index of every run of ``size`` words; a shorter text is one run, if it has words."""
    counts = np.bincount(text, minlength=n_texts)
    n = len(hashes)
    if n >= size:
        at = np.flatnonzero(text[: n - size + 1] == text[size - 1 :])
        total = np.zeros(len(at), dtype=np.uint64)
        for k in range(size):
            total = total * _Q + hashes[at + k]
        full, owner = mix(total), text[at]
    else:
        full, owner = np.zeros(0, np.uint64), np.zeros(0, np.int64)
    short = np.flatnonzero((counts > 0) & (counts < size))
    if len(short):
        ends = np.cumsum(counts)
        total = np.zeros(len(short), dtype=np.uint64)
        for k in range(size - 1):
            here = counts[short] > k
            index = np.minimum(ends[short] - counts[short] + k, n - 1)
            total = np.where(here, total * _Q + hashes[index], total)
        total = mix(total + counts[short].astype(np.uint64) * _U(0xA24BAED4963EE407))
        full, owner = np.concatenate((full, total)), np.concatenate((owner, short))
        order = np.argsort(owner, kind="stable")
        full, owner = full[order], owner[order]
    return full, owner
