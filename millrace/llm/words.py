"""Words of texts as arrays of 64-bit hashes, batch by batch."""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes hashed at once (a longer word is hashed whole).
SEGMENT = 1 << 21
FACTOR = 0x9E3779B97F4A7C15 | 1
INVERSE = pow(FACTOR, -1, 1 << 64)
SPACES = np.zeros(256, bool)
SPACES[[0x20, *range(0x09, 0x0E)]] = True


def mixed(values: np.ndarray) -> np.ndarray:
    """64-bit integers spread over their whole range, one to one."""
    x = values.astype(np.uint64, copy=True)
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x ^= x >> np.uint64(shift)
        x *= np.uint64(factor)
    x ^= x >> np.uint64(31)
    return x


@lru_cache(maxsize=1)
def letters() -> np.ndarray:
    """A number for each byte; A-Z have those of a-z."""
    table = mixed(np.arange(1, 257, dtype=np.uint64)) | np.uint64(1)
    table[65:91] = table[97:123]
    return table


@lru_cache(maxsize=4)
def powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the factor and of its inverse, modulo 2 to the 64."""
    both = []
    for base in (FACTOR, INVERSE):
        row = np.full(size, base, np.uint64)
        row[0] = 1
        both.append(np.multiply.accumulate(row))
    return both[0], both[1]


def contents(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts (null: empty) and where each begins, with the end."""
    filled = pc.fill_null(texts, "").cast(pa.large_string())
    if not len(filled):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = filled.buffers()
    at = np.frombuffer(offsets, np.int64)[filled.offset : filled.offset + len(filled) + 1]
    data = np.zeros(0, np.uint8) if data is None else np.frombuffer(data, np.uint8)
    return data[at[0] : at[-1]], at - at[0]


def word_hashes(
    texts: pa.Array, gaps: np.ndarray = SPACES, heads: tuple[int, ...] = ()
) -> tuple[np.ndarray, ...]:
    """The hash of every word of every text, the number of its text, and of its heads.

    Words are runs of bytes that are no ``gaps`` (by default the six
    white-space characters of ASCII), with A-Z in lower case. A head is the
    word's first so many bytes; of a shorter word it is the whole.
    """
    data, at = contents(texts)
    if not len(data):
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), *(np.zeros(0, np.uint64) for _ in heads)
    inside = ~gaps[data]
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    begins = at[:-1][at[:-1] < len(data)]
    first[begins] = inside[begins]
    last = np.zeros(len(data), bool)
    last[:-1] = inside[:-1] & (~inside[1:] | first[1:])
    last[-1] = inside[-1]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    hashes = np.empty((1 + len(heads), len(starts)), np.uint64)
    done = 0
    while done < len(starts):
        to = max(done + 1, int(np.searchsorted(starts, starts[done] + SEGMENT)))
        low, high = starts[done], ends[to - 1]
        size = int(high - low)
        up, down = powers(max(SEGMENT, 1 << size.bit_length()) if size > SEGMENT else SEGMENT + 1)
        sums = np.zeros(size + 1, np.uint64)
        np.cumsum(letters()[data[low:high]] * up[:size], out=sums[1:])
        own, end = starts[done:to] - low, ends[done:to] - low
        hashes[0, done:to] = (sums[end] - sums[own]) * down[own]
        for n, head in enumerate(heads, 1):
            hashes[n, done:to] = (sums[np.minimum(own + head, end)] - sums[own]) * down[own]
        done = to
    whole, *parts = mixed(hashes)
    return whole, np.searchsorted(at, starts, side="right") - 1, *parts
