"""Words of whole Arrow columns as 64-bit hashes and byte places, without a Python object for each word."""

from __future__ import annotations

import functools
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

#: Bytes hashed at once; a row that is longer is cut between words.
BLOCK_BYTES = 1 << 16
_STEP = 0xD1342543DE82EF95
_SPACE = [9, 10, 11, 12, 13, 32]
IS_WORD = np.ones(256, bool)
IS_WORD[_SPACE] = False


def mixed(x: np.ndarray) -> np.ndarray:
    """Every bit of a 64-bit number spread over all of them; one to one."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


@functools.cache
def _of_byte() -> np.ndarray:
    """A random number for each byte; A-Z have those of a-z."""
    out = np.random.default_rng(77).integers(0, 2**64, 256, np.uint64)
    out[65:91] = out[97:123]
    return out


_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def powers(n: int, step: int = _STEP) -> tuple[np.ndarray, np.ndarray]:
    """At least n powers of a step, and of its inverse, modulo 2**64; kept, and made anew where more are asked for."""
    if step not in _POWERS or len(_POWERS[step][0]) < n:
        size = max(BLOCK_BYTES, 1 << n.bit_length())
        _POWERS[step] = tuple(np.cumprod(np.concatenate((np.ones(1, np.uint64), np.full(size, b, np.uint64))), dtype=np.uint64) for b in (step, pow(step, -1, 2**64)))
    return _POWERS[step]


@dataclass
class Words:
    """Words of several texts: hash, first byte and the byte after the last, all in `data`; row r has words row[r] to row[r + 1]."""

    data: np.ndarray
    offsets: np.ndarray
    hash: np.ndarray
    start: np.ndarray
    end: np.ndarray
    row: np.ndarray


def bytes_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a string column and each row's place in them; null is empty."""
    column = column.cast(pa.large_string())
    if column.null_count:
        column = column.fill_null("")
    raw = column.buffers()
    offsets = np.frombuffer(raw[1], np.int64)[column.offset : column.offset + len(column) + 1] if len(column) else np.zeros(1, np.int64)
    data = np.frombuffer(raw[2], np.uint8)[offsets[0] : offsets[-1]] if raw[2] is not None and raw[2].size else np.empty(0, np.uint8)
    return data, offsets - offsets[0]


def _cuts(data: np.ndarray, offsets: np.ndarray) -> list[int]:
    """Ends of blocks, between rows or, in a long row, between words."""
    out, lo, n = [], 0, len(data)
    while lo < n:
        hi = lo + BLOCK_BYTES
        if hi >= n:
            hi = n
        else:
            row = int(offsets[np.searchsorted(offsets, hi, "right") - 1])
            if row > lo:
                hi = row
            else:
                stop = int(offsets[np.searchsorted(offsets, lo, "right")])
                gaps = np.flatnonzero(~IS_WORD[data[lo:hi]])
                while not len(gaps) and hi < stop:
                    hi = min(stop, 2 * hi - lo)
                    gaps = np.flatnonzero(~IS_WORD[data[lo:hi]])
                hi = min(hi, stop) if not len(gaps) else lo + int(gaps[-1]) + 1
        out.append(hi)
        lo = hi
    return out


def hashed(column: pa.Array) -> Words:
    """Words ``[^\\x20\\x09-\\x0D]+`` of each row with A-Z lower-cased, as hashes; a null row has none.

    A word's hash is a polynomial over random numbers of its bytes, mixed with its length: prefix sums give all words of a block
    at once.
    """
    data, offsets = bytes_of(column)
    hashes, starts, ends, lo = [], [], [], 0
    for hi in _cuts(data, offsets):
        block = data[lo:hi]
        word = IS_WORD[block]
        first = word.copy()
        first[1:] &= ~word[:-1]
        rows = offsets[np.searchsorted(offsets, lo) : np.searchsorted(offsets, hi)] - lo
        first[rows] = word[rows]
        start = np.flatnonzero(first)
        last = word.copy()
        last[:-1] &= ~word[1:] | first[1:]
        end = np.flatnonzero(last) + 1
        power, inverse = powers(len(block))
        sums = np.zeros(len(block) + 1, np.uint64)
        np.cumsum(_of_byte()[block] * power[: len(block)], out=sums[1:])
        hashes.append(mixed((sums[end] - sums[start]) * inverse[start] ^ (end - start).astype(np.uint64) << np.uint64(40)))
        starts.append(start + lo)
        ends.append(end + lo)
        lo = hi
    join = lambda x, kind: np.concatenate(x) if x else np.empty(0, kind)
    start = join(starts, np.int64)
    return Words(data, offsets, join(hashes, np.uint64), start, join(ends, np.int64), np.searchsorted(start, offsets))
