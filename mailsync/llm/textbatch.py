"""Vectorised work on the texts of one Arrow batch: words, word hashes and five-word shingles.

The bytes of a whole batch are handled as one numpy array, so no Python string is made per word.
Words are runs of bytes other than ``[\\x20\\x09-\\x0D]``; ``A-Z`` counts as lower case. Hashes are
64 bits wide: a polynomial over the bytes, finished with a mixing step.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

SHINGLE = 5
_U = np.uint64
_RADIX = _U(0x9E3779B97F4A7C15)
_FOLD = _U(0xD6E8FEB86659FD93)
SPACE = np.zeros(256, dtype=bool)
SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A"):ord("Z") + 1] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """Finish 64-bit values so that every bit depends on all bits of the input."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def _inverse(odd: int) -> int:
    return pow(odd, -1, 1 << 64)


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, dtype=np.uint64)
    if n:
        out[0] = 1
    return np.multiply.accumulate(out)


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a string column and the ``n + 1`` offsets of its rows; null is empty."""
    column = column.cast(pa.large_string())
    if column.null_count:
        column = column.fill_null("")
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset:column.offset + len(column) + 1]
    data = column.buffers()[2]
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[offsets[0]:offsets[-1]], offsets - offsets[0]


def row_sums(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Sum of each row's values, where row ``i`` has ``values[offsets[i]:offsets[i + 1]]``."""
    total = np.zeros(len(values) + 1, dtype=np.int64)
    np.cumsum(values, out=total[1:])
    return total[offsets[1:]] - total[offsets[:-1]]


def blocks(offsets: np.ndarray, most: int) -> list[tuple[int, int]]:
    """Row ranges of at most ``most`` bytes each; a longer row stands alone."""
    out, at, n = [], 0, len(offsets) - 1
    while at < n:
        to = int(np.searchsorted(offsets, offsets[at] + most, side="right")) - 1
        to = min(max(to, at + 1), n)
        out.append((at, to))
        at = to
    return out


def word_hashes(raw: np.ndarray, offsets: np.ndarray, gaps: np.ndarray = SPACE,
                lower: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every word in order, and the ``n + 1`` offsets of the rows' words.

    ``gaps`` says for each byte value whether it separates words.
    """
    n = len(raw)
    if not n:
        return np.zeros(0, np.uint64), np.zeros(len(offsets), np.int64)
    space = gaps[raw]
    first = np.zeros(n + 1, dtype=bool)
    first[offsets] = True
    start = ~space
    start[1:] &= space[:-1] | first[1:n]
    starts = np.flatnonzero(start)
    end = ~space
    end[:-1] &= space[1:] | first[1:n]
    ends = np.flatnonzero(end) + 1
    value = ((_LOWER[raw] if lower else raw).astype(np.uint64) + _U(1)) * _powers(int(_RADIX), n)
    total = np.zeros(n + 1, dtype=np.uint64)
    np.cumsum(value, out=total[1:])
    hashed = (total[ends] - total[starts]) * _powers(_inverse(int(_RADIX)), n)[starts]
    hashed = mix(hashed ^ ((ends - starts).astype(np.uint64) * _FOLD))
    return hashed, np.searchsorted(starts, offsets).astype(np.int64)


def shingle_hashes(words: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every five-word shingle in order (repeats stay), and the rows' offsets.

    A row of one to four words has one shingle, its whole sequence; a row without words has none.
    """
    counts = np.diff(offsets)
    made = np.where(counts >= SHINGLE, counts - SHINGLE + 1, (counts > 0).astype(np.int64))
    out = np.zeros(len(offsets), np.int64)
    np.cumsum(made, out=out[1:])
    n = len(words)
    short = np.flatnonzero((counts > 0) & (counts < SHINGLE))
    if n >= SHINGLE:
        rolled = words[:n - SHINGLE + 1].copy()
        for k in range(1, SHINGLE):
            rolled = rolled * _RADIX + words[k:n - SHINGLE + 1 + k]
        rolled = mix(rolled)
        row = np.repeat(np.arange(len(counts)), counts)
        whole = row[:n - SHINGLE + 1] == row[SHINGLE - 1:]
        long = rolled[whole]
    else:
        long = np.zeros(0, np.uint64)
    if not len(short):
        return long, out
    shingles = np.empty(out[-1], np.uint64)
    is_short = np.zeros(out[-1], dtype=bool)
    is_short[out[short]] = True
    shingles[~is_short] = long
    for i in short:
        h = _U(int(counts[i]))
        for w in words[offsets[i]:offsets[i + 1]]:
            h = _U((int(h) * int(_RADIX) + int(w)) & 0xFFFFFFFFFFFFFFFF)
        shingles[out[i]] = mix(np.array([h ^ _FOLD], np.uint64))[0]
    return shingles, out
