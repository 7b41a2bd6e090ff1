"""Words, their hashes and window hashes, for whole Arrow batches at once.

A word is a maximal run of bytes other than ASCII white space (space, tab to carriage return), as in
``[^\\x20\\x09-\\x0D]+``. Word hashes are multilinear: a sum of bytes times a fixed pseudo-random odd factor per position,
mixed at the end. Window hashes are differences of prefix sums, so their cost does not depend on the window's length.
All arithmetic is modulo 2**64 and gives the same values in every process.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

U = np.uint64
_SPACE = np.zeros(256, bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def mixed(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values (a fixed one-to-one map)."""
    x = x ^ (x >> U(30))
    x = x * U(0xBF58476D1CE4E5B9)
    x = x ^ (x >> U(27))
    x = x * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


def keyed(n: int, seed: int) -> np.ndarray:
    """``n`` fixed pseudo-random 64-bit values."""
    with np.errstate(over="ignore"):
        return mixed((np.arange(1, n + 1, dtype=U) + U(seed) * U(0x10001)) * U(0x9E3779B97F4A7C15))


_FACTORS = keyed(1 << 12, 11) | U(1)


def _factors(n: int) -> np.ndarray:
    global _FACTORS
    if n > len(_FACTORS):
        _FACTORS = keyed(1 << (n - 1).bit_length(), 11) | U(1)
    return _FACTORS


def byte_rows(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a string column without gaps, and the offsets of its rows; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string())
    if column.null_count:
        column = column.fill_null("")
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    if data is None or len(offsets) == 0:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    return np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]], offsets - offsets[0]


def word_bounds(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Begin and end byte of each word, and for each row the number of words before it (one more at the end)."""
    inside = np.zeros(len(data) + 2, bool)
    inside[1:-1] = ~_SPACE[data]
    edge = inside[1:] != inside[:-1]
    begins = np.flatnonzero(edge & inside[1:])
    ends = np.flatnonzero(edge & inside[:-1])
    cuts = np.unique(offsets[1:-1])
    cuts = cuts[(cuts > 0) & (cuts < len(data))]
    cuts = cuts[inside[cuts] & inside[cuts + 1]]  # rows that meet without white space between them
    if len(cuts):
        begins, ends = np.sort(np.concatenate([begins, cuts])), np.sort(np.concatenate([ends, cuts]))
    return begins, ends, np.searchsorted(begins, offsets)


def word_hashes(data: np.ndarray, begins: np.ndarray, ends: np.ndarray, lower: bool = False) -> np.ndarray:
    """One 64-bit hash per word; ``lower`` takes A-Z as a-z."""
    out = np.empty(len(begins), U)
    step = 1 << 17  # words at a time: bounded scratch memory
    with np.errstate(over="ignore"):
        for at in range(0, len(begins), step):
            b, e = begins[at : at + step], ends[at : at + step]
            lengths = e - b
            first = np.cumsum(lengths) - lengths
            place = np.arange(int(lengths.sum()), dtype=np.int64) - np.repeat(first, lengths)
            raw = data[place + np.repeat(b, lengths)]
            values = (_LOWER[raw] if lower else raw).astype(U) + U(1)
            sums = np.add.reduceat(values * _factors(int(lengths.max()))[place], first)
            out[at : at + step] = mixed(sums + lengths.astype(U) * U(0x9E3779B97F4A7C15))
    return out


def spaced_words(data: np.ndarray, begins: np.ndarray, ends: np.ndarray) -> tuple[bytes, np.ndarray]:
    """All words with one space after each, and the byte at which each begins there."""
    lengths = ends - begins
    at = np.cumsum(lengths + 1) - lengths - 1
    out = np.full(int(lengths.sum()) + len(begins), 32, np.uint8)
    of_word = np.ones(len(out), bool)
    of_word[at + lengths] = False
    out[of_word] = data[~_SPACE[data]]
    return out.tobytes(), at


_BASE = 0x9E3779B97F4A7C15 | 5
_BASE_INVERSE = pow(_BASE, -1, 1 << 64)
_POWERS: dict[int, np.ndarray] = {}


def _powers(base: int, n: int) -> np.ndarray:
    have = _POWERS.get(base)
    if have is None or len(have) < n:
        steps = np.full(1 << max(10, (n - 1).bit_length()), base, U)
        steps[0] = 1
        with np.errstate(over="ignore"):
            have = _POWERS[base] = np.multiply.accumulate(steps)
    return have[:n]


def window_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """Hash of each ``size`` consecutive word hashes; windows over row borders are the caller's to leave out."""
    n = len(words) - size + 1
    if n <= 0:
        return np.zeros(0, U)
    with np.errstate(over="ignore"):
        sums = np.zeros(len(words) + 1, U)
        np.cumsum(words * _powers(_BASE_INVERSE, len(words)), out=sums[1:])
        return mixed((sums[size:] - sums[:-size]) * _powers(_BASE, n))


def signed(x: np.ndarray) -> pa.Array:
    return pa.array(x.view(np.int64))


def slices(batch: pa.RecordBatch, column: int, limit: int = 4 << 20):
    """Cut a batch so that a string column's slice has about ``limit`` bytes at most (one longer row stands alone)."""
    if batch.num_rows == 0:
        return
    _, offsets = byte_rows(batch.column(column))
    at = 0
    while at < batch.num_rows:
        to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + limit, side="right")) - 1)
        yield batch.slice(at, to - at)
        at = to
