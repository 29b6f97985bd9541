"""Arrow text columns as flat byte arrays, and hashes of words and windows over them."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Bytes of text that one step holds as arrays; a longer text makes a step of its own.
STEP_BYTES = 2 << 20

_MIX = np.array([0xBF58476D1CE4E5B9, 0x94D049BB133111EB], dtype=np.uint64)
BASE = 0x9E3779B97F4A7C55


def fixed(array: pa.Array, null: str | bytes = "") -> pa.Array:
    """The column with nulls replaced by `null`, offsets starting anywhere."""
    return array.fill_null(null) if array.null_count else array


def flat(array: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string or binary column and the n + 1 offsets of its values; nulls are empty."""
    array = fixed(array, b"" if pa.types.is_binary(array.type) or pa.types.is_large_binary(array.type) else "")
    wide = pa.types.is_large_string(array.type) or pa.types.is_large_binary(array.type)
    _, offsets, data = array.buffers()
    kind = np.int64 if wide else np.int32
    if offsets is None or len(array) == 0:
        return np.zeros(0, np.uint8), np.zeros(len(array) + 1, np.int64)
    at = np.frombuffer(offsets, kind)[array.offset : array.offset + len(array) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8)[at[0] : at[-1]] if data is not None else np.zeros(0, np.uint8)
    return raw, at - at[0]


def steps(batches: Iterator[pa.RecordBatch], column: str, limit: int = STEP_BYTES) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Pieces of the batches of about `limit` bytes of text: rows, bytes and offsets."""
    for batch in batches:
        if not batch.num_rows:
            continue
        data, at = flat(batch.column(column))
        lo = 0
        while lo < batch.num_rows:
            hi = max(lo + 1, int(np.searchsorted(at, at[lo] + limit, "right")) - 1)
            yield batch.slice(lo, hi - lo), data[at[lo] : at[hi]], at[lo : hi + 1] - at[lo]
            lo = hi


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of unsigned 64-bit values."""
    x = x ^ (x >> np.uint64(30))
    x = x * _MIX[0]
    x = x ^ (x >> np.uint64(27))
    x = x * _MIX[1]
    return x ^ (x >> np.uint64(31))


#: A 64-bit value for each byte, so that short strings already fill the word.
BYTE_VALUES = mixed(np.arange(1, 257, dtype=np.uint64) * np.uint64(BASE))


def powers(n: int, base: int = BASE) -> np.ndarray:
    """base ** 0 .. base ** (n - 1), modulo 2 ** 64."""
    out = np.ones(max(n, 1), np.uint64)
    if n > 1:
        out[1:] = np.uint64(base)
        out = np.multiply.accumulate(out)
    return out[:n]


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each of the ascending, disjoint, non-empty byte spans [start, end)."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    lengths = ends - starts
    within = np.ones(int(lengths.sum()), np.int64)
    first = np.cumsum(lengths) - lengths
    within[0] = 0
    within[first[1:]] = 1 - lengths[:-1]
    within = np.cumsum(within)
    picked = data[np.repeat(starts, lengths) + within]
    value = BYTE_VALUES[picked] * powers(int(lengths.max()))[within]
    return mixed(np.add.reduceat(value, first) + lengths.astype(np.uint64))


def words(data: np.ndarray, at: np.ndarray, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the maximal runs of bytes marked in `inside` (256 booleans), and the row of each run.

    Runs never cross rows.
    """
    if not len(data):
        none = np.zeros(0, np.int64)
        return none, none, none
    on = inside[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[at] = True
    begins = on.copy()
    begins[1:] &= ~on[:-1] | edge[1:-1]
    stops = on.copy()
    stops[:-1] &= ~on[1:] | edge[1:-1]
    starts, ends = np.flatnonzero(begins), np.flatnonzero(stops) + 1
    return starts, ends, np.searchsorted(at, starts, "right") - 1


#: Bytes of words: digits, ASCII letters, and every byte of a character outside ASCII.
WORD_BYTES = np.zeros(256, bool)
WORD_BYTES[0x30:0x3A] = WORD_BYTES[0x41:0x5B] = WORD_BYTES[0x61:0x7B] = WORD_BYTES[0x80:] = True

#: Lower-cases A-Z.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 32


def word_table(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Hash, start, end and row of every lower-cased word."""
    starts, ends, rows = words(data, at, WORD_BYTES)
    return span_hashes(LOWER[data], starts, ends), starts, ends, rows


def runs_of(hashes: np.ndarray, n: int) -> np.ndarray:
    """Hash of the n values from each place on; length len(hashes) - n + 1, across row borders too."""
    m = len(hashes) - n + 1
    if m <= 0:
        return np.zeros(0, np.uint64)
    power, out = powers(n), np.zeros(m, np.uint64)
    for k in range(n):
        out += hashes[k : k + m] * power[n - 1 - k]
    return mixed(out)


def row_counts(rows: np.ndarray, n: int) -> np.ndarray:
    """How many entries each of n rows has."""
    return np.bincount(rows, minlength=n).astype(np.int64)
