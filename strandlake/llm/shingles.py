"""Word and shingle hashes of whole Arrow batches, by numpy."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

U = np.uint64
_rng = np.random.default_rng(20240607)
_BYTE = _rng.integers(1, 2**64, 256, dtype=U)
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_BASE = 0x9E3779B97F4A7C15 | 1
_UNBASE = pow(_BASE, -1, 2**64)
_powers: list[np.ndarray] = [np.ones(1, U), np.ones(1, U)]


def _power(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2 ** 64, for at least n places."""
    if len(_powers[0]) < n:
        size = 1 << (n - 1).bit_length()
        for k, b in enumerate((_BASE, _UNBASE)):
            factors = np.full(size, b, U)
            factors[0] = 1
            _powers[k] = np.multiply.accumulate(factors)
    return _powers[0], _powers[1]


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


def utf8(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts in a row, and where each begins (and the last ends); null counts as empty."""
    texts = pc.fill_null(texts, "")
    if not pa.types.is_large_string(texts.type):
        texts = texts.cast(pa.large_string())
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = texts.buffers()[2]
    flat = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]] if data is not None else np.empty(0, np.uint8)
    return flat, offsets - offsets[0]


def words(flat: np.ndarray, offsets: np.ndarray, lower: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hash of every word `[^\\x20\\x09-\\x0D]+`, and the index of the first word of each text (and
    the number of words)."""
    n = len(flat)
    if lower:
        flat = _LOWER[flat]
    inside = ~_SPACE[flat]
    first = np.zeros(n + 1, bool)
    first[offsets] = True
    starts = np.flatnonzero(inside & (first[:-1] | np.concatenate([[True], ~inside[:-1]])[:n]))
    ends = np.flatnonzero(inside & (first[1:] | np.concatenate([~inside[1:], [True]])[-n:] if n else inside)) + 1
    power, inverse = _power(n + 1)
    sums = np.zeros(n + 1, U)
    np.cumsum(_BYTE[flat] * power[:n], out=sums[1:])
    hashes = mix64((sums[ends] - sums[starts]) * inverse[starts] + (ends - starts).astype(U) * U(0xD6E8FEB86659FD93))
    return hashes, np.searchsorted(starts, offsets)


def shingles(w: np.ndarray, width: int) -> np.ndarray:
    """Hashes of all windows of `width` words; with fewer words, of the whole sequence; none without words."""
    if not len(w):
        return w
    size = min(width, len(w))
    out = np.full(len(w) - size + 1, size, U)
    for k in range(size):
        out = mix64(out * U(0x9FB21C651E98DF25) + w[k : len(w) - size + 1 + k])
    return out


def batches(batch: pa.RecordBatch, column: int, most_bytes: int = 1 << 22, most_rows: int = 512):
    """(first row, flat bytes, offsets) of runs of rows: about most_bytes of text, or a single longer text."""
    flat, offsets = utf8(batch.column(column))
    at, n = 0, len(offsets) - 1
    while at < n:
        to = min(max(at + 1, int(np.searchsorted(offsets, offsets[at] + most_bytes, "right")) - 1), at + most_rows, n)
        yield at, flat[offsets[at] : offsets[to]], offsets[at : to + 1] - offsets[at]
        at = to
