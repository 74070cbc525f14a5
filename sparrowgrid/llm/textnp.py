"""Vectorised word and shingle hashing over Arrow string columns.

Texts are never decoded row by row: the functions here work on the UTF-8 bytes of a whole Arrow batch at a time,
in slices of about ``SLICE`` bytes so that memory stays bounded however large a batch is. A text longer than a slice
is a slice of its own.
"""

from __future__ import annotations

import numpy as np

SLICE = 1 << 20

_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_POLY = np.uint64(0x9E3779B97F4A7C15 | 1)
_rng = np.random.Generator(np.random.PCG64(20240101))
_BYTE = _rng.integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
#: Odd multipliers for the places of a word in a shingle or seed.
PLACE = _rng.integers(0, 1 << 63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)

#: Bytes that part words under ``[^\x20\x09-\x0D]+``.
SPACES = np.zeros(256, bool)
SPACES[[0x20, *range(0x09, 0x0E)]] = True
#: Bytes that part words under ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]+`` once A-Z are lower-cased.
NOT_ALNUM = np.zeros(256, bool)
NOT_ALNUM[[*range(0x00, 0x30), *range(0x3A, 0x61), *range(0x7B, 0x80)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser (splitmix64), element-wise."""
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


def powers(n: int) -> np.ndarray:
    out = np.full(max(n, 1), _POLY)
    out[0] = 1
    return np.multiply.accumulate(out)


_POWERS = powers(4096)


def slices(column) -> list[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets of the rows in them) for slices of a string column; nulls are empty."""
    import pyarrow as pa

    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks() if column.num_chunks != 1 else column.chunk(0)
    if column.null_count:
        column = column.fill_null("")
    wide = pa.types.is_large_string(column.type)
    _, off, data = column.buffers()
    offsets = np.frombuffer(off, np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64) if len(column) else np.zeros(1, np.int64)
    buf = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    out, first = [], 0
    while first < len(column):
        end = max(first + 1, int(np.searchsorted(offsets, offsets[first] + SLICE, "right")) - 1)
        end = min(end, len(column))
        out.append((first, end, buf[offsets[first] : offsets[end]], offsets[first : end + 1] - offsets[first]))
        first = end
    return out


def words(buf: np.ndarray, offsets: np.ndarray, parts: np.ndarray = SPACES, lower: bool = True) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(hash, start byte, end byte) of every word, and the rows' offsets into them. Rows never share a word."""
    if lower:
        buf = LOWER[buf]
    inside = ~parts[buf]
    edge = np.zeros(len(buf) + 1, bool)
    edge[offsets] = True
    before = np.empty(len(buf), bool)
    if len(buf):
        before[0], before[1:] = False, inside[:-1]
    starts = np.flatnonzero(inside & (~before | edge[:-1]))
    after = np.empty(len(buf), bool)
    if len(buf):
        after[-1], after[:-1] = False, inside[1:]
    ends = np.flatnonzero(inside & (~after | edge[1:])) + 1
    rows = np.searchsorted(starts, offsets)
    return word_hashes(buf, starts, ends), starts, ends, rows


def word_hashes(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of the given byte spans, which must not overlap and must be in order."""
    global _POWERS
    if not len(starts):
        return np.zeros(0, np.uint64)
    lengths = ends - starts
    if (most := int(lengths.max())) > len(_POWERS):
        _POWERS = powers(2 * most)
    at = np.cumsum(lengths) - lengths
    place = np.arange(int(lengths.sum())) - np.repeat(at, lengths)
    byte = buf[place + np.repeat(starts, lengths)]
    return mix(np.add.reduceat(_BYTE[byte] * _POWERS[place], at) + lengths.astype(np.uint64) * PLACE[63])


def shingles(hashes: np.ndarray, rows: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the n-word shingles, and the rows' offsets into them.

    A row of 1 to n-1 words gives one hash of its whole sequence; a row without words gives none.
    """
    count = np.diff(rows)
    total = len(hashes)
    if not total:
        return np.zeros(0, np.uint64), np.zeros(len(rows), np.int64)
    out = np.where(count >= n, count - n + 1, (count > 0).astype(count.dtype))
    full = np.zeros(max(total - n + 1, 0), np.uint64)
    for k in range(n):
        full += hashes[k : k + len(full)] * PLACE[k]
    full = mix(full)
    offsets = np.concatenate([[0], np.cumsum(out)]).astype(np.int64)
    result = np.empty(offsets[-1], np.uint64)
    first = np.arange(offsets[-1]) - np.repeat(offsets[:-1], out) + np.repeat(rows[:-1], out)
    short = np.repeat(count < n, out)
    result[~short] = full[first[~short]]
    for i in np.flatnonzero((count > 0) & (count < n)):
        w = hashes[rows[i] : rows[i + 1]]
        result[offsets[i]] = mix(PLACE[40 + len(w) : 41 + len(w)] + (w * PLACE[: len(w)]).sum(dtype=np.uint64))[0]
    return result, offsets
