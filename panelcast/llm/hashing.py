"""Word hashes of whole batches of texts, with numpy.

Words are runs of bytes other than blanks; as blanks are ASCII, these are the
words of the text's code points too. A hash is a sum over the bytes of a random
number for the byte times a power for its place in the word, mixed at the end.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

_RANDOM = np.random.default_rng(20)
_BYTE = _RANDOM.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BYTE[65:91] = _BYTE[97:123]  # A-Z count as a-z
_BASE = np.uint64(0x9E3779B97F4A7C15)
_BLANK = np.zeros(256, dtype=bool)
_BLANK[[9, 10, 11, 12, 13, 32]] = True


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit over all."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def powers(n: int) -> np.ndarray:
    """base ** 0 .. base ** (n - 1) modulo 2 ** 64, by doubling."""
    out = np.ones(1, dtype=np.uint64)
    while len(out) < n:
        out = np.concatenate([out, out * (out[-1:] * _BASE)])
    return out[:n]


def texts(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of a string column and the offset of each text; nulls are empty."""
    column = column.cast(pa.large_string()).fill_null("") if column.null_count else column.cast(pa.large_string())
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    whole = np.frombuffer(data, dtype=np.uint8) if data else np.empty(0, dtype=np.uint8)
    return whole[offsets[0] : offsets[-1]], offsets - offsets[0]


def slices(batch: pa.RecordBatch, index: int, most: int = 4_000_000) -> Iterator[pa.RecordBatch]:
    """Parts of a batch whose texts have about so many bytes, one text at least."""
    column = batch.column(index).cast(pa.large_string())
    at = 0
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    while at < batch.num_rows:
        to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + most, side="right")) - 1)
        yield batch.slice(at, to - at)
        at = to


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each word, A-Z as a-z, and the first word of each text, with the total at the end."""
    inside = ~_BLANK[data]
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    cuts = offsets[(offsets > 0) & (offsets < len(data))]
    first[cuts] = inside[cuts]  # a word ends with its text
    starts = np.flatnonzero(first)
    bounds = np.searchsorted(starts, offsets)
    if not len(starts):
        return np.empty(0, dtype=np.uint64), bounds
    at = np.flatnonzero(inside)
    word = np.cumsum(first[at]) - 1
    place = at - starts[word]
    table = powers(int(place.max()) + 1)
    begin = np.flatnonzero(first[at])
    return mix(np.add.reduceat(_BYTE[data[at]] * table[place], begin)), bounds


def windows(hashes: np.ndarray, width: int) -> np.ndarray:
    """Hash of every run of `width` neighbours in an array."""
    n = len(hashes) - width + 1
    out = np.zeros(max(n, 0), dtype=np.uint64)
    for i in range(width if n > 0 else 0):
        out = mix(out + hashes[i : i + n] + np.uint64(i + 1))
    return out


def planes(values: np.ndarray, width: int) -> bytes:
    """The `width` upper bytes of 64-bit numbers, plane by plane, so that equal bytes stand together."""
    return np.ascontiguousarray(values.astype(">u8").view(np.uint8).reshape(-1, 8)[:, :width].T).tobytes()


def unplaned(data: bytes, width: int) -> np.ndarray:
    parts = np.frombuffer(data, dtype=np.uint8).reshape(width, -1)
    out = np.zeros((parts.shape[1], 8), dtype=np.uint8)
    out[:, :width] = parts.T
    return out.reshape(-1).view(">u8").astype(np.uint64)


def edges(ranges: int) -> np.ndarray:
    """Bounds between equal ranges of 64-bit numbers."""
    return (np.arange(1, ranges, dtype=object) * (1 << 64) // ranges).astype(np.uint64)
