"""Arrow text columns as byte arrays: words, their hashes, rows in slices of bounded size.

Everything works on UTF-8 bytes. A NULL text counts as an empty one.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 1 << 20
_BASE = 0x9E3779B97F4A7C15
_MASK = (1 << 64) - 1

Slice = tuple[int, int, np.ndarray, np.ndarray]


def byte_set(members: bytes) -> np.ndarray:
    """Table that is True at the given byte values."""
    table = np.zeros(256, dtype=bool)
    table[list(members)] = True
    return table


SPACES = byte_set(b" \t\n\x0b\x0c\r")
#: all bytes but 0-9, a-z, A-Z and those of characters beyond ASCII
PUNCTUATION = byte_set(bytes(range(0x30)) + bytes(range(0x3A, 0x41)) + bytes(range(0x5B, 0x61)) + bytes(range(0x7B, 0x80)))
#: A-Z to a-z
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 0x20


def mix(values: np.ndarray) -> np.ndarray:
    """Spreads the bits of 64-bit values (the finaliser of splitmix64)."""
    values = values ^ (values >> np.uint64(30))
    values = values * np.uint64(0xBF58476D1CE4E5B9)
    values = values ^ (values >> np.uint64(27))
    values = values * np.uint64(0x94D049BB133111EB)
    return values ^ (values >> np.uint64(31))


#: a 64-bit value for each byte, A-Z as themselves or as a-z
BYTE_VALUES = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(_BASE))
FOLDED_VALUES = BYTE_VALUES[LOWER]


@lru_cache(maxsize=2)
def _powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    def series(base: int) -> np.ndarray:
        out = np.full(size, base, dtype=np.uint64)
        out[0] = 1
        return np.cumprod(out, dtype=np.uint64)

    return series(_BASE), series(pow(_BASE, -1, 1 << 64))


def powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the hash base and of its inverse, at least `size` of each."""
    room = 1 << 21
    while room < size:
        room *= 2
    return _powers(room)


def text_slices(column: pa.Array | pa.ChunkedArray, limit: int = SLICE_BYTES) -> Iterator[Slice]:
    """(first row, end row, bytes, offsets) for consecutive rows of about `limit` bytes together."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = pc.fill_null(column, "")
    rows = len(column)
    if not rows:
        return
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, ends, content = column.buffers()
    bounds = np.frombuffer(ends, dtype=np.int64 if wide else np.int32)
    bounds = bounds[column.offset : column.offset + rows + 1].astype(np.int64)
    data = np.frombuffer(content, dtype=np.uint8) if content is not None else np.empty(0, dtype=np.uint8)
    first = 0
    while first < rows:
        end = int(np.searchsorted(bounds, bounds[first] + limit, side="right")) - 1
        end = min(rows, max(first + 1, end))
        yield first, end, data[bounds[first] : bounds[end]], bounds[first : end + 1] - bounds[first]
        first = end


def word_bounds(data: np.ndarray, offsets: np.ndarray, separators: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the words, and for each row the index of its first word (one more entry at the end)."""
    inside = ~separators[data]
    begins, stops = inside.copy(), inside.copy()
    begins[1:] &= ~inside[:-1]
    stops[:-1] &= ~inside[1:]
    filled = offsets[1:] > offsets[:-1]
    heads, tails = offsets[:-1][filled], offsets[1:][filled] - 1
    begins[heads] = inside[heads]
    stops[tails] = inside[tails]
    starts = np.flatnonzero(begins)
    return starts, np.flatnonzero(stops) + 1, np.searchsorted(starts, offsets)


def prefix_hashes(data: np.ndarray, values: np.ndarray = BYTE_VALUES) -> np.ndarray:
    """Polynomial hashes of all prefixes, modulo 2^64."""
    out = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum(values[data] * powers(len(data) + 1)[0][: len(data)], out=out[1:])
    return out


def raw_span_hashes(prefixes: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hashes of spans that depend on their bytes alone."""
    return (prefixes[ends] - prefixes[starts]) * powers(len(prefixes))[1][starts]


def span_hashes(prefixes: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """As raw_span_hashes, with the length mixed in and all bits spread."""
    return mix(raw_span_hashes(prefixes, starts, ends) + (ends - starts).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def hash_of(word: str, fold: bool = False) -> int:
    """span_hashes() of one word."""
    data = np.frombuffer(word.encode(), dtype=np.uint8)
    prefixes = prefix_hashes(data, FOLDED_VALUES if fold else BYTE_VALUES)
    return int(span_hashes(prefixes, np.array([0]), np.array([len(data)]))[0])


#: a random odd factor for each place in a span; longer spans are digested instead
_LONG_SPAN = 1 << 12
_PLACE_FACTORS = mix(np.arange(1, _LONG_SPAN + 1, dtype=np.uint64) * np.uint64(0xD1B54A32D192ED03)) | np.uint64(1)


def span_names(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, fold: bool = False) -> np.ndarray:
    """64-bit names of spans, which follow one another, that depend on their bytes (A-Z as a-z if `fold`) alone.

    A name mixes two hashes: a polynomial, and the sum of the bytes times a random factor for each
    place. Bytes built so that the first one collides, as can be done for it, have different second ones.
    """
    if not len(starts):
        return np.empty(0, np.uint64)
    first = span_hashes(prefix_hashes(data, FOLDED_VALUES if fold else BYTE_VALUES), starts, ends)
    own = data[starts[0] :]
    place = np.arange(len(own), dtype=np.int32)
    place -= np.repeat((starts - starts[0]).astype(np.int32), np.diff(np.append(starts, len(data))))
    np.minimum(place, _LONG_SPAN - 1, out=place)
    sums = np.zeros(len(own) + 1, np.uint64)
    sums[1:] = _PLACE_FACTORS[place]
    sums[1:] *= LOWER[own] if fold else own
    np.cumsum(sums, out=sums)
    second = sums[ends - starts[0]] - sums[starts - starts[0]]
    for i in np.flatnonzero(ends - starts > _LONG_SPAN).tolist():
        long = data[starts[i] : ends[i]]
        second[i] = int.from_bytes(hashlib.blake2b((LOWER[long] if fold else long).tobytes(), digest_size=8).digest(), "big")
    return mix(first ^ mix(second * np.uint64(0x9FB21C651E98DF25) + np.uint64(1)))


def within(counts: np.ndarray) -> np.ndarray:
    """0, 1, 2, ... inside each group, for groups of these sizes one after another."""
    ends = np.cumsum(counts)
    return np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - counts, counts)
