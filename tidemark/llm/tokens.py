"""Words, shingles and hashes of whole Arrow text columns, as numpy arrays.

Words are runs of UTF-8 bytes, so every function works on the bytes of a batch at once, without a Python object per
word. ``batches`` cuts a column into pieces of bounded size; a text longer than the bound is a piece of its own.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

PIECE = 1 << 20
U64 = np.uint64
_MUL = U64(0x9E3779B97F4A7C15)
_STEP = U64(0xD1342543DE82EF95)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers in which every input bit reaches every output bit."""
    x = x ^ (x >> U64(30))
    x *= U64(0xBF58476D1CE4E5B9)
    x ^= x >> U64(27)
    x *= U64(0x94D049BB133111EB)
    x ^= x >> U64(31)
    return x


def _class_tables(separators: set[int]) -> tuple[np.ndarray, np.ndarray]:
    lower = np.arange(256)
    lower[65:91] += 32
    is_word = np.array([int(lower[b]) not in separators for b in range(256)])
    value = mix((lower.astype(U64) + U64(1)) * _MUL) | U64(1)
    return is_word, np.where(is_word, value, U64(0))


#: Words are what stands between ASCII white space, with A-Z lower-cased.
SPACED = _class_tables({0x20, *range(0x09, 0x0E)})
#: Words are runs of ASCII letters and digits and of everything beyond ASCII, with A-Z lower-cased.
LETTERS = _class_tables({*range(0x30), *range(0x3A, 0x61), *range(0x7B, 0x80)})
#: Lines, as they are but for letter case.
LINES = _class_tables({0x0A})

_powers = np.cumprod(np.full(1 << 12, _STEP))


def _power(n: int) -> np.ndarray:
    global _powers
    if n > len(_powers):
        _powers = np.cumprod(np.full(max(n, 2 * len(_powers)), _STEP))
    return _powers


@functools.cache
def _powers_of_piece() -> tuple[np.ndarray, np.ndarray]:
    """The powers for a whole piece, and what makes the power at each place the first one."""
    back = np.full(2 * PIECE, U64(pow(int(_STEP), -1, 2**64)))
    back[0] = 1
    return np.cumprod(np.full(2 * PIECE, _STEP)), np.cumprod(back)


def text_bytes(column) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts and where each begins and ends. Nulls are empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string()).fill_null("")
    _, where, data = column.buffers()
    offsets = np.frombuffer(where, np.int64)[column.offset : column.offset + len(column) + 1]
    if data is None or not len(column):
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    return np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]], offsets - offsets[0]


def pieces(batch: pa.RecordBatch, text: str = "text", most: int = PIECE) -> Iterator[pa.RecordBatch]:
    """Slices of a batch of about ``most`` bytes of text each."""
    _, offsets = text_bytes(batch.column(text))
    begin = 0
    while begin < batch.num_rows:
        end = max(int(np.searchsorted(offsets, offsets[begin] + most, "right")) - 1, begin + 1)
        yield batch.slice(begin, end - begin)
        begin = end


def spans(data: np.ndarray, offsets: np.ndarray, kind=SPACED) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Begin and end of each word, and for each text where its words begin in these (one more entry than texts)."""
    inside = np.take(kind[0], data)
    last = inside.copy()
    last[:-1] = inside[:-1] > inside[1:]
    edge = offsets[offsets > 0] - 1
    last[edge] = inside[edge]
    begins, at = _begins(inside, offsets)
    return begins, np.flatnonzero(last) + 1, at


def _begins(inside: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    first = inside.copy()
    first[1:] = inside[1:] > inside[:-1]
    edge = offsets[offsets < len(inside)]
    first[edge] = inside[edge]
    begins = np.flatnonzero(first)
    return begins, np.searchsorted(begins, offsets)


def word_hashes(data: np.ndarray, begins: np.ndarray, kind=SPACED) -> np.ndarray:
    """A 64-bit hash of each word."""
    if not len(begins):
        return np.zeros(0, U64)
    if len(data) <= 2 * PIECE:
        ahead, back = _powers_of_piece()
        value = np.take(kind[1], data)
        value *= ahead[: len(data)]
        return mix(np.add.reduceat(value, begins) * back[begins])
    value = kind[1][data[begins[0] :]]
    length = np.diff(begins, append=len(data))
    place = np.arange(len(value)) - np.repeat(begins - begins[0], length)
    value *= _power(int(length.max()))[place]
    return mix(np.add.reduceat(value, begins - begins[0]))


def prefix_hashes(data: np.ndarray, begins: np.ndarray, ends: np.ndarray, sizes: range, kind=SPACED) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each size: which words have more bytes than that, and a hash of their first so many bytes."""
    if not len(begins):
        return
    value = kind[1][data[begins[0] :]]
    length = np.diff(begins, append=len(data))
    place = np.arange(len(value)) - np.repeat(begins - begins[0], length)
    total = np.concatenate(([U64(0)], np.cumsum(value * _power(int(length.max()))[place])))
    for k in sizes:
        longer = np.flatnonzero(ends - begins > k)
        at = begins[longer] - begins[0]
        yield longer, mix(total[at + k] - total[at] + U64(k * int(_MUL) % 2**64))


def words(column, kind=SPACED) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words of a column, and where each text's words begin."""
    data, offsets = text_bytes(column)
    begins, at = _begins(np.take(kind[0], data), offsets)
    return word_hashes(data, begins, kind), at


def shingles(hashes: np.ndarray, at: np.ndarray, k: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of k words in order, repeats included; a text of fewer words, but some, is one run."""
    n = np.diff(at)
    count = np.where(n >= k, n - k + 1, np.minimum(n, 1))
    starts = np.concatenate(([0], np.cumsum(count)))
    first = np.repeat(at[:-1] - starts[:-1], count) + np.arange(starts[-1])
    padded = np.concatenate((hashes, np.zeros(k, U64)))
    out = np.full(len(hashes), U64(k))
    for i in range(k):
        out = mix(out * _MUL + padded[i : i + len(hashes)])
    out = out[first]
    for t in np.flatnonzero((n > 0) & (n < k)).tolist():
        own = np.full(1, n[t], U64)
        for i in range(n[t]):
            own = mix(own * _MUL + padded[at[t] + i])
        out[starts[t]] = own[0]
    return out, starts


def distinct(values: np.ndarray, starts: np.ndarray) -> Iterator[np.ndarray]:
    """The sorted distinct values of each text."""
    for a, b in zip(starts[:-1], starts[1:], strict=True):
        own = np.sort(values[a:b])
        fresh = own[1:] != own[:-1]
        yield own if fresh.all() else own[np.concatenate(([True], fresh))]
