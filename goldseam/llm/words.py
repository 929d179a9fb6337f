"""Words of whole Arrow columns of text as 64-bit numbers, computed on the bytes at once."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa

_PLACES = 64
_SPACE = np.zeros(256, bool)
_SPACE[[32, *range(9, 14)]] = True
# One random number for each byte at each place: words hash to the sum over their bytes.
_NOISE = np.random.default_rng(20240229).integers(0, 2**64, (_PLACES, 256), np.uint64).ravel()
_LONG = np.uint64(0x9E3779B97F4A7C15)
_CHUNK = 1 << 20


def text_slices(column: pa.Array, limit: int = 4 << 20) -> Iterator[tuple[int, int]]:
    """Row ranges of a string column with about ``limit`` bytes each."""
    size = np.diff(_offsets(column))
    start, held = 0, 0
    for i, n in enumerate(size.tolist()):
        held += n
        if held >= limit:
            yield start, i + 1
            start, held = i + 1, 0
    if start < len(column):
        yield start, len(column)


def _offsets(column: pa.Array) -> np.ndarray:
    kind = np.int64 if pa.types.is_large_string(column.type) else np.int32
    return np.frombuffer(column.buffers()[1], kind)[column.offset : column.offset + len(column) + 1].astype(np.int64)


def hashed_words(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """``word_numbers`` without the places."""
    return word_numbers(column)[:2]


def word_numbers(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Numbers of all words ``[^\\x20\\x09-\\x0D]+`` of the texts, one text after another, and the
    place of each text's first word (one entry more than texts); then the byte at which each word
    begins. Null texts have no words.

    Two different words of up to 64 bytes get the same number with probability 2**-64; a longer
    one takes part as a whole, its places turned by a factor for every 64 bytes.
    """
    data, ends = column_bytes(column)
    if not len(data):
        return np.zeros(0, np.uint64), np.zeros(len(ends), np.int64), np.zeros(0, np.int64)
    space = _SPACE[data]
    begins = ~space
    begins[1:] &= space[:-1]
    heads = ends[:-1][np.diff(ends) > 0]
    begins[heads] = ~space[heads]
    cuts = space.copy()
    cuts[heads] = True
    parts, lo = [], 0
    while lo < len(data):
        hi = min(lo + _CHUNK, len(data))
        if hi < len(data):
            step = int(np.argmax(cuts[hi:]))
            hi = hi + step if cuts[hi + step] else len(data)
        parts.append(_hash_bytes(data[lo:hi], space[lo:hi], np.flatnonzero(begins[lo:hi])))
        lo = hi
    at = np.flatnonzero(begins)
    return np.concatenate(parts), np.searchsorted(at, ends), at


def _hash_bytes(data: np.ndarray, space: np.ndarray | None, at: np.ndarray) -> np.ndarray:
    if not len(at):
        return np.zeros(0, np.uint64)
    place = np.arange(at[0], len(data), dtype=np.int32) - np.repeat(at.astype(np.int32), np.diff(at, append=len(data)))
    terms = _NOISE[((place & (_PLACES - 1)) << 8) | data[at[0] :]]
    far = place >= _PLACES
    if space is not None:
        terms[space[at[0] :]] = 0
        far &= ~space[at[0] :]
    far = np.flatnonzero(far)
    if len(far):
        turns = place[far] // _PLACES
        powers = np.multiply.accumulate(np.full(int(turns.max()) + 1, _LONG, np.uint64))
        terms[far] = (terms[far] ^ (terms[far] >> np.uint64(31))) * powers[turns]
    return np.add.reduceat(terms, at - at[0])


def hashed_spans(data: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """A number for each span of bytes, from one start to the next; the first start is 0."""
    out, lo = [], 0
    while lo < len(starts):
        hi = max(lo + 1, int(np.searchsorted(starts, starts[lo] + _CHUNK)))
        end = starts[hi] if hi < len(starts) else len(data)
        out.append(_hash_bytes(data[starts[lo] : end], None, starts[lo:hi] - starts[lo]))
        lo = hi
    return np.concatenate(out) if out else np.zeros(0, np.uint64)


def column_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts of a string column, and where each begins (one entry more)."""
    ends = _offsets(column)
    data = column.buffers()[2]
    if data is None:
        return np.zeros(0, np.uint8), ends - ends[:1]
    return np.frombuffer(data, np.uint8)[ends[0] : ends[-1]], ends - ends[0]


def grouped(numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The kind of each number, and where each kind stands first."""
    kind, kinds = pd.factorize(numbers)
    first = np.empty(len(kinds), np.int64)
    first[kind[::-1]] = np.arange(len(kind) - 1, -1, -1)
    return kind, first


def mixed(x: np.ndarray) -> np.ndarray:
    """64-bit numbers scrambled one to one."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))
