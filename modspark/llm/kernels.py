"""Vectorised hashing of texts inside tasks: bytes of many texts at a time as numpy arrays.

Memory is bounded by the size of a piece, not by the number or length of the texts.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from typing import NamedTuple

import numpy as np
import pyarrow as pa

PIECE_BYTES = 1 << 17
_MASK = (1 << 64) - 1
_BASE = 0xD6E8FEB86659FD93  # 3 modulo 8, so that its powers repeat late
_MIX = np.uint64(0xFF51AFD7ED558CCD)


def _byte_values(lower: bool) -> np.ndarray:
    """A fixed 64-bit value for each byte (splitmix64); capitals as small letters if ``lower``."""
    out, state = [], 0x2545F4914F6CDD1D
    for _ in range(256):
        state = (state + 0x9E3779B97F4A7C15) & _MASK
        z = state
        z = ((z ^ (z >> 30)) * 0xBF58476D1CE4E5B9) & _MASK
        z = ((z ^ (z >> 27)) * 0x94D049BB133111EB) & _MASK
        out.append(z ^ (z >> 31))
    if lower:
        out[65:91] = out[97:123]
    return np.array(out, dtype=np.uint64)


BYTE_VALUES, LOWER_VALUES = _byte_values(False), _byte_values(True)
IS_BLANK = np.zeros(256, dtype=bool)
IS_BLANK[[0x20, *range(0x09, 0x0E)]] = True
# ASCII letters and digits, and every byte of a longer character.
IS_ALNUM = np.zeros(256, dtype=bool)
IS_ALNUM[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True


class _Powers:
    up = down = np.ones(1, dtype=np.uint64)

    @classmethod
    def of(cls, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(cls.up) < n:
            for name, base in (("up", _BASE), ("down", pow(_BASE, -1, 1 << 64))):
                factors = np.full(n, base, dtype=np.uint64)
                factors[0] = 1
                setattr(cls, name, np.multiply.accumulate(factors))
        return cls.up, cls.down


def mix(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(33))
    x = x * _MIX
    return x ^ (x >> np.uint64(32))


class Slices:
    """Hashes of any slices of a piece: equal slices hash alike wherever they stand."""

    def __init__(self, data: np.ndarray, values: np.ndarray = BYTE_VALUES):
        n = len(data)
        up, self._down = _Powers.of(n + 1)
        self._sums = np.zeros(n + 1, dtype=np.uint64)
        np.cumsum(values[data] * up[:n], out=self._sums[1:])

    def hashes(self, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((self._sums[end] - self._sums[begin]) * self._down[begin])

    def windows(self, width: int) -> np.ndarray:
        n = len(self._sums) - width
        return mix((self._sums[width:] - self._sums[:n]) * self._down[:n])


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts of an Arrow column and the n + 1 places where texts start and end."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    width = np.int64 if pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type) else np.int32
    _, places, data = column.buffers()
    if not len(column):
        return np.zeros(0, dtype=np.uint8), np.zeros(1, dtype=np.int64)
    at = np.frombuffer(places, dtype=width)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None and data.size else np.zeros(0, dtype=np.uint8)
    return raw[at[0] : at[-1]], at - at[0]


class Piece(NamedTuple):
    """Texts ``first`` to ``first + len(starts) - 1``, or a part of one long text from byte ``base``."""

    first: int
    data: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    base: int


def pieces(column: pa.Array, overlap: int, limit: int = PIECE_BYTES) -> Iterator[Piece]:
    """Whole texts of together ``limit`` bytes, and parts of longer texts that share ``overlap`` bytes."""
    data, at = text_bytes(column)
    n, first = len(at) - 1, 0
    while first < n:
        last = max(int(np.searchsorted(at, at[first] + limit, side="right")) - 1, first + 1)
        begin, end = int(at[first]), int(at[last])
        if end - begin <= limit:
            yield Piece(first, data[begin:end], at[first:last] - begin, at[first + 1 : last + 1] - begin, 0)
        else:  # one long text
            for p in range(0, max(1, end - begin - overlap), limit - overlap):
                part = data[begin + p : min(begin + p + limit, end)]
                yield Piece(first, part, np.zeros(1, dtype=np.int64), np.array([len(part)]), p)
        first = last


class Words(NamedTuple):
    """Hashes of words in order, and for each text the range of its words.  ``heads``: for each asked
    length the hashes of the words' first bytes, 0 for words that are not longer."""

    hashes: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    heads: list[np.ndarray]


def word_groups(
    column: pa.Array, inside: np.ndarray, limit: int = PIECE_BYTES, heads: Sequence[int] = ()
) -> Iterator[tuple[int, Words]]:
    """For groups of texts: the number of the first text, and hashes of all words in lower case (A-Z).

    ``inside`` tells which bytes belong to words.  A longer text is hashed in parts that end between
    words (a word longer than a part is hashed by its parts in order).
    """
    data, at = text_bytes(column)
    n, first = len(at) - 1, 0
    while first < n:
        last = max(int(np.searchsorted(at, at[first] + limit, side="right")) - 1, first + 1)
        begin, end = int(at[first]), int(at[last])
        found, places, begun = [], [], []
        p = begin
        while p < end:
            stop = end if end - p <= limit else _between_words(data, p, p + limit, inside)
            hashes, starts, own_heads = _words(data[p:stop], at[first:last] - p, inside, heads)
            found.append(hashes)
            places.append(starts + p)
            begun.append(own_heads)
            p = stop
        hashes = np.concatenate(found) if found else np.zeros(0, dtype=np.uint64)
        where = np.concatenate(places) if places else np.zeros(0, dtype=np.int64)
        yield first, Words(
            hashes, np.searchsorted(where, at[first:last]), np.searchsorted(where, at[first + 1 : last + 1]),
            [np.concatenate(x) for x in zip(*begun, strict=True)],
        )
        first = last


def _between_words(data: np.ndarray, begin: int, end: int, inside: np.ndarray) -> int:
    gaps = np.flatnonzero(~inside[data[begin:end]])
    return begin + int(gaps[-1]) + 1 if len(gaps) else end


def _words(
    data: np.ndarray, text_starts: np.ndarray, inside: np.ndarray, heads: Sequence[int]
) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    is_word = inside[data]
    before = np.empty_like(is_word)
    before[:1] = False
    before[1:] = is_word[:-1]
    breaks = text_starts[(text_starts > 0) & (text_starts < len(data))]
    starts_mask = is_word & ~before
    starts_mask[breaks] = is_word[breaks]  # words do not go on in the next text
    begin = np.flatnonzero(starts_mask)
    ends_mask = np.empty_like(is_word)
    ends_mask[:-1] = is_word[:-1] & (~is_word[1:] | starts_mask[1:])
    ends_mask[-1:] = is_word[-1:]
    end = np.flatnonzero(ends_mask) + 1
    slices = Slices(data, LOWER_VALUES)
    first = [np.where(end - begin > k, slices.hashes(begin, np.minimum(begin + k, end)), np.uint64(0)) for k in heads]
    return slices.hashes(begin, end), begin, first


def longs(x: np.ndarray) -> pa.Array:
    return pa.array(x.view(np.int64) if x.dtype == np.uint64 else x.astype(np.int64))
