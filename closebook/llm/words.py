"""Words of Arrow text batches as 64-bit hashes, computed by numpy on the UTF-8 bytes.

Both word definitions of the operators separate words by ASCII characters only, so
splitting the bytes equals splitting the code points.  No function loops over words.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa

#: texts are hashed in runs of about this many bytes, which bounds the working arrays
RUN_BYTES = 1 << 20

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def _table(separators: str) -> np.ndarray:
    table = np.ones(256, bool)
    table[list(separators.encode())] = False
    return table


#: words are what lies between blanks, tabs and line ends
BLANK_SEPARATED = _table(" \t\n\x0b\x0c\r")
#: words are runs of digits, letters a-z and everything outside ASCII, after lower-casing
ALPHANUMERIC = np.ones(256, bool)
ALPHANUMERIC[:128] = [chr(c).isalnum() for c in range(128)]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers whose output bits all depend on all input bits."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


_BYTE_CODES = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
_BASE = 0xD1342543DE82EF95
_ROUNDS = mix(np.arange(301, 365, dtype=np.uint64)) | np.uint64(1)


@cache
def _powers(length: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the odd base modulo 2**64, and of its inverse."""
    out = []
    for base in (_BASE, pow(_BASE, -1, 1 << 64)):
        steps = np.full(length, base, np.uint64)
        steps[0] = 1
        out.append(np.multiply.accumulate(steps))
    return out[0], out[1]


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column and the offsets of its rows; nulls are empty."""
    column = column.fill_null("").cast(pa.large_string())
    _, offsets, data = column.buffers()
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    at = np.frombuffer(offsets, np.int64)[column.offset:column.offset + len(column) + 1]
    if data is None:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    return np.frombuffer(data, np.uint8)[at[0]:at[-1]], at - at[0]


def runs(offsets: np.ndarray, limit: int = RUN_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of rows that hold about `limit` bytes, always whole rows."""
    first, rows = 0, len(offsets) - 1
    while first < rows:
        last = int(np.searchsorted(offsets, offsets[first] + limit, "right")) - 1
        last = min(rows, max(first + 1, last))
        yield first, last
        first = last


def word_bounds(data: np.ndarray, offsets: np.ndarray,
                table: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the words, and for each row the number of its first word."""
    inside = table[data]
    start, end = inside.copy(), inside.copy()
    start[1:] &= ~inside[:-1]
    end[:-1] &= ~inside[1:]
    borders = offsets[(offsets > 0) & (offsets < len(data))]
    start[borders] = inside[borders]
    end[borders - 1] = inside[borders - 1]
    starts = np.flatnonzero(start)
    return starts, np.flatnonzero(end) + 1, np.searchsorted(starts, offsets)


def hash_words(data: np.ndarray, offsets: np.ndarray, table: np.ndarray,
               lower: bool = True, prefix: int | None = None) -> tuple[np.ndarray, np.ndarray]:
    """A hash for each word, and for each row the number of its first word.

    With `prefix` only the word's first bytes, so many of them, are hashed.
    """
    hashes, firsts, total = [], [np.zeros(1, np.int64)], 0
    for first, last in runs(offsets):
        own = offsets[first:last + 1] - offsets[first]
        part = data[offsets[first]:offsets[last]]
        if lower:
            part = _LOWER[part]
        if len(part):
            starts, ends, rows = word_bounds(part, own, table)
            if prefix is not None:
                ends = np.minimum(ends, starts + prefix)
            size = RUN_BYTES
            while size < len(part):
                size *= 2
            up, down = _powers(size)
            sums = np.zeros(len(part) + 1, np.uint64)
            np.cumsum(_BYTE_CODES[part] * up[:len(part)], out=sums[1:])
            hashes.append(mix((sums[ends] - sums[starts]) * down[starts]))
        else:
            rows = np.zeros(len(own), np.int64)
        firsts.append(rows[1:] + total)
        total += int(rows[-1])
    return (np.concatenate(hashes) if hashes else np.zeros(0, np.uint64),
            np.concatenate(firsts))


def shingles(hashes: np.ndarray, firsts: np.ndarray,
             words: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of `words` consecutive words, and for each row the number of its first one.

    A row of fewer words, but not none, has one shingle: all of them.
    """
    counts = np.diff(firsts)
    padded = np.concatenate([hashes, np.zeros(words, np.uint64)])
    total = np.zeros(len(hashes), np.uint64)
    for k in range(words):
        total += padded[k:k + len(hashes)] * _ROUNDS[k]
    whole = mix(total)
    made = np.where(counts >= words, counts - words + 1, np.minimum(counts, 1))
    first = np.concatenate([np.zeros(1, np.int64), np.cumsum(made)])
    at = np.arange(first[-1]) - np.repeat(first[:-1], made) + np.repeat(firsts[:-1], made)
    out = whole[at]
    for row in np.flatnonzero((counts > 0) & (counts < words)):
        own = hashes[firsts[row]:firsts[row + 1]]
        sums = (own * _ROUNDS[:len(own)]).sum(dtype=np.uint64)
        out[first[row]] = mix(np.array([sums], np.uint64) ^ np.uint64(len(own)))[0]
    return out, first


def row_hashes(hashes: np.ndarray, firsts: np.ndarray) -> np.ndarray:
    """A hash for each row of its whole sequence of words."""
    size = RUN_BYTES
    while size < len(hashes):
        size *= 2
    up, down = _powers(size)
    sums = np.zeros(len(hashes) + 1, np.uint64)
    np.cumsum(hashes * up[:len(hashes)], out=sums[1:])
    begin, end = firsts[:-1], firsts[1:]
    own = (sums[end] - sums[begin]) * down[np.minimum(begin, size - 1)]
    return mix(own + _ROUNDS[0] * (end - begin).astype(np.uint64))


def line_bounds(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Offsets of the lines of all rows, and for each line its row and its number in the row."""
    after = np.flatnonzero(data == ord("\n")) + 1
    starts = np.concatenate([after, offsets[:-1]])
    # the empty line behind a last line end stands before the row that begins there
    order = np.argsort(starts, kind="stable")
    opens = order >= len(after)
    row = np.cumsum(opens) - 1
    number = np.arange(len(order)) - np.flatnonzero(opens)[row]
    return np.append(starts[order], offsets[-1]), row, number
