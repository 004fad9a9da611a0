"""Words and rolling hashes of many texts at once, in numpy over Arrow string buffers.

A word is a maximal run of bytes outside 0x20 and 0x09-0x0D.  These bytes never occur
inside a multi-byte UTF-8 character, so the byte view and the character view agree.

Hashes are polynomials modulo 2**64 read off prefix sums: the hash of bytes [s, e) is
(H[e] - H[s]) * base**-s, so every word, line or n-gram of a chunk of texts costs two
look-ups.  A final mixing step spreads the bits.  Equal inputs have equal hashes.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

MASK = (1 << 64) - 1
BYTE_BASE = 0x9E3779B97F4A7C15 | 1
WORD_BASE = 0xD6E8FEB86659FD93 | 1
CHUNK_BYTES = 1 << 21

SPACE = np.zeros(256, dtype=bool)
SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def powers(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers 0..n of ``base`` and of its inverse modulo 2**64."""
    have = _POWERS.get(base)
    if have is None or len(have[0]) <= n:
        size = max(n + 1, CHUNK_BYTES + 1)
        both = []
        for b in (base, pow(base, -1, 1 << 64)):
            p = np.full(size, np.uint64(b), dtype=np.uint64)
            p[0] = 1
            both.append(np.cumprod(p))
        have = both[0], both[1]
        if size <= 4 * CHUNK_BYTES:  # a longer text is rare; its table is not kept
            _POWERS[base] = have
    return have


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values (a bijection)."""
    x = x ^ (x >> np.uint64(31))
    x = x * np.uint64(0x7FB5D329728EA185)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x81DADEF4BC2DD44D)
    return x ^ (x >> np.uint64(33))


def spans_hash(values: np.ndarray, starts: np.ndarray, ends: np.ndarray, base: int) -> np.ndarray:
    """Hash of values[s:e] for every span; ``values`` are unsigned 64-bit, none of them 0."""
    up, down = powers(base, len(values))
    sums = np.zeros(len(values) + 1, dtype=np.uint64)
    np.cumsum(values * up[: len(values)], out=sums[1:])
    h = (sums[ends] - sums[starts]) * down[starts]
    return mix(h ^ ((ends - starts).astype(np.uint64) << np.uint64(40)))


@dataclass
class Chunk:
    """Consecutive texts as one byte array; text i is data[offsets[i]:offsets[i + 1]]."""

    first: int
    data: np.ndarray
    offsets: np.ndarray
    null: np.ndarray

    @property
    def rows(self) -> int:
        return len(self.offsets) - 1


def chunks(column: pa.Array, max_bytes: int = CHUNK_BYTES) -> Iterator[Chunk]:
    """Cut a string column into runs of texts of about ``max_bytes`` (one long text is one run)."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    null = np.asarray(column.is_null())
    column = column.cast(pa.large_string())
    if len(column) == 0:
        return
    buffers = column.buffers()
    off = np.frombuffer(buffers[1], dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(buffers[2], dtype=np.uint8) if buffers[2] is not None else np.zeros(0, np.uint8)
    first = 0
    while first < len(column):
        last = max(first + 1, int(np.searchsorted(off, off[first] + max_bytes, side="right")) - 1)
        last = min(last, len(column))
        yield Chunk(first, data[off[first] : off[last]], off[first : last + 1] - off[first], null[first:last])
        first = last


@dataclass
class Words:
    """Words of a chunk in order: byte spans, and for text i the words bounds[i]..bounds[i + 1]."""

    starts: np.ndarray
    ends: np.ndarray
    bounds: np.ndarray

    @property
    def text_of(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.bounds) - 1), np.diff(self.bounds))


def find_words(chunk: Chunk) -> Words:
    n = len(chunk.data)
    if n == 0:
        empty = np.zeros(0, dtype=np.int64)
        return Words(empty, empty, np.zeros(chunk.rows + 1, dtype=np.int64))
    word = ~SPACE[chunk.data]
    edge = np.zeros(n + 1, dtype=bool)  # a text begins here
    edge[chunk.offsets] = True
    opens = word.copy()
    opens[1:] &= ~word[:-1] | edge[1:n]
    closes = word.copy()
    closes[:-1] &= ~word[1:] | edge[1:n]
    starts = np.flatnonzero(opens)
    return Words(starts, np.flatnonzero(closes) + 1, np.searchsorted(starts, chunk.offsets))


def word_hashes(chunk: Chunk, words: Words, lower: bool = False) -> np.ndarray:
    data = LOWER[chunk.data] if lower else chunk.data
    return spans_hash(data.astype(np.uint64) + np.uint64(1), words.starts, words.ends, BYTE_BASE)


def ngrams(
    hashes: np.ndarray, bounds: np.ndarray, n: int, among: np.ndarray | None = None
) -> tuple[np.ndarray, np.ndarray]:
    """First word and rolling hash of every window of ``n`` words inside one text
    (of those windows only that begin at a word of ``among``)."""
    if len(hashes) < n:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    last = np.repeat(bounds[1:], np.diff(bounds))  # per word, the end of its text
    begin = np.arange(len(hashes)) if among is None else among
    begin = begin[begin + n <= last[begin]]
    return begin, spans_hash(hashes | np.uint64(1), begin, begin + n, WORD_BASE)


def repeated(keys: np.ndarray) -> np.ndarray:
    """True where a key occurs more than once."""
    ordered = np.sort(keys)
    again = ordered[1:][ordered[1:] == ordered[:-1]]
    if len(again) == 0:
        return np.zeros(len(keys), dtype=bool)
    at = np.minimum(np.searchsorted(again, keys), len(again) - 1)
    return again[at] == keys


def per_text(weights: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Sum of word weights for each text."""
    sums = np.concatenate([[0], np.cumsum(weights, dtype=np.int64)])
    return sums[bounds[1:]] - sums[bounds[:-1]]
