"""Vectorised word and shingle hashes over Arrow batches; runs inside Spark tasks."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

# Fixed values of the hash functions.
GOLDEN = np.uint64(0x9E3779B97F4A7C15)
BASE = 0x100000001B3
SLICE_BYTES = 1 << 20

# Words of near-duplicate operators: everything but ASCII white space.
NOT_SPACE = np.ones(256, bool)
NOT_SPACE[[9, 10, 11, 12, 13, 32]] = False
# Words of classifiers: ASCII letters and digits, and all bytes of other characters.
WORDLIKE = np.array([b >= 128 or chr(b).isalnum() for b in range(256)])
LOWER = np.array([b + 32 if 65 <= b <= 90 else b for b in range(256)], np.uint8)


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser of splitmix64."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


BYTE_VALUES = mix(np.arange(1, 257, dtype=np.uint64) * GOLDEN)


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out)


class _Powers:
    """Powers of the base and of its inverse modulo 2^64, grown as longer slices come."""

    up = _powers(BASE, 1)
    down = _powers(pow(BASE, -1, 1 << 64), 1)

    @classmethod
    def upto(cls, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(cls.up) < n:
            cls.up, cls.down = _powers(BASE, n), _powers(pow(BASE, -1, 1 << 64), n)
        return cls.up[:n], cls.down[:n]


def slices(batches: Iterator[pa.RecordBatch], text: str = "text", at_most: int = SLICE_BYTES) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Cut batches so that the texts of a slice stay near `at_most` bytes; one text stays whole.

    Gives the slice, its text bytes and the offsets of its texts. NULL counts as empty.
    """
    for batch in batches:
        column = batch.column(batch.schema.get_field_index(text)).fill_null("")
        if pa.types.is_large_string(column.type):
            kind = np.int64
        else:
            kind = np.int32
        n = len(column)
        if not n:
            continue
        buffers = column.buffers()
        offsets = np.frombuffer(buffers[1], kind, n + 1 + column.offset)[column.offset :].astype(np.int64)
        data = np.frombuffer(buffers[2], np.uint8) if buffers[2] is not None else np.zeros(0, np.uint8)
        first = 0
        while first < n:
            last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + at_most, "right")) - 1)
            last = min(last, n)
            own = offsets[first : last + 1]
            yield batch.slice(first, last - first), data[own[0] : own[-1]], own - own[0]
            first = last


def word_hashes(data: np.ndarray, offsets: np.ndarray, inside: np.ndarray = NOT_SPACE, fold: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every word, and the offsets at which the words of each text start."""
    n = len(data)
    if not n:
        return np.zeros(0, np.uint64), np.zeros(len(offsets), np.int64)
    word = inside[data]
    head = np.ones(n, bool)
    head[1:] = ~word[:-1]
    tail = np.ones(n, bool)
    tail[:-1] = ~word[1:]
    edges = offsets[(offsets > 0) & (offsets < n)]
    head[edges] = True
    tail[edges - 1] = True
    starts, ends = np.flatnonzero(word & head), np.flatnonzero(word & tail) + 1
    up, down = _Powers.upto(n)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(BYTE_VALUES[LOWER[data] if fold else data] * up, out=sums[1:])
    hashes = mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64) * GOLDEN)
    return hashes, np.searchsorted(starts, offsets)


def chain(parts: list[np.ndarray]) -> np.ndarray:
    """Order-dependent hash of parallel columns of hashes."""
    out = np.zeros_like(parts[0])
    for p in parts:
        out = (out ^ p) * np.uint64(0x9FB21C651E98DF25)
        out ^= out >> np.uint64(32)
    return mix(out)


def shingle_hashes(words: np.ndarray, bounds: np.ndarray, size: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every run of `size` words; a shorter text is one shingle of all its words.

    Gives the hashes and the number of each hash's text.
    """
    counts = np.diff(bounds)
    many = np.maximum(counts - size + 1, np.minimum(counts, 1))
    text = np.repeat(np.arange(len(counts)), many)
    if not len(text):
        return np.zeros(0, np.uint64), text
    at = np.arange(len(text)) - np.repeat(np.cumsum(many) - many, many) + bounds[:-1][text]
    end = bounds[1:][text]
    last = len(words) - 1
    parts = [np.where(at + k < end, words[np.minimum(at + k, last)], np.uint64(0)) for k in range(size)]
    return chain(parts), text


def counted(hashes: np.ndarray, text: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct hashes of every text with how often they occur, ordered by text and hash."""
    if not len(hashes):
        return hashes, text, np.zeros(0, np.int64)
    order = np.lexsort((hashes, text))
    h, t = hashes[order], text[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (t[1:] != t[:-1])
    at = np.flatnonzero(new)
    return h[at], t[at], np.diff(np.append(at, len(h)))
