"""Ids of texts by way of their distinct words, for tokenizers that never join across a single space.

A text is cut before every space that has no white space on either side and, for tokenizers that
match the pattern below, also where letters end before a sign and where a line begins with a letter:
words then occur without the signs around them, and fewer of them are distinct. Arrow finds the
distinct words of a slice of texts; only those not met lately are encoded, and the ids of the texts
are gathered from one flat array. Runs inside Spark tasks.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa

#: The pattern whose matches are known not to reach over such a cut. A fixed value, published with the vocabularies.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
# Bytes of a slice; words remembered from one slice to the next (some 250 bytes each), and the longest of them.
SLICE, KEPT, LONGEST = 8 << 20, 200_000, 64

# Second and third bytes of the characters that may be white space: U+0085, U+00A0, U+1680, U+2000 to U+206F, U+3000.
_LEAD = np.zeros(256, bool)
_LEAD[[0xE1, 0xE2, 0xE3]] = True
_NEXT = np.zeros(256, bool)
_NEXT[[0x9A, 0x80, 0x81]] = True
# ASCII letters and first bytes of U+00C0 to U+027F, which are letters but for U+00D7 and U+00F7; and
# the signs before which letters end. The signs of special tokens are not among them.
_LETTER = np.array([b < 128 and chr(b).isalpha() for b in range(256)])
_LATIN = np.zeros(256, bool)
_LATIN[0xC3:0xCA] = True
SIGNS = "\n!\"#$%&()*+,-./:;=?@"
_SIGN = np.zeros(256, bool)
_SIGN[list(SIGNS.encode())] = True


def _latin(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Whether letters of two bytes begin at these places."""
    first, second = data[np.maximum(at, 0)], data[np.minimum(at + 1, len(data) - 1)]
    return (at >= 0) & _LATIN[first] & (second >= 0x80) & (second < 0xC0) & ((first != 0xC3) | (second != 0x97) & (second != 0xB7))


def cuts(data: np.ndarray, offsets: np.ndarray, fine: bool = False) -> np.ndarray:
    """Where words begin, and the end of the data; every text begins a word. Leaves out doubtful places.

    `fine` adds the places that no match of the pattern reaches over: behind a letter and before a
    sign, and before the letter that begins a line, where the line before ends with a sign or letter.
    """
    n = len(data)
    at = np.flatnonzero(data == 32)
    at = at[(at > 0) & (at < n - 1)]
    before, behind = data[at - 1], data[at + 1]
    at = at[(before > 32) & (behind > 32) & (before != 0x7F) & (behind != 0x7F)]
    back = np.where(at > 1, data[at - 2], 0), np.where(at > 2, data[at - 3], 0)
    ahead = data[at + 1], np.where(at < n - 2, data[np.minimum(at + 2, n - 1)], 0)
    wide = (data[at - 1] > 127) & ((back[0] == 0xC2) | (_LEAD[back[1]] & _NEXT[back[0]]))
    wide |= (ahead[0] == 0xC2) | (_LEAD[ahead[0]] & _NEXT[ahead[1]])
    mark = np.zeros(n + 1, bool)
    mark[at[~wide]] = True
    if fine:
        at = np.flatnonzero(_SIGN[data[1:]]) + 1
        mark[at[_LETTER[data[at - 1]] | _latin(data, at - 2)]] = True
        at = np.flatnonzero(data[1:-1] == 10) + 1
        before = data[at - 1]
        starts = _LETTER[data[at + 1]] | _latin(data, at + 1)
        mark[at[starts & ((before > 32) & (before < 0x7F) | _latin(data, at - 2))] + 1] = True
    mark[offsets] = True
    return np.flatnonzero(mark)


def gather(flat: np.ndarray, counts: np.ndarray, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of runs that lie end to end, the wanted ones end to end, and the number of items up to each one's end."""
    held = pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(counts)).astype(np.int32)), pa.array(flat))
    found = held.take(pa.array(which))
    return found.flatten().to_numpy(), found.offsets.to_numpy().astype(np.int64)[1:]


class WordIds:
    """Ids of slices of texts. `encode` gives the ids of words, end to end, and how many each has.

    Where `split` is false every text is one word, for tokenizers that may join across spaces. `fine`
    is for those that match the pattern.
    """

    def __init__(self, encode: Callable[[list[str]], tuple[np.ndarray, np.ndarray]], split: bool = True, kept: int | None = None, fine: bool = False):
        self.encode, self.split, self.kept, self.fine = encode, split, kept or KEPT, fine
        self._forget()

    def _forget(self) -> None:
        self.known: dict[str, int] = {}
        self.flat, self.counts = np.zeros(0, np.uint32), np.zeros(0, np.int64)

    def of(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts end to end, and the number of ids up to each text's end."""
        n_texts = len(offsets) - 1
        if not len(data):
            return np.zeros(0, np.uint32), np.zeros(n_texts, np.int64)
        at = cuts(data, offsets, self.fine) if self.split else np.unique(offsets)
        buffers = [None, pa.py_buffer(at.astype(np.int32)), pa.py_buffer(np.ascontiguousarray(data))]
        words = pa.Array.from_buffers(pa.string(), len(at) - 1, buffers).dictionary_encode()
        distinct = words.dictionary.to_numpy(zero_copy_only=False).tolist()
        place = np.fromiter((self.known.get(w, -1) for w in distinct), np.int64, len(distinct))
        new = np.flatnonzero(place < 0)
        place[new] = len(self.counts) + np.arange(len(new))
        flat, counts = self.encode([distinct[k] for k in new])
        flat, counts = np.concatenate([self.flat, flat]), np.concatenate([self.counts, counts])
        starts = np.cumsum(counts) - counts
        ids, ends = gather(flat, counts, place[words.indices.to_numpy()])
        self._remember(distinct, place, new, flat, starts, counts)
        return ids, np.append(0, ends)[np.searchsorted(at, offsets[1:])]

    def _remember(self, words: list[str], place: np.ndarray, new: np.ndarray, flat: np.ndarray, starts: np.ndarray, counts: np.ndarray) -> None:
        """Keep short words; where there are too many, those of this slice alone."""
        if len(self.known) + len(new) > self.kept:
            self._forget()
            new = np.arange(len(words))
        fresh = [k for k in new.tolist()[: self.kept] if len(words[k]) <= LONGEST]
        own = place[fresh]
        many = counts[own]
        gathered = flat[np.arange(many.sum()) + np.repeat(starts[own] - (np.cumsum(many) - many), many)]
        first = len(self.counts)
        self.known.update(zip([words[k] for k in fresh], range(first, first + len(fresh))))
        self.flat, self.counts = np.concatenate([self.flat, gathered]), np.concatenate([self.counts, many])
