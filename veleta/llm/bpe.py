"""Byte-level BPE as a lazily determinised transducer, and streaming decoding.

Merging by rank has this property: a sequence of tokens is the encoding of its bytes exactly when
every two neighbours are the encoding of their own bytes. So the last token of a prefix's encoding
is the one token that ends there and forms such a pair with the last token of the prefix before
it. The transducer reads a byte at a time. Its state holds the longest suffix read that begins
some token, and for every shorter suffix that could still begin one, the tokens up to there since
the last point that all of them share. Tokens before that point are certain and are emitted: the
lookahead is bounded by the longest token. States and steps are made when first met, kept in a
table up to a bound and then made anew.

Usual matches are short and many, so they take their steps together, a byte of each at a time. The
state is held in its two parts then: the suffix, whose moves are kept in one table for all, and the
last tokens of the prefixes, which are written down for each match. Its ids are read off them from
its end.

The pattern cuts a text into matches that are encoded separately. Words between single spaces are
unions of whole matches, so their encodings are remembered as such.
"""

from __future__ import annotations

import base64
import codecs
import gc
from array import array
from collections.abc import Iterable, Iterator
from functools import lru_cache
from hashlib import sha256

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from veleta.llm.tables import in_arrow, only
from veleta.llm.word_ids import PATTERN, SLICE, WordIds, gather
from veleta.llm.words import GOLDEN, slices

# Entries kept of each table before it is emptied, which bounds a worker's tables to some 150 MB;
# results do not depend on it.
KEPT_STEPS, KEPT_MOVES, KEPT_PAIRS = 150_000, 60_000, 400_000
# The same for matches that go together: suffixes (1 KB each) and the bits of slots for pairs; bytes
# that go together and the longest match that does.
KEPT_SUFFIXES, PAIR_BITS, TOGETHER, LONGEST = 40_000, 20, 1 << 18, 256
# Ids decoded at a time.
AT_ONCE = 1 << 14


def read_ranks(data: bytes) -> dict[bytes, int]:
    """Ranks by token, from lines of a base64 token and its rank."""
    return {base64.b64decode(a): int(b) for a, b in map(bytes.split, data.splitlines()) if a}


def merge(ranks: dict[bytes, int], piece: bytes, parts_left: int = 1) -> list[bytes]:
    """Join the neighbours of least rank, leftmost first, until none can be joined or so few are left."""
    parts = [piece[i : i + 1] for i in range(len(piece))]
    while len(parts) > parts_left:
        best, at = min((ranks.get(a + b, 1 << 62), i) for i, (a, b) in enumerate(zip(parts, parts[1:])))
        if best == 1 << 62:
            break
        parts[at : at + 2] = [parts[at] + parts[at + 1]]
    return parts


class Transducer:
    """Encoder of single matches."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.tokens = {v: k for k, v in ranks.items()}
        self.heads = {t[:k] for t in ranks for k in range(len(t) + 1)}
        # Of a suffix and a byte: what does not depend on the tokens chosen so far.
        self.moves: dict[tuple[bytes, int], tuple] = {}
        self.pairs: dict[int, bool] = {}
        self.halves: dict[int, tuple[int, int]] = {}
        self._empty()
        self.size = max(self.tokens, default=0) + 1
        self.lengths = np.zeros(self.size, np.int64)
        self.lengths[list(self.tokens)] = [len(t) for t in self.tokens.values()]
        # Neighbours that are a token together, as one number each, and that token.
        joins = sorted(
            (ranks[t[:k]] * self.size + ranks[t[k:]], rank) for t, rank in ranks.items() for k in range(1, len(t)) if t[:k] in ranks and t[k:] in ranks
        )
        self.joins, self.joined = np.array([*joins, (1 << 62, 0)], np.int64).T.copy()
        self.inner = np.full((2, self.size), -1, np.int64)
        self.slots = np.full(1 << PAIR_BITS, -1, np.int64)
        self._forget()

    def _empty(self) -> None:
        # A state: the suffix read, the last certain token (-1: none), and for each live length of
        # a suffix, longest first, the tokens since the certain one.
        start = (b"", -1, ((),))
        self.states, self.numbers, self.steps = [start], {start: 0}, {}
        self.made = 0

    def _forget(self) -> None:
        # Suffixes by number, the move by a suffix and a byte (-1: not met), and of each move the next
        # suffix and where the tokens that can end there lie, longest first.
        self.suffixes, self.suffix_numbers, self.n_moves, self.n_ending = [b""], {b"": 0}, 0, 0
        self.table = np.full((1024, 256), -1, np.int32)
        self.next, self.first, self.past, self.ending = (np.zeros(4096, np.int64) for _ in range(4))

    def _halves(self, token: int) -> tuple[int, int]:
        """The two tokens that the last merge of a token joins; a single byte is its own half."""
        found = self.halves.get(token)
        if found is None:
            whole = self.tokens[token]
            if len(whole) == 1:
                found = token, token
            else:
                left, right = merge(self.ranks, whole, parts_left=2)
                found = self.ranks[left], self.ranks[right]
            self.halves[token] = found
        return found

    def _follows(self, left: int, right: int) -> bool:
        """Whether two tokens are the encoding of their bytes.

        Their merges are undone from the latest on. A merge across the border would have come
        first if its rank is below that of the merge just undone; on equal ranks the one further
        left wins.
        """
        if left < 0:
            return True
        key = left << 32 | right
        known = self.pairs.get(key)
        if known is not None:
            return known
        a, b, before = left, right, 1 << 62
        while True:
            joined = self.ranks.get(self.tokens[a] + self.tokens[b])
            if joined is not None and joined < before:
                known = False
                break
            a_half, b_half = self._halves(a)[1], self._halves(b)[0]
            if b_half == b and a_half == a:
                known = True
                break
            if a_half != a and (a > b or b_half == b):
                a, before = a_half, a
            else:
                b, before = b_half, b + 1
        if len(self.pairs) > KEPT_PAIRS:
            self.pairs.clear()
        self.pairs[key] = known
        return known

    def _tails(self, head: bytes) -> list[int]:
        return [k for k in range(len(head), -1, -1) if head[len(head) - k :] in self.heads]

    def _move(self, suffix: bytes, byte: int) -> tuple:
        """Next suffix, the tokens that can end here and the live paths they stand behind, and
        which of the old paths each new one is (-1: the path that ends here)."""
        found = self.moves.get((suffix, byte))
        if found is None:
            old = {k: i for i, k in enumerate(self._tails(suffix))}
            head, ending = self._ending(suffix, byte, old)
            found = head, ending, [old[k - 1] if k else -1 for k in self._tails(head)]
            if len(self.moves) > KEPT_MOVES:
                self.moves.clear()
            self.moves[(suffix, byte)] = found
        return found

    def _ending(self, suffix: bytes, byte: int, old: Iterable[int]) -> tuple[bytes, list[tuple[int, int]]]:
        """Next suffix, and the tokens that can end here with the number of the length before them."""
        read = suffix + bytes([byte])
        ending = [(self.ranks[read[len(suffix) - k :]], i) for i, k in enumerate(old) if read[len(suffix) - k :] in self.ranks]
        head = read
        while head not in self.heads:
            head = head[1:]
        return head, ending

    def _make(self, number: int, byte: int) -> tuple[int, tuple[int, ...]]:
        """The step from a state by a byte: the next state and the ids that became certain."""
        suffix, certain, live = self.states[number]
        head, ending, sources = self.moves.get((suffix, byte)) or self._move(suffix, byte)
        for token, i in ending:  # exactly one of them fits
            path = live[i]
            last = path[-1] if path else certain
            known = self.pairs.get(last << 32 | token)
            if known or (known is None and self._follows(last, token)):
                here = (*path, token)
                break
        else:
            raise ValueError("the ranks lack a single byte")
        new = [here if i < 0 else live[i] for i in sources]
        first, shared = new[0], 0
        if len(new) == 1:
            shared = len(first)
        elif first:
            shortest = min(map(len, new))
            while shared < shortest and all(p[shared] == first[shared] for p in new):
                shared += 1
        out = first[:shared]
        if shared:
            new = [p[shared:] for p in new]
        # The certain token tells nothing once every path has one of its own.
        state = (head, -1 if all(new) else out[-1] if out else certain, tuple(new))
        found = self.numbers.get(state)
        if found is None:
            found = self.numbers[state] = len(self.states)
            self.states.append(state)
        self.made += 1
        return found, out

    def _end(self, number: int) -> tuple[int, ...]:
        """Ids still held back when the match ends."""
        return self.states[number][2][-1]

    def stream(self, piece: bytes) -> tuple[int, ...]:
        """Ids of one match, emitted as they become certain; for matches of any length."""
        if self.made > KEPT_STEPS:
            self._empty()
        whole = self.ranks.get(piece)
        if whole is not None:
            return (whole,)
        out, state, steps = array("q"), 0, self.steps
        for byte in piece:
            key = state << 8 | byte
            step = steps.get(key)
            if step is None:
                step = steps[key] = self._make(state, byte)
            state, ids = step
            out.extend(ids)
        return (*out, *self._end(state))

    def _learn(self, key: int) -> None:
        """The move from a suffix by a byte."""
        number, byte = divmod(key, 256)
        suffix = self.suffixes[number]
        head, ending = self._ending(suffix, byte, self._tails(suffix))
        if bytes([byte]) not in self.ranks:
            raise ValueError("the ranks lack a single byte")
        found = self.suffix_numbers.get(head)
        if found is None:
            found = self.suffix_numbers[head] = len(self.suffixes)
            self.suffixes.append(head)
            if found == len(self.table):
                self.table = np.concatenate([self.table, np.full_like(self.table, -1)])
        if self.n_moves == len(self.next):
            self.next, self.first, self.past = (np.concatenate([a, a]) for a in (self.next, self.first, self.past))
        past = self.n_ending + len(ending)
        while past > len(self.ending):
            self.ending = np.concatenate([self.ending, self.ending])
        self.ending[self.n_ending : past] = [token for token, _ in ending]
        self.next[self.n_moves], self.first[self.n_moves], self.past[self.n_moves] = found, self.n_ending, past
        self.table[number, byte] = self.n_moves
        self.n_moves, self.n_ending = self.n_moves + 1, past

    def _taken(self, suffix: np.ndarray, byte: np.ndarray) -> np.ndarray:
        """The moves from suffixes by bytes."""
        moves = self.table[suffix, byte]
        missing = np.flatnonzero(moves < 0)
        if len(missing):
            for key in np.unique(suffix[missing] * 256 + byte[missing]).tolist():
                self._learn(key)
            moves[missing] = self.table[suffix[missing], byte[missing]]
        return moves

    def _inner(self, tokens: np.ndarray, side: int) -> np.ndarray:
        """The first (0) or second (1) halves of tokens."""
        found = self.inner[side, tokens]
        missing = np.flatnonzero(found < 0)
        if len(missing):
            for token in np.unique(tokens[missing]).tolist():
                self.inner[:, token] = self._halves(token)
            found[missing] = self.inner[side, tokens[missing]]
        return found

    def _undone(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """What `_follows` tells, of many pairs."""
        out, open_ = np.zeros(len(left), bool), np.arange(len(left))
        a, b, before = left, right, np.full(len(left), 1 << 62)
        while len(open_):
            key = a * self.size + b
            at = np.searchsorted(self.joins, key)
            fails = (self.joins[at] == key) & (self.joined[at] < before)
            a_half, b_half = self._inner(a, 1), self._inner(b, 0)
            out[open_] = ended = ~fails & (a_half == a) & (b_half == b)
            from_a = (a_half != a) & ((a > b) | (b_half == b))
            more = ~fails & ~ended
            before = np.where(from_a, a, b + 1)[more]
            a, b, open_ = np.where(from_a, a_half, a)[more], np.where(from_a, b, b_half)[more], open_[more]
        return out

    def _fit(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """What `_follows` tells, of many pairs; an answer is kept in the slot of its hash until another takes it."""
        key = left * self.size + right
        slot = (key.astype(np.uint64) * GOLDEN) >> np.uint64(64 - PAIR_BITS)
        held = self.slots[slot]
        out = (held & 1).astype(bool)
        missing = np.flatnonzero((held >> 1 != key) & (left >= 0))
        if len(missing):
            new, first = np.unique(key[missing], return_index=True)
            answers = self._undone(left[missing][first], right[missing][first])
            self.slots[slot[missing][first]] = new << 1 | answers
            out[missing] = answers[np.searchsorted(new, key[missing])]
        return out | (left < 0)

    def _together(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of matches end to end and how many each has; the longest match comes first."""
        n, lengths = len(pieces), np.array([len(p) for p in pieces])
        data = np.frombuffer(b"".join(pieces), np.uint8)
        starts = np.cumsum(lengths) - lengths
        # The last token of every prefix, from the empty one on.
        base, last = starts + np.arange(n), np.full(len(data) + n, -1, np.int64)
        suffix = np.zeros(n, np.int64)
        for place in range(lengths[0]):
            many = np.searchsorted(-lengths, -place)
            moves = self._taken(suffix[:many], data[starts[:many] + place])
            suffix[:many] = self.next[moves]
            at, past = self.first[moves], self.past[moves]
            token = self.ending[at]
            # Exactly one fits, so the last one left, a single byte, needs no look.
            open_ = np.flatnonzero(at + 1 < past)
            while len(open_):
                tried = token[open_]
                open_ = open_[~self._fit(last[base[open_] + place + 1 - self.lengths[tried]], tried)]
                at[open_] += 1
                token[open_] = self.ending[at[open_]]
                open_ = open_[at[open_] + 1 < past[open_]]
            last[base[:many] + place + 1] = token
        rounds, left, open_ = [], lengths.copy(), np.arange(n)
        while len(open_):
            token = last[base[open_] + left[open_]]
            rounds.append((open_, token))
            left[open_] -= self.lengths[token]
            open_ = open_[left[open_] > 0]
        counts = np.bincount(np.concatenate([rows for rows, _ in rounds]), minlength=n)
        ends, flat = np.cumsum(counts), np.zeros(counts.sum(), np.uint32)
        for k, (rows, token) in enumerate(rounds, 1):
            flat[ends[rows] - k] = token
        return flat, counts

    def encode(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of matches end to end, and how many each has; none is empty."""
        whole = np.fromiter((self.ranks.get(p, -1) for p in pieces), np.int64, len(pieces))
        order = [np.flatnonzero(whole >= 0)]
        parts, counts = [whole[order[0]].astype(np.uint32)], [np.ones(len(order[0]), np.int64)]
        lengths = np.fromiter(map(len, pieces), np.int64, len(pieces))
        for k in np.flatnonzero((whole < 0) & (lengths > LONGEST)).tolist():
            ids = np.array(self.stream(pieces[k]), np.uint32)
            order.append([k])
            parts.append(ids)
            counts.append([len(ids)])
        usual = np.flatnonzero((whole < 0) & (lengths <= LONGEST))
        usual = usual[np.argsort(-lengths[usual], kind="stable")]
        chunks = np.cumsum(lengths[usual]) // TOGETHER
        for own in np.split(usual, np.flatnonzero(np.diff(chunks)) + 1) if len(usual) else ():
            if len(self.suffixes) > KEPT_SUFFIXES:
                self._forget()
            ids, many = self._together([pieces[k] for k in own.tolist()])
            order.append(own)
            parts.append(ids)
            counts.append(many)
        # From the order of encoding to that of the matches.
        which = np.empty(len(pieces), np.int64)
        which[np.concatenate(order)] = np.arange(len(pieces))
        counts = np.concatenate(counts).astype(np.int64)
        ids, ends = gather(np.concatenate(parts), counts, which)
        return ids, np.diff(ends, prepend=0)


class Encoder:
    """Encoder of whole texts, many at a time; each match of the pattern is encoded on its own.

    The published pattern never matches across a single space, so words between such spaces are
    encoded once and remembered. With any other pattern a text is matched as a whole.
    """

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.transducer = Transducer(ranks)
        self.pattern = regex.compile(pattern)
        self.published = pattern == PATTERN
        self.words = WordIds(self._ids, split=self.published, fine=self.published)

    def _ids(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the words end to end, and how many each has."""
        plain = self.published
        matches = [(w,) if plain and (w.isalpha() or w[0] == " " and w[1:].isalpha()) else [m.group() for m in self.pattern.finditer(w)] for w in words]
        numbers: dict[str, int] = {}
        which = np.fromiter((numbers.setdefault(m, len(numbers)) for ms in matches for m in ms if m), np.int64)
        ids, counts = self.transducer.encode([m.encode("utf-8", "surrogatepass") for m in numbers])
        flat, ends = gather(ids, counts, which)
        upto = np.cumsum([sum(map(bool, ms)) for ms in matches], dtype=np.int64)
        return flat, np.diff(np.append(0, ends)[upto], prepend=0)

    def encode(self, texts: list[str]) -> list[list[int]]:
        column = pa.array(texts, pa.string())
        return [own for _, data, offsets in slices([pa.RecordBatch.from_arrays([column], names=["text"])], at_most=SLICE) for own in self.split(data, offsets)]

    def split(self, data: np.ndarray, offsets: np.ndarray) -> list[list[int]]:
        ids, ends = self.words.of(data, offsets)
        return [p.tolist() for p in np.split(ids, ends[:-1])]


class Utf8:
    """Incremental decoder of UTF-8: feed bytes, get text; a character cut between two calls waits for its rest."""

    def __init__(self, errors: str = "replace"):
        self.decoder = codecs.getincrementaldecoder("utf-8")(errors)

    def feed(self, data: bytes, final: bool = False) -> str:
        return self.decoder.decode(data, final)


class Decoder:
    """Streaming decoder: feed ids, get text."""

    def __init__(self, tokens: dict[int, bytes], errors: str = "replace"):
        self.tokens, self.utf8 = tokens, Utf8(errors)

    def feed(self, ids: Iterable[int], final: bool = False) -> str:
        return self.utf8.feed(b"".join(map(self.tokens.__getitem__, ids)), final)


def decode(tokens: dict[int, bytes], ids: list[int], at_once: int = AT_ONCE) -> Iterator[str]:
    """Text of the ids, piece by piece."""
    decoder = Decoder(tokens)
    for k in range(0, len(ids), at_once):
        yield decoder.feed(ids[k : k + at_once])
    yield decoder.feed((), final=True)


class Bytes:
    """Bytes of every id, end to end."""

    def __init__(self, tokens: dict[int, bytes]):
        size = max(tokens, default=0) + 1
        self.lengths = np.zeros(size, np.int64)
        self.lengths[list(tokens)] = [len(t) for t in tokens.values()]
        self.starts = np.cumsum(self.lengths) - self.lengths
        self.data = np.frombuffer(b"".join(tokens[k] for k in sorted(tokens)), np.uint8)

    def joined(self, ids: np.ndarray) -> bytes:
        room = self.lengths[ids]
        return self.data[np.arange(room.sum()) + np.repeat(self.starts[ids] - (np.cumsum(room) - room), room)].tobytes()


@lru_cache(maxsize=2)
def _loaded(data: bytes, pattern: str) -> tuple[Encoder, dict[int, bytes], Bytes]:
    ranks = read_ranks(data)
    tokens = {v: k for k, v in ranks.items()}
    loaded = Encoder(ranks, pattern), tokens, Bytes(tokens)
    gc.freeze()  # the vocabulary stays; scanning it again and again takes long
    return loaded


def _encoded(shared, pattern: str):
    def rows(batches):
        encoder = _loaded(shared.value, pattern)[0]
        for part, data, offsets in slices(batches, at_most=SLICE):
            ids, ends = encoder.words.of(data, offsets)
            lists = pa.ListArray.from_arrays(pa.array(np.append(0, ends).astype(np.int32)), pa.array(ids.astype(np.int32)))
            yield pa.RecordBatch.from_arrays([*part.columns, lists], names=["doc_id", "text", "ids"])

    return rows


def _round_trip(shared, pattern: str):
    def rows(batches):
        encoder, _, held = _loaded(shared.value, pattern)
        for part, data, offsets in slices(batches, at_most=SLICE):
            ids, ends = encoder.words.of(data, offsets)
            hashes, backs = [], []
            for own in np.split(ids, ends[:-1]):
                hashes.append(sha256(own.astype("<u4")).hexdigest())
                back, utf8 = sha256(), Utf8()
                for k in range(0, len(own), AT_ONCE):
                    back.update(utf8.feed(held.joined(own[k : k + AT_ONCE])).encode())
                back.update(utf8.feed(b"", final=True).encode())
                backs.append(back.hexdigest())
            yield pa.RecordBatch.from_arrays(
                [part.column(0), pa.array(np.diff(ends, prepend=0), pa.int64()), pa.array(hashes, pa.string()), pa.array(backs, pa.string())],
                names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    return rows


def _share(df: DataFrame, path: str):
    """Broadcast of the vocabulary file, which is of a fixed size and lies on the driver."""
    with open(path, "rb") as file:
        return df.sparkSession.sparkContext.broadcast(file.read())


def encode_documents(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, text and ids of every row by the rank file at `path` and the pattern of its matches.

    NULL and empty texts have no ids. Rows are encoded one by one, so repeated rows and NULL ids
    come out alike; other columns are not read. An empty table gives no rows.
    """
    return in_arrow(only(docs, id_col, text_col), _encoded(_share(docs, path), pattern), "doc_id long, text string, ids array<int>")


def _decoded(shared):
    def rows(batches):
        tokens = _loaded(shared.value, PATTERN)[1]
        for batch in batches:
            for first in range(0, len(batch), 256):
                part = batch.slice(first, 256)
                texts = ["".join(decode(tokens, ids or [])) for ids in part.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(texts, pa.string())], names=["doc_id", "text"])

    return rows


def decode_documents(ids: DataFrame, path: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """doc_id and text of every row of ids; NULL and empty lists give the empty text."""
    own = ids.selectExpr(f"`{id_col}` AS doc_id", f"CAST(`{ids_col}` AS array<int>) AS ids")
    return in_arrow(own, _decoded(_share(ids, path)), "doc_id long, text string")


def digests(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_tokens, ids_sha256 and decoded_sha256: encoding and decoding in one pass.

    NULL and empty texts have no ids and the digests of no bytes. Rows are encoded one by one, so
    repeated rows and NULL ids come out alike; other columns are not read. An empty table gives no
    rows.
    """
    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    return in_arrow(only(docs, id_col, text_col), _round_trip(_share(docs, path), pattern), schema)
