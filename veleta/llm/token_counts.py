"""Token counts of a unigram vocabulary by a count-only Viterbi search.

An Aho-Corasick automaton over the pieces lists every piece that ends at each character of a word;
dynamic programming keeps, per character, the best score up to there and the number of pieces of
that best path, and no path itself. The rules are those of the tokenizers library's unigram
model: scores add up in double precision from the left, among equal scores the piece that starts
first wins, a character without a piece of its own costs ten below the least score, and such
characters count one token per UTF-8 byte where the vocabulary has byte pieces, else one per run.
Words begin at white space (U+0020), which belongs to the word behind it as U+2581; that mark in
a text counts as white space too, as in the library. A file of another kind of model lends its
pieces and scores: for a BPE file the counts are those of a unigram model with these pieces, not
those of the file's own merges.
"""

from __future__ import annotations

from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame

from veleta.llm.tables import in_arrow, only

MARK = "▁"
UNKNOWN_PENALTY = 10.0
KEPT_WORDS = 300_000


class Counter:
    """Counts words by pieces with scores."""

    def __init__(self, pieces: list[tuple[str, float]], byte_pieces: bool, unknown_piece: str = "<unk>"):
        import ahocorasick

        self.automaton = ahocorasick.Automaton()
        for piece, score in pieces:
            if piece:
                self.automaton.add_word(piece, (len(piece), score, piece == unknown_piece))
        self.automaton.make_automaton()
        self.unknown = min(score for _, score in pieces) - UNKNOWN_PENALTY
        self.byte_pieces = byte_pieces
        self.known: dict[str, tuple[int, float]] = {}

    def word(self, word: str) -> tuple[int, float]:
        """Tokens and score of the best path over a word that begins with the mark."""
        n = len(word)
        best, tokens = [None] * (n + 1), [0] * (n + 1)
        # Of a path that ends in unknown stretches: the tokens and the bytes of their run.
        runs: list[tuple[int, int] | None] = [None] * (n + 1)
        best[0] = 0.0
        ending: list[list[tuple[int, float, bool]]] = [[] for _ in range(n + 1)]
        for last, match in self.automaton.iter(word):
            ending[last + 1].append(match)
        for end in range(1, n + 1):
            found = sorted(ending[end], reverse=True)  # the longest starts first
            if not found or found[-1][0] > 1:
                found.append((1, self.unknown, True))
            top, chosen = None, None
            for match in found:
                candidate = match[1] + best[end - match[0]]
                if top is None or candidate > top:
                    top, chosen = candidate, match
            length, _, unknown = chosen
            start = end - length
            best[end], tokens[end] = top, tokens[start] + 1
            if unknown:
                size = len(word[start:end].encode("utf-8", "surrogatepass"))
                own, before = runs[start] or (0, 0)
                # A run is one unknown token, or its bytes; the piece for unknowns alone is itself.
                run = 1 if not self.byte_pieces or (not before and length > 1) else before + size
                runs[end] = run, before + size
                tokens[end] = tokens[start] - own + run
        return tokens[n], best[n]

    def text(self, text: str) -> tuple[int, float]:
        if not text:
            return 0, 0.0
        text = text.replace(MARK, " ")
        words = text.split(" ")
        if not words[0]:
            words = words[1:]
        known, total, score = self.known, 0, 0.0
        for w in words:
            found = known.get(w)
            if found is None:
                found = self.word(MARK + w)
                if len(known) >= KEPT_WORDS:
                    known.clear()
                if len(w) <= 64:
                    known[w] = found
            total += found[0]
            score += found[1]
        return total, score


def read_pieces(data: bytes) -> tuple[list[tuple[str, float]], bool]:
    """Pieces with their scores from a sentencepiece file, and whether it has all byte pieces."""
    from sentencepiece import SentencePieceProcessor

    model = SentencePieceProcessor(model_proto=data)
    size = model.get_piece_size()
    return [(model.id_to_piece(i), model.get_score(i)) for i in range(size)], sum(map(model.is_byte, range(size))) == 256


@lru_cache(maxsize=1)
def _counter(data: bytes) -> Counter:
    return Counter(*read_pieces(data))


def _count(shared):
    def rows(batches):
        counter = _counter(shared.value)
        for batch in batches:
            for first in range(0, len(batch), 512):
                part = batch.slice(first, 512)
                found = [counter.text(t or "") for t in part.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array([c for c, _ in found], pa.int64()), pa.array([s for _, s in found], pa.float64())],
                    names=["doc_id", "n_tokens", "score"],
                )

    return rows


def token_counts(docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_tokens and score of every row, by the pieces of the file `vocabulary`.

    NULL and empty texts have no tokens and a score of zero. Repeated rows and NULL ids are
    counted like others, texts of any length whole; other columns are not read. An empty table
    gives no rows. The file is of a fixed size and is broadcast from the driver.
    """
    with open(vocabulary, "rb") as file:
        shared = docs.sparkSession.sparkContext.broadcast(file.read())
    return in_arrow(only(docs, id_col, text_col), _count(shared), "doc_id long, n_tokens long, score double")
