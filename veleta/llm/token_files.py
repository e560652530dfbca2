"""Token ids in Simple-8b files.

A file holds pages, one row each: whole documents in ascending order of their ids, the numbers of
their tokens, and the token ids packed into 64-bit words. The ids of a page are cut into blocks of
BLOCK, which are packed on their own; `block_ends` gives the words up to the end of each block, so
any block can be decoded alone and all of them at once.

A word has a selector in its top four bits and values of one width below, the first in the lowest
bits. Selector 1 stands for 120 zeros. Values of 2^60 or more are escaped: a word of selector 0
and then the value as it is, whose top bits cannot be those of selector 0. The last word of a block
may have room left, which counts as zeros and is cut off.
"""

from __future__ import annotations

import json
from functools import lru_cache
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from veleta.llm.tables import in_arrow, only
from veleta.llm.word_ids import SIGNS, SLICE, WordIds
from veleta.llm.words import slices
from veleta.session import stabilise

# Values in a word and bits of each, by selector from 2 on. Fixed values of the format.
COUNTS = [60, 30, 20, 15, 12, 10, 8, 7, 6, 5, 4, 3, 2, 1]
WIDTHS = [1, 2, 3, 4, 5, 6, 7, 8, 10, 12, 15, 20, 30, 60]
ZEROS = 120
BLOCK, PAGE = 1024, 1 << 18
# Words encoded as one text, and words that a task remembers.
TOGETHER, KEPT_WORDS = 8192, 700_000


def _bit_lengths(ids: np.ndarray) -> np.ndarray:
    high, low = np.frexp((ids >> np.uint64(32)).astype(np.float64))[1], np.frexp((ids & np.uint64(0xFFFFFFFF)).astype(np.float64))[1]
    return np.where(high > 0, high + 32, low).astype(np.uint8)


def pack(ids: np.ndarray, block: int = BLOCK) -> tuple[np.ndarray, np.ndarray]:
    """Words of the ids (unsigned, 64 bits at most), and the number of words up to each block's end."""
    n = len(ids)
    if not n:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    blocks = -(-n // block)
    values = np.zeros((blocks, block + ZEROS), np.uint64)
    padded = np.zeros(blocks * block, np.uint64)
    padded[:n] = ids
    values[:, :block] = padded.reshape(blocks, block)
    sizes = np.minimum(block, n - np.arange(blocks) * block)
    bits = np.zeros((blocks, block + ZEROS), np.uint8)
    bits[:, :block] = _bit_lengths(padded).reshape(blocks, block)
    # Greatest width of a run from each place on, for runs of a power of two; any other run is two of those.
    spans, size = {1: bits}, 1
    while size * 2 <= ZEROS:
        spans[size * 2] = np.maximum(spans[size][:, :-size], spans[size][:, size:])
        size *= 2
    choice = np.zeros((blocks, block), np.uint8)
    for count, selector in [*sorted(zip(COUNTS, range(2, 16))), (ZEROS, 1)]:
        size = 1 << (count.bit_length() - 1)
        widest = np.maximum(spans[size][:, :block], spans[size][:, count - size : count - size + block])
        choice[widest <= (WIDTHS[selector - 2] if selector > 1 else 0)] = selector
    steps = np.array([1, ZEROS, *COUNTS])[choice]
    # All blocks walk from word to word together.
    row, at, rows, places = np.arange(blocks), np.zeros(blocks, np.int64), [], []
    while len(row):
        rows.append(row)
        places.append(at)
        at = at + steps[row, at]
        more = at < sizes[row]
        row, at = row[more], at[more]
    row, at = np.concatenate(rows), np.concatenate(places)
    order = np.argsort(row * block + at, kind="stable")
    row, at = row[order], at[order]
    chosen = choice[row, at]
    long = 1 + (chosen == 0)
    ends = np.cumsum(long)
    words = np.zeros(ends[-1], np.uint64)
    place = ends - long
    words[place[chosen == 1]] = np.uint64(1 << 60)
    escaped = chosen == 0
    words[place[escaped] + 1] = values[row[escaped], at[escaped]]
    for selector, (count, width) in enumerate(zip(COUNTS, WIDTHS), 2):
        own = np.flatnonzero(chosen == selector)
        if len(own):
            slots = np.arange(count)
            parts = values[row[own][:, None], at[own][:, None] + slots] << (slots * width).astype(np.uint64)
            words[place[own]] = np.bitwise_or.reduce(parts, axis=1) | np.uint64(selector << 60)
    return words, ends[np.searchsorted(row, np.arange(blocks), "right") - 1]


def unpack(words: np.ndarray, block_ends: np.ndarray, n: int, block: int = BLOCK) -> np.ndarray:
    """The n ids of the words, all blocks at once."""
    out = np.zeros(n, np.uint64)
    if not n:
        return out
    selector = (words >> np.uint64(60)).astype(np.int64)
    head = np.ones(len(words), bool)
    head[1:] = selector[:-1] != 0  # behind a word of selector 0 stands a value as it is
    raw = np.flatnonzero(~head)
    counts = np.array([1, ZEROS, *COUNTS])[selector] * head
    number = np.searchsorted(block_ends, np.arange(len(words)), "right")
    before = np.cumsum(counts) - counts
    first = before[np.concatenate([[0], block_ends[:-1]])]
    start = before - first[number] + number * block
    end = np.minimum((number + 1) * block, n)
    out[start[raw - 1]] = words[raw]
    for s, (count, width) in enumerate(zip(COUNTS, WIDTHS), 2):
        own = np.flatnonzero(head & (selector == s))
        if len(own):
            slots = np.arange(count)
            to = start[own][:, None] + slots
            parts = (words[own][:, None] >> (slots * width).astype(np.uint64)) & np.uint64((1 << width) - 1)
            real = to < end[own][:, None]
            out[to[real]] = parts[real]
    return out


class FileEncoder:
    """Encoder of words by a tokenizer file; `specials` tells whether special tokens in a text count as such."""

    def __init__(self, data: bytes, specials: bool = True):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_buffer(data)
        self.tokenizer.encode_special_tokens = not specials
        file = json.loads(data)
        before = file.get("pre_tokenizer") or {}
        # Only this kind of file is known to cut texts before single spaces and to keep all bytes.
        plain = before.get("type") == "ByteLevel" and before.get("use_regex", True) and not before.get("add_prefix_space")
        added = [t["content"] for t in file.get("added_tokens", [])]
        self.splits = bool(plain) and not file.get("normalizer") and not any(c.isspace() for t in added for c in t)
        # The pattern of such a file is the published one.
        self.fine = self.splits and not any(c in SIGNS for t in added for c in t)
        if self.splits:
            entries = [self.tokenizer.id_to_token(k) or "" for k in range(self.tokenizer.get_vocab_size())]
            self.lengths = np.array([len(e) if e not in added else len(e.encode()) for e in entries], np.int64)

    def _each(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(e.ids, np.uint32) for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the words end to end, and how many each has.

        Words without white space at their ends are encoded as long texts, which the tokenizer cuts
        between them: before the space that a word begins with, or else at a line end put before it,
        whose id is dropped. The lengths of tokens tell which id belongs to which word.
        """
        counts, order, parts, rest = np.zeros(len(words), np.int64), [], [], []
        inner = []
        for k, w in enumerate(words):
            plain = self.splits and w and not w[-1].isspace() and (not w[0].isspace() or w[0] == " " and not w[1].isspace())
            (inner if plain else rest).append(k)
        for first in range(0, len(inner), TOGETHER):
            own = inner[first : first + TOGETHER]
            put = [words[k] if words[k][0] == " " else "\n" + words[k] for k in own]
            text = "".join(put)
            ids = self._each([text])[0]
            size = [len(w) for w in put] if text.isascii() else [len(w.encode()) for w in put]
            ends, want = np.cumsum(self.lengths[ids]), np.cumsum(size)
            at = np.searchsorted(ends, want)
            begin = np.append(0, at[:-1] + 1)
            ahead = np.array([w[0] == "\n" for w in put])
            if len(ends) and at[-1] == len(ends) - 1 and (ends[at] == want).all() and (self.lengths[ids[begin[ahead]]] == 1).all():
                counts[own] = at + 1 - begin - ahead
                order += own
                parts.append(np.delete(ids, begin[ahead]))
            else:
                rest += own
        single = self._each([words[k] for k in rest])
        counts[rest] = [len(p) for p in single]
        order += rest
        flat = np.concatenate([np.zeros(0, np.uint32), *parts, *single])
        # From the order of encoding to that of the words.
        starts = np.empty(len(words), np.int64)
        starts[order] = np.cumsum(counts[order]) - counts[order]
        ends = np.cumsum(counts)
        return flat[np.arange(len(flat)) + np.repeat(starts - (ends - counts), counts)], counts


@lru_cache(maxsize=1)
def _words(data: bytes) -> WordIds:
    encoder = FileEncoder(data)
    return WordIds(encoder.words, encoder.splits, KEPT_WORDS, encoder.fine)


PAGES = "part int, page int, start long, doc_ids array<long>, n_tokens array<long>, block_ends array<int>, words binary"


def _write(shared, end_id: int):
    def pages(batches):
        part, start, page = TaskContext.get().partitionId(), 0, 0
        ids, lengths, arrays, held = [], [], [], 0

        def flush():
            nonlocal start, page, ids, lengths, arrays, held
            words, ends = pack(np.concatenate(arrays).astype(np.uint64))
            out = pa.RecordBatch.from_arrays(
                [
                    pa.array([part], pa.int32()), pa.array([page], pa.int32()), pa.array([start], pa.int64()),
                    pa.array([ids], pa.list_(pa.int64())), pa.array([lengths], pa.list_(pa.int64())),
                    pa.array([ends.astype(np.int32)], pa.list_(pa.int32())), pa.array([words.astype("<u8").tobytes()], pa.binary()),
                ],
                names=["part", "page", "start", "doc_ids", "n_tokens", "block_ends", "words"],
            )
            start, page, ids, lengths, arrays, held = start + held, page + 1, [], [], [], 0
            return out

        end = np.array([end_id], np.uint32)
        for rows, data, offsets in slices(batches, at_most=SLICE):
            found, ends = _words(shared.value).of(data, offsets)
            for doc, low, high in zip(rows.column(0).to_pylist(), [0, *ends.tolist()], ends.tolist()):
                ids.append(doc)
                lengths.append(high - low + 1)
                arrays += [found[low:high], end]
                held += high - low + 1
                if held >= PAGE:
                    yield flush()
        if ids:
            yield flush()

    return pages


def write_tokens(docs: DataFrame, path: str, tokenizer: str, end_id: int, id_col: str = "doc_id", text_col: str = "text") -> None:
    """Write the ids of all texts, each with `end_id` behind, in ascending order of document ids.

    Texts are sorted by range over the cluster and encoded in the sorted tasks, each of which
    writes its pages. NULL ids come first, equal ids in order of a hash of their texts. NULL and
    empty texts have the end id alone; repeated rows are all written. Other columns are not read.
    An empty table gives files without pages. The tokenizer file is of a fixed size and is
    broadcast from the driver.
    """
    with open(tokenizer, "rb") as file:
        shared = docs.sparkSession.sparkContext.broadcast(file.read())
    ordered = only(docs, id_col, text_col).orderBy(F.col("doc_id").asc_nulls_first(), F.xxhash64("text"))
    in_arrow(ordered, _write(shared, end_id), PAGES).write.option("compression", "none").parquet(path)


def _read(digest: bool):
    def rows(batches):
        for batch in batches:
            for page in batch.to_pylist():
                lengths = np.array(page["n_tokens"], np.int64)
                ids = unpack(np.frombuffer(page["words"], "<u8"), np.array(page["block_ends"], np.int64), int(lengths.sum()))
                ends = np.cumsum(lengths)
                parts = np.split(ids, ends[:-1])
                what = (
                    pa.array([crc32(p.astype("<u4").tobytes()) for p in parts], pa.int64())
                    if digest
                    else pa.array([p.view(np.int64) for p in parts], pa.list_(pa.int64()))
                )
                n = len(lengths)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(n, page["part"], np.int32)), pa.array(page["doc_ids"], pa.int64()), pa.array(page["start"] + ends - lengths), pa.array(lengths), what],
                    names=["part", "doc_id", "place", "n_tokens", "ids_crc32" if digest else "ids"],
                )

    return rows


def _from_files(spark: SparkSession, path: str, digest: bool) -> DataFrame:
    pages = spark.read.schema(PAGES).parquet(path)
    kind = "ids_crc32 long" if digest else "ids array<long>"
    rows = in_arrow(pages, _read(digest), f"part int, doc_id long, place long, n_tokens long, {kind}")
    totals = pages.groupBy("part").agg(F.sum(F.aggregate("n_tokens", F.lit(0).cast("long"), lambda a, x: a + x)).alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    # One row per file.
    starts = stabilise(totals.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before")), "starts")
    joined = rows.join(F.broadcast(starts), "part")
    return joined.select("doc_id", (F.col("before") + F.col("place")).alias("start"), "n_tokens", kind.split()[0])


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start (ids of all documents before), n_tokens and ids, from the files."""
    return _from_files(spark, path, digest=False)


def read_digests(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start, n_tokens and ids_crc32 (of the ids as little-endian 32-bit integers), from the files."""
    return _from_files(spark, path, digest=True)
