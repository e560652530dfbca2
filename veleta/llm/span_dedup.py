"""Substring dedup by sliding runs of consecutive sentences.

A run starts at a sentence and goes on until it has SENTENCES sentences and WORDS words, or it
ends at a sentence and goes back as far; in usual prose both rules give every run of SENTENCES
sentences, and among very short sentences they keep chance repeats such as "Yes. No." out. All
runs of all texts meet in one aggregate by hash. The first occurrence of a run is the one in the
least (doc_id, text hash, position); sentences that any other occurrence covers are removed.
"""

from __future__ import annotations

import re
from hashlib import blake2b

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from veleta.llm.tables import in_arrow
from veleta.session import stabilise

SENTENCES, WORDS = 2, 10
# A sentence ends after its closing mark and the white space behind it, or after line ends.
END = re.compile(r"[.!?]+[\"')\]]*\s+|\s*\n\s*")
NOT_WORD = re.compile(r"[^\x20\x09-\x0D]+")


def sentences(text: str) -> list[tuple[int, int]]:
    """Bounds of the sentences; each keeps the white space behind it, so together they are the text."""
    cuts = [m.end() for m in END.finditer(text)]
    if not cuts or cuts[-1] < len(text):
        cuts.append(len(text))
    return [(i, j) for i, j in zip([0, *cuts[:-1]], cuts) if i < j]


def runs(sizes: list[int], least: int, words: int) -> list[tuple[int, int]]:
    """First and last sentence of every run, for sentences of so many words each."""
    n, out = len(sizes), set()
    end = total = 0
    for start in range(n):  # forwards from every start
        while end < n and (end - start < least or total < words):
            total += sizes[end]
            end += 1
        if end - start < least or total < words:
            break
        out.add((start, end - 1))
        total -= sizes[start]
    start, total = n, 0
    for last in range(n - 1, -1, -1):  # backwards from every end
        while start > 0 and (last - start + 1 < least or total < words):
            start -= 1
            total += sizes[start]
        if last - start + 1 < least or total < words:
            break
        out.add((start, last))
        total -= sizes[last]
    return sorted(out)


def _spans(least: int, words: int):
    def rows(batches):
        for batch in batches:
            ids, keys = batch.column(0), batch.column(2)
            for first in range(0, len(batch), 128):
                at, starts, lasts, hashes = [], [], [], []
                for i, text in enumerate(batch.column(1).slice(first, 128).to_pylist(), first):
                    if not text:
                        continue
                    parts = [" ".join(text[a:b].split()) for a, b in sentences(text)]
                    for a, b in runs([p.count(" ") + 1 if p else 0 for p in parts], least, words):
                        at.append(i)
                        starts.append(a)
                        lasts.append(b)
                        hashes.append(blake2b(" ".join(parts[a : b + 1]).encode("utf-8", "surrogatepass"), digest_size=16).digest())
                if at:
                    both = [pa.array([int.from_bytes(h[k : k + 8], "little", signed=True) for h in hashes], pa.int64()) for k in (0, 8)]
                    take = pa.array(at, pa.int64())
                    yield pa.RecordBatch.from_arrays(
                        [ids.take(take), keys.take(take), pa.array(starts, pa.int32()), pa.array(lasts, pa.int32()), *both],
                        names=["doc_id", "doc_key", "start", "last", "h1", "h2"],
                    )

    return rows


def _without(batches):
    """Drop the sentences that the runs of each row cover."""
    for batch in batches:
        texts, covered, total = [], [], []
        for text, spans in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
            if not spans:
                texts.append(text)
                covered.append(0)
                total.append(len(sentences(text)) if text else 0)
                continue
            gone = set()
            for s in spans:
                gone.update(range(s["start"], s["last"] + 1))
            bounds = sentences(text)
            texts.append("".join(text[a:b] for k, (a, b) in enumerate(bounds) if k not in gone))
            covered.append(len(gone))
            total.append(len(bounds))
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(texts, pa.string()), pa.array(total, pa.int64()), pa.array(covered, pa.int64())],
            names=["row", "text", "n_sentences", "n_removed"],
        )


def spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: int = SENTENCES, words: int = WORDS) -> DataFrame:
    """Every run of every text: doc_id, doc_key (hash of the text), start, last, h1, h2."""
    own = docs.select(
        F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("text"),
    ).withColumn("doc_key", F.xxhash64("text"))
    return in_arrow(own, _spans(least, words), "doc_id long, doc_key long, start int, last int, h1 long, h2 long")


def repeated_spans(found: DataFrame) -> DataFrame:
    """The occurrences of repeated runs that are not the first: doc_id, doc_key, start, last."""
    # Ends of integers that a NULL id sorts before; one struct so that one minimum decides.
    place = F.struct(F.col("doc_id"), F.col("doc_key"), F.col("start"), F.col("last"))
    # Rows that repeat both id and text are one document, so the same place twice is no repeat.
    first = found.groupBy("h1", "h2").agg(F.min(place).alias("first"), F.max(place).alias("latest"))
    first = stabilise(first.filter(~F.col("first").eqNullSafe(F.col("latest"))).select("h1", "h2", "first"), "repeats")
    return found.join(first, ["h1", "h2"]).filter(~place.eqNullSafe(F.col("first"))).select("doc_id", "doc_key", "start", "last")


def dedup_spans(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    least: int = SENTENCES,
    words: int = WORDS,
    counts: tuple[str, str] = ("n_sentences", "n_removed"),
) -> DataFrame:
    """The rows of `docs` with repeated sentence runs taken out of the text, and two new columns.

    `counts` names them: the sentences before, and those taken out. Runs compare by their
    words, so white space does not tell them apart. A text that loses all its sentences becomes
    empty, a NULL text stays NULL, an empty one empty; texts of fewer than `least` sentences or
    `words` words have no runs. Ties between documents of one id go to the lesser text hash; rows
    that repeat id and text are one document and come out alike, so exact copies under other ids
    lose all their runs but rows repeated under one id lose none. NULL ids come first. All other columns stay;
    the two new ones replace columns of their names. An empty table gives no rows.
    """
    found = stabilise(spans(docs, id_col, text_col, least, words), "spans")
    gone = repeated_spans(found).groupBy("doc_id", "doc_key").agg(F.collect_set(F.struct("start", "last")).alias("spans"))
    gone = stabilise(gone, "removed")
    kept = [c for c in docs.columns if c.lower() not in {n.lower() for n in counts}]
    row = F.struct(*[F.col(f"`{c}`") for c in kept if c != text_col])
    left = docs.select(row.alias("row"), F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    left = left.withColumn("key", F.xxhash64("text"))
    joined = left.join(gone, left["id"].eqNullSafe(gone["doc_id"]) & (left["key"] == gone["doc_key"]), "left")
    joined = joined.select("row", "text", "spans")
    cut = in_arrow(joined, _without, f"row {row_type(joined)}, text string, n_sentences long, n_removed long")
    columns = [F.col("text").alias(c) if c == text_col else F.col(f"row.`{c}`") for c in kept]
    return cut.select(*columns, F.col("n_sentences").alias(counts[0]), F.col("n_removed").alias(counts[1]))


def row_type(df: DataFrame) -> str:
    return df.schema["row"].dataType.simpleString()
