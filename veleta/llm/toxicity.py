"""Toxicity by logistic regression, fitted with FTRL-proximal over hashed n-grams and skip-grams.

Features of a text are its distinct words, pairs of neighbours and pairs with one word between,
hashed to 2^BITS coordinates. Every coordinate has a learning rate of its own and an L1 threshold,
so most weights stay exactly zero and the rest fit into a small broadcast.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from veleta.llm.tables import in_arrow, only
from veleta.llm.words import WORDLIKE, chain, slices, word_hashes
from veleta.session import ship_package

BITS = 20
# Bound of the labelled rows that fit the model, all in one learner, and its passes over them.
MAX_FIT, EPOCHS = 16_000, 4
# L1 exceeds what a word of a few documents can gather, so that such words get no weight.
ALPHA, BETA, L1, L2 = 1.0, 1.0, 6.0, 0.1


def feature_ids(data: np.ndarray, offsets: np.ndarray, weights: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct coordinates of every text, ordered by text, with the number of the text.

    With weights, only the coordinates whose weight is not zero.
    """
    words, bounds = word_hashes(data, offsets, WORDLIKE, fold=True)
    text = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    ids, owners = [words], [text]
    for gap in (1, 2):
        if len(words) > gap:
            near = text[:-gap] == text[gap:]
            kind = np.full(int(near.sum()), gap, np.uint64)
            ids.append(chain([kind, words[:-gap][near], words[gap:][near]]))
            owners.append(text[:-gap][near])
    at, text = (np.concatenate(ids) >> np.uint64(64 - BITS)).astype(np.int64), np.concatenate(owners)
    if weights is not None:
        used = weights[at] != 0
        at, text = at[used], text[used]
    keys = np.unique((text << BITS) | at)
    return keys & ((1 << BITS) - 1), keys >> BITS


def ftrl(rows: list[tuple[np.ndarray, int]], epochs: int = EPOCHS) -> tuple[np.ndarray, np.ndarray]:
    """Run the rows through FTRL-proximal; gives the sums z and n of all coordinates, the bias last."""
    size = (1 << BITS) + 1
    z, n = np.zeros(size), np.zeros(size)
    for _ in range(epochs):
        for ids, label in rows:
            at = np.append(ids, size - 1)
            w = weights_of(z[at], n[at])
            p = 1 / (1 + np.exp(-np.clip(w.sum(), -35, 35)))
            g = p - label
            grown = n[at] + g * g
            z[at] += g - (np.sqrt(grown) - np.sqrt(n[at])) / ALPHA * w
            n[at] = grown
    return z, n


def weights_of(z: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Closed form of the proximal step: zero while |z| is at most L1."""
    return np.where(np.abs(z) <= L1, 0.0, -(z - np.sign(z) * L1) / ((BETA + np.sqrt(n)) / ALPHA + L2))


def _fit(rows: pd.DataFrame) -> pd.DataFrame:
    rows = rows.sort_values("place")
    examples = []
    batch = pa.RecordBatch.from_arrays([pa.array(rows["text"].fillna(""), pa.string())], names=["text"])
    done = 0
    labels = rows["label"].to_numpy()
    for part, data, offsets in slices(iter([batch])):
        ids, text = feature_ids(data, offsets)
        cuts = np.searchsorted(text, np.arange(len(part) + 1))
        examples += [(ids[a:b].astype(np.int32), labels[done + k]) for k, (a, b) in enumerate(zip(cuts[:-1], cuts[1:]))]
        done += len(part)
    z, n = ftrl(examples)
    w = weights_of(z, n)
    at = np.flatnonzero(w)
    return pd.DataFrame({"at": at, "w": w[at]})


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", max_fit: int = MAX_FIT) -> dict:
    """Weights by coordinate, from at most about `max_fit` labelled rows of all that `labels` has.

    Rows with a NULL id, or a label other than 0 or 1, do not take part. Which rows are taken
    depends on a hash of their id alone; they meet in one task, whose input `max_fit` bounds.
    Without rows the dictionary is empty and every score is one half.
    """
    ship_package(docs.sparkSession)
    own = labels.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{label_col}`").cast("int").alias("label"))
    own = own.filter(F.col("doc_id").isNotNull() & F.col("label").isin(0, 1)).groupBy("doc_id").agg(F.max("label").alias("label"))
    place = F.xxhash64("doc_id")
    known = own.count()
    if known > max_fit:
        share = int(2**63 * (2 * max_fit / known - 1)) if known < 2**40 else -(2**63)
        own = own.filter(place < F.lit(max(share, -(2**63) + 1)))
    rows = only(docs, id_col, text_col).join(own, "doc_id").select("text", "label", place.alias("place"), F.lit(1).alias("learner"))
    found = rows.groupBy("learner").applyInPandas(_fit, "at long, w double")
    # At most 2^BITS weights; only those that are not zero come back.
    return {r["at"]: r["w"] for r in found.filter("w <> 0").collect()}


def _scorer(ids: np.ndarray, values: np.ndarray):
    def rows(batches):
        weights = np.zeros((1 << BITS) + 1)
        weights[ids] = values
        for batch, data, offsets in slices(batches):
            at, text = feature_ids(data, offsets, weights)
            sums = np.bincount(text, weights[at], minlength=len(batch)) + weights[-1]
            scores = 1 / (1 + np.exp(-np.clip(sums, -35, 35)))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(scores, pa.float64())], names=["doc_id", "score"])

    return rows


def score(docs: DataFrame, weights: dict, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, score (0 to 1) and predicted (1 from one half on) of every row.

    NULL and empty texts have the score of the bias alone. Repeated rows and NULL ids are scored
    like others; other columns are not read. An empty table gives no rows.
    """
    ids = np.array(sorted(weights), np.int64)
    values = np.array([weights[i] for i in ids.tolist()], np.float64)
    out = in_arrow(only(docs, id_col, text_col), _scorer(ids, values), "doc_id long, score double")
    return out.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def held_out(doc_id) -> Column:
    """Whether a row's label is kept from fitting: crc32 of its id as text leaves 0 modulo 5."""
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string")), F.lit(5)) == 0, F.lit(False))
