"""Reproducible shuffle into shards: a Feistel permutation over global row numbers.

Rows are numbered 0 to n-1 in order of their id. A Feistel network permutes a*b >= n numbers; a
number whose image is n or more is sent through again until it falls below n, which walks along
its cycle and so stays one to one. Shard and slot are the remainder and quotient of the image by
the number of shards, so shard sizes differ by one at most and any row's place can be computed
from its number alone.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from veleta.llm.tables import in_arrow
from veleta.llm.words import GOLDEN, mix
from veleta.session import stabilise

ROUNDS = 6


def _rounds(x: np.ndarray, a: int, b: int, seed: int) -> np.ndarray:
    """A Feistel network over 0 .. a*b-1 whose halves are numbers below a and below b."""
    left, right = x // np.uint64(b), x % np.uint64(b)
    sizes = [a, b]
    for k in range(ROUNDS):
        key = np.uint64((seed * 1_000_003 + k + 1) * int(GOLDEN) % 2**64)
        left, right = right, (left + mix(right + key) % np.uint64(sizes[0])) % np.uint64(sizes[0])
        sizes.reverse()
    return left * np.uint64(sizes[1]) + right


def permute(numbers: np.ndarray, n: int, seed: int = 0) -> np.ndarray:
    """Image of every number below n under the seeded permutation of 0 .. n-1."""
    a = max(1, math.isqrt(max(0, n - 1)) + 1)
    b = max(1, -(-n // a))
    out = _rounds(numbers.astype(np.uint64), a, b, seed)
    while (far := out >= np.uint64(n)).any():
        out[far] = _rounds(out[far], a, b, seed)
    return out.astype(np.int64)


def number_rows(df: DataFrame, order: list[Column], name: str = "number") -> tuple[DataFrame, int]:
    """Rows with their number from 0 on in the given order, and how many there are.

    Rows are sorted by range once and written with their place in their partition; the numbers
    before a partition come from a sum over partitions, one row each.
    """
    placed = stabilise(df.orderBy(*order).withColumn("_place", F.monotonically_increasing_id()), "ordered")
    part = F.shiftrightunsigned("_place", 33)
    counts = placed.groupBy(part.alias("_part")).agg(F.count("*").alias("_n"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = stabilise(counts.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"), "_n"), "starts")
    total = starts.agg(F.coalesce(F.sum("_n"), F.lit(0))).first()[0]
    # One row per partition of the sort.
    joined = placed.withColumn("_part", part).join(F.broadcast(starts.drop("_n")), "_part")
    number = F.col("_start") + F.col("_place").bitwiseAND(F.lit((1 << 33) - 1))
    return joined.withColumn(name, number).drop("_place", "_part", "_start"), total


def _placer(n: int, shards: int, seed: int):
    def rows(batches):
        for batch in batches:
            numbers = batch.column(batch.schema.get_field_index("number")).to_numpy()
            image = permute(numbers, n, seed)
            rest = [batch.column(i) for i in range(batch.num_columns) if batch.schema.field(i).name != "number"]
            names = [f for f in batch.schema.names if f != "number"]
            yield pa.RecordBatch.from_arrays(
                [*rest, pa.array((image % shards).astype(np.int32)), pa.array(image // shards)], names=[*names, "shard", "slot"]
            )

    return rows


def assign_shards(df: DataFrame, id_col: str = "doc_id", shards: int = 16, seed: int = 0) -> DataFrame:
    """The rows of `df` with their shard and their slot in it.

    Rows are numbered by id, NULL ids first, and by a hash of the whole row where ids repeat; rows
    equal in all columns are interchangeable. Which text a row has plays no part beyond that, and
    an empty table gives no rows. Columns called shard or slot are replaced. Only the columns
    given travel, so leave long texts out and join them on afterwards, or write them shard by shard.
    """
    kept = [c for c in df.columns if c.lower() not in ("shard", "slot")]
    row = F.struct(*[F.col(f"`{c}`") for c in kept])
    source = df.select(row.alias("row"), F.col(f"`{id_col}`").alias("id"), F.xxhash64(row).alias("tie"))
    numbered, n = number_rows(source, [F.col("id").asc_nulls_first(), F.col("tie")])
    numbered = numbered.select("row", "number")
    placed = in_arrow(numbered, _placer(n, shards, seed), f"row {numbered.schema['row'].dataType.simpleString()}, shard int, slot long")
    return placed.select("row.*", "shard", "slot")
