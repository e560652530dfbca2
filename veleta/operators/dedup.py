"""Distinct rows and one row per key (DST*).

The per-key operators rank rows and keep rank 1. Spark plans that filter as a window group
limit on both sides of the shuffle, so each map task sends at most one row per key and a key
that holds a large share of the table costs no more than any other.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def distinct_rows(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Distinct over all of `cols` together, not one row per first column (DST1, DST4)."""
    return df.select(*cols).distinct()


def _rank_one(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("__rank", F.row_number().over(w)).where("__rank = 1").drop("__rank")


def latest_per_key(df: DataFrame, keys: Sequence[str], order: str, tiebreak: Sequence[str] = ()) -> DataFrame:
    """Whole row with the greatest `order` per key; NULL order loses to any value (DST2)."""
    ranks = [F.col(order).desc_nulls_last(), *[F.col(c).desc_nulls_last() for c in tiebreak]]
    return _rank_one(df, keys, ranks)


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Whole row that comes first in `order` per key (DST3)."""
    return _rank_one(df, keys, [F.col(c).asc_nulls_last() for c in order])
