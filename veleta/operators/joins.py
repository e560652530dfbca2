"""Joins in which NULL equals NULL, so that rows with missing keys are kept."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def null_safe_join(left: DataFrame, right: DataFrame, cols: Sequence[str], how: str = "inner") -> DataFrame:
    """Join on equal `cols`, taking NULL as a value; the columns are kept once, from the left."""
    renamed = right.withColumnsRenamed({c: f"__right_{c}" for c in cols})
    match = F.lit(True)
    for c in cols:
        match = match & left[c].eqNullSafe(renamed[f"__right_{c}"])
    return left.join(renamed, match, how).drop(*[f"__right_{c}" for c in cols])


def _stand_in(kind: T.DataType) -> Column | None:
    """Some value of the type, to stand for NULL next to a flag."""
    if isinstance(kind, T.NumericType):
        return F.lit(0).cast(kind)
    if isinstance(kind, T.StringType):
        return F.lit("")
    if isinstance(kind, T.BooleanType):
        return F.lit(False)
    if isinstance(kind, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        return F.lit(dt.date(1970, 1, 1)).cast(kind)
    return None


def tag_nulls(df: DataFrame, cols: Sequence[str], prefix: str) -> tuple[DataFrame, list[list[str]]]:
    """Append for each column a value that is never NULL and a flag that says if it was.

    Returns the frame and one [value, flag] pair of names per column. A plain equality join and
    a window on these pairs hash rows alike, so one shuffle serves both, which a null-safe join
    condition on the bare columns does not allow.
    """
    added, pairs = {}, []
    for i, c in enumerate(cols):
        stand_in = _stand_in(df.schema[c].dataType)
        value, flag = f"{prefix}v{i}", f"{prefix}n{i}"
        added[value] = F.struct(F.col(c)) if stand_in is None else F.coalesce(F.col(c), stand_in)
        added[flag] = F.col(c).isNull()
        pairs.append([value, flag])
    return df.withColumns(added), pairs
