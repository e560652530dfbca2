"""Registered queries by name, and their reference SQL."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def registered(sql: str | None = None, text: Sequence[str] = ()):
    """Register a query under its function name, with its SQL when it has one.

    `text` names day columns that both sides give as text, since clients of the two engines
    hand dates over in different types.
    """

    def add(fn):
        @wraps(fn)
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return fn(spark, sf_dir).withColumns({c: F.col(c).cast("string") for c in text})

        if fn.__name__ in QUERIES:
            raise ValueError(f"{fn.__name__} is registered twice")
        QUERIES[fn.__name__] = run if text else fn
        if sql is not None:
            casts = ", ".join(f"CAST({c} AS VARCHAR) AS {c}" for c in text)
            ORACLES[fn.__name__] = f"SELECT * REPLACE ({casts}) FROM (\n{sql}\n) q" if text else sql
        return fn

    return add
