"""Row filters and column shaping (PRJ*, FLT*)."""

from __future__ import annotations

import datetime as dt
import operator
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from veleta.functions.casts import parse_time
from veleta.functions.naming import clean_identifier

KINDS = {
    "number": T.NumericType,
    "datetime": (T.DateType, T.TimestampType, T.TimestampNTZType),
    "text": T.StringType,
    "boolean": T.BooleanType,
}


def keep_any_not_null(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Keep a row when at least one of `cols` is not NULL (FLT1).

    A plain disjunction reaches the parquet reader; `dropna` does not, and takes NaN for missing.
    """
    return df.where(reduce(operator.or_, (F.col(c).isNotNull() for c in cols)))


def drop_missing(df: DataFrame, col: str) -> DataFrame:
    return df.where(F.col(col).isNotNull())


def one_series(df: DataFrame, key: str, value: object) -> DataFrame:
    return df.where(F.col(key) == F.lit(value))


def derive(df: DataFrame, **columns: Column) -> DataFrame:
    """Append columns left to right; a later one may use an earlier one (PRJ3)."""
    for name, expression in columns.items():
        df = df.withColumn(name, expression)
    return df


def project_as(df: DataFrame, columns: Mapping[str, str]) -> DataFrame:
    """Ordered projection with rename: output name to input name (PRJ4)."""
    return df.select(*[F.col(source).alias(out) for out, source in columns.items()])


def in_local_day(
    df: DataFrame, ts: str, as_of: dt.datetime | None = None, offset_hours: int = 3
) -> DataFrame:
    """Rows dated on the day of `as_of` less the offset; `as_of` None means now (FLT2).

    Written as a half-open range on the bare column, not on formatted text, so the bounds
    fold to constants of its own type and prune row groups when `ts` is a stored time.
    """
    now = F.lit(as_of) if as_of is not None else F.current_timestamp()
    day = F.date_trunc("day", now - F.expr(f"INTERVAL {int(offset_hours)} HOURS"))
    kind = df.schema[ts].dataType
    return df.where(
        (F.col(ts) >= day.cast(kind)) & (F.col(ts) < (day + F.expr("INTERVAL 1 DAY")).cast(kind))
    )


def with_constants(df: DataFrame, **values: object) -> DataFrame:
    """The same literal on every row: keys, model labels, provenance (PRJ6)."""
    return df.withColumns({name: F.lit(v) for name, v in values.items()})


def sanitise_columns(df: DataFrame) -> DataFrame:
    """Column names reduced to letters, digits and _; two that meet are an error (PRJ7)."""
    names = [clean_identifier(c) for c in df.columns]
    seen: dict[str, str] = {}
    for old, new in zip(df.columns, names):
        if new.lower() in seen:
            raise ValueError(f"columns {seen[new.lower()]!r} and {old!r} both become {new!r}")
        seen[new.lower()] = old
    return df.toDF(*names)


def time_first(df: DataFrame, ts: str) -> DataFrame:
    """Move the time column to the front as a timestamp (PRJ8)."""
    rest = [F.col(f"`{c}`") for c in df.columns if c != ts]
    moment = parse_time(F.col(ts)) if isinstance(df.schema[ts].dataType, T.StringType) else F.to_timestamp(ts)
    return df.select(moment.alias(ts), *rest)


def drop_all_null(df: DataFrame) -> DataFrame:
    """Drop columns without a single value (PRJ9). One aggregate pass, one row to the driver."""
    seen = df.agg(*[F.count(F.col(f"`{c}`")).alias(c) for c in df.columns]).first()
    return df.select(*[F.col(f"`{c}`") for c in df.columns if seen[c] > 0])


def select_types(df: DataFrame, kinds: Sequence[str] = ("number", "datetime")) -> DataFrame:
    """Keep columns of the named kinds; plain text goes unless asked for (PRJ10)."""
    wanted = tuple(t for k in kinds for t in (KINDS[k] if isinstance(KINDS[k], tuple) else (KINDS[k],)))
    return df.select(*[F.col(f"`{f.name}`") for f in df.schema if isinstance(f.dataType, wanted)])


# Types tried for a text column, narrowest first.
_TEXT_TARGETS = ("bigint", "double", "timestamp", "boolean")
# A failed cast to these costs an exception per row, so only text of the right shape is tried.
_SHAPES = {
    "bigint": r"^\s*[+-]?\d+\s*$",
    "double": r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$",
    "boolean": r"(?i)^\s*(true|false|t|f|yes|no|y|n|1|0)\s*$",
}


# Zeros in front of a number, or at the end of several decimals; "1.0" is how a number is written.
_CODE = r"^\s*[+-]?(0\d|\d*\.\d+0\s*$)"


def _fits(c: Column, target: str) -> Column:
    """The value, where the cast is possible and the text is no code with zeros that it would lose."""
    value = c.try_cast(target)
    fits = c.rlike(_SHAPES[target]) if target in _SHAPES else None
    if target in ("bigint", "double"):
        fits &= ~c.rlike(_CODE)
    return value if fits is None else F.when(fits, value)


def tighten_types(df: DataFrame) -> DataFrame:
    """Cast each column to the narrowest type that loses no value (PRJ11).

    Text becomes bigint, double, timestamp or boolean when every value allows it, but codes with
    zeros that a number would lose, such as "007" and "1.10", stay text; doubles
    that are all whole become bigint. One aggregate pass decides for all columns.
    """
    tests: dict[str, Column] = {}
    for i, field in enumerate(df.schema):
        c = F.col(f"`{field.name}`")
        if isinstance(field.dataType, T.StringType):
            tests[f"n{i}"] = F.count(c)
            for target in _TEXT_TARGETS:
                tests[f"n{i}_{target}"] = F.count(_fits(c, target))
        elif isinstance(field.dataType, (T.DoubleType, T.FloatType)):
            tests[f"n{i}"] = F.count(c)
            tests[f"n{i}_bigint"] = F.count(F.when(c == c.try_cast("bigint").cast("double"), 1))
    if not tests:
        return df
    found = df.agg(*[e.alias(n) for n, e in tests.items()]).first()

    def target_of(i: int) -> str | None:
        total = found[f"n{i}"] if f"n{i}" in tests else 0
        fits = (t for t in _TEXT_TARGETS if total and f"n{i}_{t}" in tests and found[f"n{i}_{t}"] == total)
        return next(fits, None)

    out = []
    for i, field in enumerate(df.schema):
        c, target = F.col(f"`{field.name}`"), target_of(i)
        out.append(c.try_cast(target).alias(field.name) if target else c)
    return df.select(*out)
