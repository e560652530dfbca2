"""Missing values: choose, fit and apply fills (MLA1-2, AGG13-14)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from veleta.operators.ordering import Chunk, forward_fill
from veleta.operators.profile import most_frequent, sample_skewness
from veleta.operators.quantiles import exact_medians


@dataclass(frozen=True)
class Imputer:
    """Fitted fills: one value per column, and the columns filled from the row before."""

    values: Mapping[str, object]
    strategy: Mapping[str, str] = field(default_factory=dict)
    forward: Sequence[str] = ()

    def as_rows(self, spark) -> DataFrame:
        rows = [(c, self.strategy.get(c), None if v is None else str(v)) for c, v in self.values.items()]
        return spark.createDataFrame(rows, "column string, strategy string, value string")


def choose_strategies(
    train: DataFrame,
    mean: Sequence[str] = (),
    median: Sequence[str] = (),
    mode: Sequence[str] = (),
    exclude: Sequence[str] = (),
    limit: float = 1.0,
) -> dict[str, str]:
    """Fill strategy per column: numbers with sample skewness up to `limit` take the mean, above
    it the median, other columns the most frequent value; dates are filled forward.

    Columns named by the caller keep the strategy they are named under. A number without a
    skewness (fewer than three values) takes the most frequent value.
    """
    return _choose(train, mean, median, mode, exclude, limit)[0]


def _choose(train, mean=(), median=(), mode=(), exclude=(), limit: float = 1.0) -> tuple[dict[str, str], dict[str, tuple]]:
    """Strategies, and mean and number of known values of every number, all from one aggregate."""
    named = {**dict.fromkeys(mode, "mode"), **dict.fromkeys(median, "median"), **dict.fromkeys(mean, "mean")}
    fields = [f for f in train.schema if f.name not in exclude]
    numeric = [f.name for f in fields if isinstance(f.dataType, T.NumericType)]
    found: dict[str, tuple] = {}
    if numeric:
        value = {c: F.nanvl(F.col(f"`{c}`").cast("double"), F.lit(None)) for c in numeric}
        aggregates = [F.struct(sample_skewness(v), F.avg(F.nanvl(F.col(f"`{c}`"), F.lit(None)) if _floating(train, c) else f"`{c}`"), F.count(v)).alias(c) for c, v in value.items()]
        found = {c: tuple(r) for c, r in train.agg(*aggregates).first().asDict().items()}
    out = {}
    for f in fields:
        skew = found[f.name][0] if f.name in found else None
        if f.name in named:
            out[f.name] = named[f.name]
        elif skew is not None:
            out[f.name] = "mean" if skew <= limit else "median"
        elif isinstance(f.dataType, (T.DateType, T.TimestampType, T.TimestampNTZType)):
            out[f.name] = "forward"
        else:
            out[f.name] = "mode"
    return out, {c: r[1:] for c, r in found.items()}


def _floating(df: DataFrame, c: str) -> bool:
    return isinstance(df.schema[c].dataType, (T.DoubleType, T.FloatType))


def nan_as_null(df: DataFrame) -> DataFrame:
    """NULL for NaN in every column of floating numbers."""
    floating = [f for f in df.schema if isinstance(f.dataType, (T.DoubleType, T.FloatType))]
    return df.withColumns({f.name: F.nanvl(F.col(f"`{f.name}`"), F.lit(None).cast(f.dataType)) for f in floating})


def fit_imputer(train: DataFrame, **overrides) -> Imputer:
    """Fit fills on the training rows only (MLA1). NaN is missing. Only the fill values reach the driver."""
    train = nan_as_null(train)
    strategy, measured = _choose(train, **overrides)
    by = {s: [c for c, v in strategy.items() if v == s] for s in ("mean", "median", "mode", "forward")}
    values: dict[str, object] = {c: measured[c][0] for c in by["mean"]}
    values |= exact_medians(train, by["median"], {c: measured[c][1] for c in by["median"]})
    # Dates keep a most frequent value too: a forward fill leaves leading gaps.
    counted = by["mode"] + by["forward"]
    if counted:
        values |= {r["column"]: r["value"] for r in most_frequent(train, counted).toLocalIterator()}
    return Imputer(values, strategy, tuple(by["forward"]))


def apply_imputer(
    df: DataFrame,
    imputer: Imputer,
    keys: Sequence[str] = (),
    order: Sequence[str] = (),
    chunk: Chunk = None,
) -> DataFrame:
    """Fill missing values (MLA2): dates forward in `order`, then every column its fitted value.

    A column filled by a mean or median becomes double, so that the fill is not cut to a whole
    number. Forward fills need an order; without one, dates take the most frequent value.
    """
    df = nan_as_null(df)
    forward = [c for c in imputer.forward if c in df.columns and c not in order]
    if forward and order:
        df = forward_fill(df, forward, keys, order, chunk)
    out = []
    for f in df.schema:
        c = F.col(f"`{f.name}`")
        value = imputer.values.get(f.name)
        if value is None:
            out.append(c)
        elif imputer.strategy.get(f.name) in ("mean", "median"):
            out.append(F.coalesce(c.cast("double"), F.lit(float(value))).alias(f.name))
        else:
            out.append(F.coalesce(c, F.lit(value).cast(f.dataType)).alias(f.name))
    return df.select(*out)
