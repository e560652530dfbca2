"""Data profiles (AGG4-8, AGG13, AGG14, AGG16)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from veleta.operators.joins import null_safe_join


def row_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count("*").alias("n_rows"))


def group_counts(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows per group, most frequent first (AGG5, SRT2)."""
    return df.groupBy(*keys).agg(F.count("*").alias("count")).orderBy(F.desc("count"), *keys)


def null_counts(df: DataFrame) -> DataFrame:
    """One row with the number of NULLs of every column (AGG6)."""
    return df.agg(*[F.count_if(F.col(f"`{c}`").isNull()).alias(c) for c in df.columns])


def describe(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Count, mean, sample deviation, least and greatest value, one row per column (AGG7)."""

    def stats(c: str) -> Column:
        v = F.col(f"`{c}`").cast("double")
        return F.struct(
            F.lit(c).alias("column"),
            F.count(v).alias("count"),
            F.avg(v).alias("mean"),
            F.stddev_samp(v).alias("stddev"),
            F.min(v).alias("min"),
            F.max(v).alias("max"),
        )

    return df.agg(F.array(*[stats(c) for c in cols]).alias("s")).select(F.inline("s"))


def series_extent(df: DataFrame, keys: Sequence[str], ts: str, value: str) -> DataFrame:
    """First and last time, rows and missing values of each series (AGG8)."""
    return df.groupBy(*keys).agg(
        F.min(ts).alias("first_time"),
        F.max(ts).alias("last_time"),
        F.count("*").alias("n_rows"),
        F.count_if(F.col(value).isNull()).alias("n_missing"),
    )


def sample_skewness(value: Column) -> Column:
    """Bias-corrected skewness aggregate, NULL below three values (AGG13).

    Spark's own skewness is the population form g1; the sample form is g1*sqrt(n(n-1))/(n-2).
    A constant column has skewness 0. NaN counts as missing.
    """
    value = F.nanvl(value, F.lit(None).cast("double"))
    n = F.count(value).cast("double")
    corrected = F.skewness(value) * F.sqrt(n * (n - 1)) / F.when(n > 2, n - 2)
    return F.when(F.min(value) == F.max(value), F.when(n > 2, F.lit(0.0))).otherwise(corrected)


def skew_corrected(df: DataFrame, cols: Sequence[str], keys: Sequence[str] = ()) -> DataFrame:
    """Bias-corrected skewness of each column, per group when `keys` is given."""
    out = [sample_skewness(F.col(f"`{c}`").cast("double")).alias(c) for c in cols]
    return df.groupBy(*keys).agg(*out) if keys else df.agg(*out)


def most_frequent(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Most frequent value of each column as text, lowest value on a tie (AGG14).

    All columns are counted in one pass, with map-side combining before anything is compared, so
    no task holds a column. A value is carried in a struct with a field for each column, so ties
    compare in the column's own order.
    """
    if not cols:
        return df.sparkSession.createDataFrame([], "column string, value string")
    empty = [F.lit(None).cast(df.schema[c].dataType) for c in cols]
    rows = [
        F.when(
            F.col(f"`{c}`").isNotNull(),
            F.struct(F.lit(i).alias("at"), *[(F.col(f"`{c}`") if i == k else empty[k]).alias(f"v{k}") for k in range(len(cols))]),
        )
        for i, c in enumerate(cols)
    ]
    names = ["at", *[f"v{k}" for k in range(len(cols))]]
    counts = df.select(F.inline(F.array_compact(F.array(*rows)))).groupBy(*names).agg(F.count("*").alias("__n"))
    values = F.struct(*names[1:])
    # Greatest count first; among equals the value that sorts lowest. Every column keeps its row.
    lowest = counts.groupBy("at", "__n").agg(F.min(values).alias("v"))
    top = lowest.groupBy("at").agg(F.max_by("v", "__n").alias("v"))
    text = F.coalesce(*[F.when(F.col("at") == i, F.col(f"v.v{i}").cast("string")) for i in range(len(cols))])
    known = top.select(F.col("at"), text.alias("value"))
    listed = df.sparkSession.createDataFrame(list(enumerate(cols)), "at int, column string")
    return listed.join(known, "at", "left").select("column", "value")


def histogram(df: DataFrame, value: str, bins: int = 30, keys: Sequence[str] = ()) -> DataFrame:
    """Equal-width bins over the value range, empty bins included (AGG16).

    Bins are closed on the left, the last one on both sides. A constant column gets a range
    of one half to either side. NULL and NaN are in no bin.
    """
    keys = list(keys)
    v = F.col(value)
    if isinstance(df.schema[value].dataType, (T.DoubleType, T.FloatType)):
        v = F.nanvl(v, F.lit(None).cast("double"))
    shown = df.where(v.isNotNull())
    raw = shown.groupBy(*keys).agg(F.min(v).alias("lo"), F.max(v).alias("hi"))
    flat = F.col("lo") == F.col("hi")
    extent = raw.select(
        *keys,
        F.when(flat, F.col("lo") - 0.5).otherwise(F.col("lo")).alias("__lo"),
        F.when(flat, F.col("hi") + 0.5).otherwise(F.col("hi")).alias("__hi"),
    )
    width = (F.col("__hi") - F.col("__lo")) / F.lit(float(bins))
    if keys:
        # Equal values meet before the range of their key reaches them.
        values = shown.groupBy(*keys, v.alias("__v")).agg(F.count("*").alias("__n"))
        placed = null_safe_join(values, extent, keys)
        lo, step = F.col("__lo"), width
    else:
        placed = shown.select(v.alias("__v"), F.lit(1).alias("__n"))
        lo = extent.select("__lo").scalar()
        step = extent.select(width).scalar()
    at = F.least(F.floor((F.col("__v") - lo) / step), F.lit(bins - 1)).cast("int").alias("bin")
    counted = placed.groupBy(*keys, at).agg(F.sum("__n").alias("n"))
    all_bins = F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin")
    frame = extent.select(*keys, "__lo", width.alias("__w"), all_bins)
    return null_safe_join(frame, counted, [*keys, "bin"], "left").select(
        *keys,
        "bin",
        (F.col("__lo") + F.col("__w") * F.col("bin")).alias("left_edge"),
        (F.col("__lo") + F.col("__w") * (F.col("bin") + 1)).alias("right_edge"),
        F.coalesce("n", F.lit(0)).cast("bigint").alias("n"),
    )
