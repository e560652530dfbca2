"""Daily series: preparation, windows and diagnostics (TSA1, TSA3-5, WIN1-2, WIN5-6, WIN8, FLT5, FN-SEQ, SET2).

Everything here works on the output of `prepare_series`: one row per key and calendar day.
That step aggregates with map-side combining, so a key that holds a third of all raw rows
leaves it with one row per day, some 3,700 rows for ten years. Windows over a whole key are
therefore small by the calendar, whatever the raw volume, and all of them share one shuffle.
"""

from __future__ import annotations

from math import comb

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _number(y: str) -> Column:
    """Double, with NaN taken for a missing value."""
    return F.nanvl(F.col(y).cast("double"), F.lit(None))


# Two-sided 95 % point of the normal distribution.
Z_95 = 1.959963984540054


def prepare_series(df: DataFrame, key: str, t: str, y: str, tiebreak: str | None = None) -> DataFrame:
    """One row per key and day: the first value of the day by `tiebreak` (TSA1).

    Without a tiebreak column the earliest `t` of the day wins, then the lowest value. A row
    without a key or without a readable day belongs to no series and is left out.
    """
    moment = F.col(t) if not isinstance(df.schema[t].dataType, T.StringType) else F.try_to_timestamp(F.col(t))
    first = F.col(tiebreak) if tiebreak else F.struct(moment, F.col(y).cast("double"))
    placed = df.where(F.col(key).isNotNull() & moment.isNotNull())
    return placed.groupBy(F.col(key).alias("key"), moment.cast("date").alias("t")).agg(
        F.min_by(_number(y), first).alias("y")
    )


def daily_mean_series(df: DataFrame, key: str, t: str, y: str) -> DataFrame:
    """One row per key and day: the mean of the day."""
    placed = df.where(F.col(key).isNotNull() & F.col(t).isNotNull())
    return placed.groupBy(F.col(key).alias("key"), F.col(t).cast("date").alias("t")).agg(F.avg(_number(y)).alias("y"))


def _require_daily(series: DataFrame) -> None:
    if not isinstance(series.schema["t"].dataType, T.DateType):
        raise TypeError("expected a daily series (key, t DATE, y); see prepare_series")


def _whole() -> Window:
    return Window.partitionBy("key")


def _ordered() -> Window:
    return Window.partitionBy("key").orderBy("t")


def _known(series: DataFrame) -> DataFrame:
    _require_daily(series)
    return series.where(F.col("y").isNotNull())


def with_positions(series: DataFrame) -> DataFrame:
    """Append `pos` (from 1) and `n`, the length of the series."""
    _require_daily(series)
    return series.withColumns(
        {"pos": F.row_number().over(_ordered()), "n": F.count("*").over(_whole())}
    )


def split_series(series: DataFrame, train_share: float = 0.8) -> DataFrame:
    """Mark the first int(share * N) days of each series as train (WIN2)."""
    at = with_positions(series)
    return at.withColumn("is_train", F.col("pos") <= F.floor(F.lit(train_share) * F.col("n")))


def trailing(series: DataFrame, days: int = 730, inclusive: bool = False) -> DataFrame:
    """Days after (last day - `days`); `inclusive` keeps that boundary day as well (FLT5)."""
    _require_daily(series)
    start = F.date_sub(F.max("t").over(_whole()), days)
    kept = series.withColumn("__start", start)
    test = F.col("t") >= F.col("__start") if inclusive else F.col("t") > F.col("__start")
    return kept.where(test).drop("__start")


def difference(series: DataFrame, d: int) -> DataFrame:
    """Append `dy`, the d-th difference, by its binomial expansion in one window (WIN6)."""
    _require_daily(series)
    terms = [F.lit(float((-1) ** k * comb(d, k))) * F.lag("y", k).over(_ordered()) for k in range(d + 1)]
    return series.withColumn("dy", sum(terms[1:], start=terms[0]))


def moving_average(series: DataFrame, period: int, out: str = "trend") -> DataFrame:
    """Append the centred mean over `period` days, NULL where the frame is cut off or lacks a value (WIN5).

    An even period gives half weight to both ends. The mean is a difference of running sums,
    so a row costs the same for 7 days and for 365.
    """
    _require_daily(series)
    half = period // 2
    w = _ordered()
    # Ordered windows come first: their sort serves the whole-series ones as well.
    centred = (
        series.withColumn("__i", F.row_number().over(w))
        .withColumn("__mean", F.avg("y").over(_whole()))
        .withColumn("__run", F.sum(F.coalesce(F.col("y") - F.col("__mean"), F.lit(0.0))).over(w.rowsBetween(Window.unboundedPreceding, 0)))
        .withColumn("__seen", F.count("y").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    )

    def upto(shift: int, of: str = "__run") -> Column:
        """Running sum `shift` days on; before the first day it is 0."""
        if shift >= 0:
            return F.lead(of, shift).over(w)
        return F.when(F.col("__i") + shift == 0, F.lit(0)).otherwise(F.lag(of, -shift).over(w))

    if period % 2:
        total = upto(half) - upto(-half - 1)
    else:
        total = (upto(half) + upto(half - 1) - upto(-half) - upto(-half - 1)) / 2
    full = upto(half, "__seen") - upto(-half - 1, "__seen") == 2 * half + 1
    mean = F.when(full, F.col("__mean") + total / period)
    return centred.withColumn(out, mean).drop("__mean", "__run", "__seen", "__i")


def _autocorrelations(series: DataFrame, lags: int) -> DataFrame:
    """One row per key: `n` and the array `r` of autocorrelations at lags 0 to `lags`.

    All lags are read in one window and summed in one aggregate; no row is multiplied.
    """
    lagged = _known(series).selectExpr(
        "key", "y", *[f"lag(y, {k}) OVER (PARTITION BY key ORDER BY t) AS l{k}" for k in range(1, lags + 1)]
    )
    centred = lagged.withColumn("m", F.avg("y").over(_whole()))
    products = ["sum((y - m) * (y - m))"] + [f"sum((y - m) * (l{k} - m))" for k in range(1, lags + 1)]
    sums = centred.groupBy("key").agg(F.count("*").alias("n"), F.expr(f"array({', '.join(products)})").alias("s"))
    return sums.select("key", "n", F.transform("s", lambda v: F.try_divide(v, F.col("s")[0])).alias("r"))


def acf(series: DataFrame, lags: int = 40) -> DataFrame:
    """Autocorrelation table (TSA3, WIN8): key, lag, acf, bound for every lag below the length.

    `bound` is the half-width of Bartlett's 95 % band around zero, as a correlogram draws it.
    """
    r = _autocorrelations(series, lags)
    # Variance at lag k: (1 + twice the squares at lags 1 to k-1) / n; none at lag 0.
    squares = "aggregate(slice(r, 2, greatest(lag - 1, 0)), 0D, (s, v) -> s + v * v)"
    bound = F.when(F.col("lag") == 0, F.lit(0.0)).otherwise(F.lit(Z_95) * F.expr(f"sqrt((1 + 2 * {squares}) / n)"))
    table = r.select("key", "n", "r", F.posexplode("r").alias("lag", "acf")).where("lag < n")
    return table.select("key", "lag", "acf", bound.alias("bound"))


def pacf(series: DataFrame, lags: int = 40) -> DataFrame:
    """Partial autocorrelations by the Durbin-Levinson recursion over the ACF array (TSA4).

    The autocovariances are divided by n, not n-k, at every lag. The recursion runs inside one
    row per series as an array fold.
    """
    r = _autocorrelations(series, lags).where("n > 1 AND r[0] IS NOT NULL")
    usable = r.withColumn("r", F.slice("r", F.lit(1), F.least(F.lit(lags + 1), F.col("n").cast("int"))))
    empty = F.array().cast("array<double>")
    start = F.struct(empty.alias("phi"), F.array(F.lit(1.0)).alias("out"))

    def dot(a: Column, b: Column) -> Column:
        return F.aggregate(F.zip_with(a, b, lambda x, z: x * z), F.lit(0.0), lambda s, v: s + v)

    def step(state: Column, k: Column) -> Column:
        phi = state["phi"]
        earlier = F.slice("r", F.lit(2), k - 1)
        top = F.element_at("r", k + 1) - dot(phi, F.reverse(earlier))
        alpha = F.try_divide(top, 1 - dot(phi, earlier))
        moved = F.zip_with(phi, F.reverse(phi), lambda a, b: a - alpha * b)
        return F.struct(
            F.concat(moved, F.array(alpha)).alias("phi"), F.concat(state["out"], F.array(alpha)).alias("out")
        )

    folded = F.aggregate(F.sequence(F.lit(1), F.size("r") - 1), start, step, lambda s: s["out"])
    return usable.select("key", F.posexplode(folded).alias("lag", "pacf"))


def decompose_additive(series: DataFrame, period: int = 365) -> DataFrame:
    """Trend, seasonal part and residual of y = trend + seasonal + residual (TSA5).

    The trend is the centred moving average. The seasonal part is the mean of y - trend at
    each phase (day position modulo period), shifted to mean zero over the phases. Series
    shorter than two periods are left out. Every window is keyed by the series, so phases
    need no join and no second shuffle.
    """
    w = _ordered()
    known = (
        _known(series)
        .withColumn("__phase", (F.row_number().over(w) - 1) % period)
        .withColumn("__n", F.count("*").over(_whole()))
        .where(F.col("__n") >= 2 * period)
    )
    phase = Window.partitionBy("key", "__phase")
    return (
        moving_average(known, period)
        .withColumns(
            {
                "__season": F.avg(F.col("y") - F.col("trend")).over(phase),
                "__size": F.count("*").over(phase),
            }
        )
        # Each phase counts once in the level, however many days fall on it.
        .withColumn("__level", F.sum(F.col("__season") / F.col("__size")).over(_whole()) / period)
        .withColumn("seasonal", F.col("__season") - F.col("__level"))
        .withColumn("resid", F.col("y") - F.col("trend") - F.col("seasonal"))
        .select("key", "t", "y", "trend", "seasonal", "resid")
    )


def future_dates(series: DataFrame, horizon: int = 365) -> DataFrame:
    """The `horizon` days after the last day of each series: key, step, t (FN-SEQ)."""
    _require_daily(series)
    last = series.groupBy("key").agg(F.max("t").alias("last"))
    days = F.sequence(F.date_add("last", 1), F.date_add("last", horizon))
    return last.select("key", F.posexplode(days).alias("i", "t")).select(
        "key", (F.col("i") + 1).alias("step"), "t"
    )


def history_plus_forecast(
    history: DataFrame, forecast: DataFrame, kinds: tuple[str, str] = ("history", "forecast")
) -> DataFrame:
    """Both as one labelled series (SET2); a column that one side lacks is NULL there."""
    return history.withColumn("kind", F.lit(kinds[0])).unionByName(
        forecast.withColumn("kind", F.lit(kinds[1])), allowMissingColumns=True
    )
