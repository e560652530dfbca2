"""Forecasting jobs over all series at once (TSA6-8, TSA11-13, JON4).

Input is a daily series (key, t, y) as `prepare_series` makes it. ARIMA orders are fitted by the
two regressions of Hannan and Rissanen: a long autoregression gives the errors of a series, then
its values are regressed on their own lags and on lags of those errors. Lags are windows over a
series, whose length is bounded by the calendar; both regressions are sums of products
(`moments`), from which all orders of one degree of differencing follow at once. Forecasts are a
fold over the days ahead. Nothing is collected to the driver.
"""

from __future__ import annotations

import math
from collections.abc import Iterable

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from veleta.operators.metrics import best_candidate
from veleta.operators.moments import per_group, product_sums, regress
from veleta.operators.series import _known, difference, future_dates, with_positions
from veleta.session import stabilise

# Lags of the autoregression that gives the errors.
LONG = 12


def parameter_grid(p: Iterable[int] = range(4), d: Iterable[int] = range(3), q: Iterable[int] = range(4)):
    """Orders in search sequence; the position breaks ties."""
    q, d = list(q), list(d)
    return [(a, b, c) for a in p for b in d for c in q]


def _key_type(series: DataFrame) -> str:
    return series.schema["key"].dataType.simpleString()


def _lags(column: str, n: int) -> list[Column]:
    w = Window.partitionBy("key").orderBy("t")
    return [F.coalesce(F.lag(column, k).over(w), F.lit(0.0)) for k in range(1, n + 1)]


def _errors(moved: DataFrame, d: int) -> DataFrame:
    """Append `e`, the errors of the long autoregression; 0 where a day has too few before it."""
    lagged = stabilise(moved.withColumn("__lags", F.array(*_lags("w", LONG))), "lagged")
    ready = lagged.where(F.col("pos") > d + LONG)
    constant = F.lit(1.0 if d == 0 else 0.0)
    sums = product_sums(ready.select("key", F.concat(F.array("w", constant), "__lags").alias("x")), ["key"])
    columns = list(range(1 if d == 0 else 2, 2 + LONG))

    def fitted(group, products):
        fit = regress(products, 0, columns)
        if fit is None:
            return []
        return [(group["key"], [0.0] * (2 + LONG - 1 - len(fit[0])) + [float(b) for b in fit[0]])]

    betas = per_group(sums, f"key {_key_type(moved)}, beta array<double>", fitted)
    inputs = F.concat(F.array(constant), "__lags")
    dot = F.aggregate(F.zip_with(inputs, "beta", lambda x, b: x * b), F.lit(0.0), lambda s, v: s + v)
    error = F.when(F.col("pos") > d + LONG, F.col("w") - dot)
    return lagged.join(betas, "key", "left").withColumn("e", F.coalesce(error, F.lit(0.0))).drop("__lags", "beta")


def _vectors(series: DataFrame, d: int, p: int, q: int) -> DataFrame:
    """key, pos, t, y, w (the d-th difference) and x = (w, 1, p lags of w, q lags of errors)."""
    moved = difference(series, d).where(F.col("pos") > d).withColumnRenamed("dy", "w")
    if q:
        moved = _errors(moved, d)
    x = F.array("w", F.lit(1.0), *_lags("w", p), *(_lags("e", q) if q else []))
    return moved.withColumn("x", x).select("key", "pos", "t", "y", "w", "x")


def _first_day(p, d, q):
    """Days that a fit takes as given."""
    return (LONG + max(p, q) if q else p) + d


def _stable(coefficients: np.ndarray) -> bool:
    """Whether 1 - c1 z - c2 z^2 ... has all roots outside the unit circle."""
    if not len(coefficients):
        return True
    roots = np.roots(np.r_[-coefficients[::-1], 1.0])
    return bool(np.all(np.abs(roots) > 1.0))


def _fit(products: np.ndarray, order: tuple[int, int, int], p_max: int):
    """Coefficients (constant first where there is one), standard errors, error variance and days; None without a fit."""
    p, d, q = order
    on = ([1] if d == 0 else []) + list(range(2, 2 + p)) + list(range(2 + p_max, 2 + p_max + q))
    n = products[1, 1]
    if n <= len(on) + 2:
        return None
    found = regress(products, 0, on)
    if found is None:
        return None
    beta, inverse, left = found
    ar, ma = beta[len(on) - p - q : len(on) - q], beta[len(on) - q :]
    if q and not (_stable(ar) and _stable(-ma)):
        return None
    sigma2 = left / n
    return beta, np.sqrt(np.clip(inverse * sigma2, 0, None)), sigma2, int(n)


def arima_search(train: DataFrame, orders: list[tuple[int, int, int]] | None = None) -> DataFrame:
    """AIC and BIC of every order for every series (TSA6, JON4); failed fits have NULL.

    All orders are fitted on the same days, which keeps their criteria comparable: one pass for
    each degree of differencing gives all of its orders. An order with moving averages whose
    estimates are not stationary and invertible counts as failed.
    """
    orders = orders or parameter_grid()
    p_max, q_max = max(o[0] for o in orders), max(o[2] for o in orders)
    given = _first_day(p_max, max(o[1] for o in orders), q_max)
    known = stabilise(with_positions(_known(train).select("key", "t", "y")), "series")
    sums = None
    for d in sorted({o[1] for o in orders}):
        vectors = _vectors(known, d, p_max, q_max).where(F.col("pos") > given)
        own = product_sums(vectors.withColumn("d", F.lit(d)), ["key", "d"])
        sums = own if sums is None else sums.unionByName(own)

    def rated(group, products):
        out = []
        for at, order in enumerate(orders):
            if order[1] != group["d"]:
                continue
            fit = _fit(products, order, p_max)
            if fit is None:
                out.append((group["key"], *order, at, None, None, None))
                continue
            beta, _, sigma2, n = fit
            deviance, k = n * (math.log(2 * math.pi * sigma2) + 1), len(beta) + 1
            out.append((group["key"], *order, at, deviance + 2 * k, deviance + math.log(n) * k, n))
        return out

    schema = f"key {_key_type(train)}, p int, d int, q int, grid_pos int, aic double, bic double, nobs bigint"
    fitted = per_group(sums, schema, rated)
    # A series too short for any row of a degree has failed with all of its orders.
    grid = F.array(*[F.struct(*[F.lit(v).alias(n) for v, n in zip((*o, k), ("p", "d", "q", "grid_pos"))]) for k, o in enumerate(orders)])
    every = known.select("key").distinct().select("key", F.inline(grid))
    return every.join(fitted.select("key", "grid_pos", "aic", "bic", "nobs"), ["key", "grid_pos"], "left").select(
        "key", "p", "d", "q", "grid_pos", "aic", "bic", "nobs"
    )


def best_order(candidates: DataFrame) -> DataFrame:
    """Order with the least AIC per series (AGG17)."""
    return best_candidate(candidates, ["key"], ["p", "d", "q"])


def _fits(series: DataFrame, orders: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Fit of every series with its own order, and its vectors.

    Fits have key, p, d, q, beta, std_err, sigma2; vectors are those of the series' own degree.
    """
    known = stabilise(with_positions(_known(series).select("key", "t", "y")), "series")
    wanted = stabilise(orders.select("key", *[F.col(c).cast("int") for c in "pdq"]), "orders")
    shapes = wanted.groupBy("d").agg(F.max("p").alias("p"), F.max("q").alias("q")).orderBy("d").collect()  # a row for each degree
    p_max, q_max = max((r["p"] for r in shapes), default=0), max((r["q"] for r in shapes), default=0)
    vectors = None
    for r in shapes:
        own = known.join(wanted.where(F.col("d") == r["d"]), "key")
        moved = _vectors(own.select("key", "t", "y", "pos"), r["d"], p_max, q_max)
        moved = moved.join(wanted, "key")
        vectors = moved if vectors is None else vectors.unionByName(moved)
    vectors = stabilise(vectors, "vectors")
    start = F.when(F.col("q") > 0, LONG + F.greatest("p", "q")).otherwise(F.col("p")) + F.col("d")
    sums = product_sums(vectors.where(F.col("pos") > start), ["key", "p", "d", "q"])

    def fitted(group, products):
        order = int(group["p"]), int(group["d"]), int(group["q"])
        fit = _fit(products, order, p_max)
        if fit is None:
            return []
        beta, errors, sigma2, _ = fit
        return [(group["key"], *order, [float(b) for b in beta], [float(e) for e in errors], float(sigma2))]

    schema = f"key {_key_type(series)}, p int, d int, q int, beta array<double>, std_err array<double>, sigma2 double"
    return stabilise(per_group(sums, schema, fitted), "fits"), vectors.withColumn("p_max", F.lit(p_max))


def arima_parameters(series: DataFrame, orders: DataFrame) -> DataFrame:
    """Coefficient table of the chosen model per series (TSA7)."""
    fits, _ = _fits(series, orders)
    numbered = lambda name, n: F.transform(F.when(F.col(n) > 0, F.sequence(F.lit(1), F.col(n))).otherwise(F.array().cast("array<int>")), lambda k: F.concat(F.lit(name), k.cast("string")))
    constant = F.when(F.col("d") == 0, F.array(F.lit("const"))).otherwise(F.array().cast("array<string>"))
    names = F.concat(constant, numbered("ar", "p"), numbered("ma", "q"))
    rows = F.arrays_zip(names.alias("name"), F.col("beta").alias("value"), F.col("std_err"))
    variance = fits.select("key", F.lit("sigma2").alias("name"), F.col("sigma2").alias("value"), F.lit(None).cast("double").alias("std_err"))
    return fits.select("key", F.inline(rows)).toDF("key", "name", "value", "std_err").unionByName(variance)


def _ahead(steps: Column) -> Column:
    """Expected values of the next days: a fold that carries lags, errors and levels on."""
    dot = lambda a, b: F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda s, v: s + v)
    push = lambda value, a: F.slice(F.concat(F.array(value), a), 1, F.size(a))
    begin = F.struct(
        F.col("past").alias("past"), F.col("errors").alias("errors"), F.col("dy").alias("dy"), F.col("level").alias("level"),
        F.array().cast("array<double>").alias("out"),
    )

    def step(s, _):
        value = F.col("constant") + dot(s["past"], F.col("ar")) + dot(s["errors"], F.col("ma"))
        dy = F.when(F.col("d") == 2, s["dy"] + value).otherwise(value)
        level = F.when(F.col("d") == 0, value).otherwise(s["level"] + dy)
        return F.struct(
            push(value, s["past"]).alias("past"), push(F.lit(0.0), s["errors"]).alias("errors"),
            dy.alias("dy"), level.alias("level"), F.concat(s["out"], F.array(level)).alias("out"),
        )

    days = F.when(steps > 0, F.sequence(F.lit(1), steps)).otherwise(F.array().cast("array<int>"))
    return F.aggregate(days, begin, step, lambda s: s["out"])


def arima_forecast(series: DataFrame, orders: DataFrame, steps: int | DataFrame) -> DataFrame:
    """Fit each series with its order and forecast: key, step, yhat (TSA8, TSA11).

    `steps` is a number for all series, or a frame (key, steps) with one number per series. The
    error of the last day is that of the fit, earlier ones are those of the long autoregression.
    """
    fits, vectors = _fits(series, orders)
    part = lambda a, start, n: F.slice(a, start, n)
    w2 = Window.partitionBy("key").orderBy("t")
    last = vectors.withColumn("before", F.lag("y").over(w2)).groupBy("key").agg(F.max_by(F.struct("x", "y", "before", "p_max"), "pos").alias("l"))
    joined = fits.join(last, "key")
    if isinstance(steps, DataFrame):
        joined = joined.join(steps.select("key", F.col("steps").cast("int")), "key")
    else:
        joined = joined.withColumn("steps", F.lit(int(steps)))
    x, first = F.col("l.x"), F.when(F.col("d") == 0, 1).otherwise(0)
    ready = joined.withColumns(
        {
            "constant": F.when(F.col("d") == 0, F.col("beta")[0]).otherwise(0.0),
            "ar": part(F.col("beta"), first + 1, F.col("p")),
            "ma": part(F.col("beta"), first + F.col("p") + 1, F.col("q")),
            # The last value and its lags; the lags of errors, which the last error comes before.
            "past": part(F.concat(part(x, 1, F.lit(1)), part(x, F.lit(3), F.col("l.p_max"))), 1, F.col("p")),
            "lagged": part(x, F.col("l.p_max") + 3, F.col("q")),
            "dy": F.coalesce(F.col("l.y") - F.col("l.before"), F.lit(0.0)),
            "level": F.col("l.y"),
        }
    )
    dot = lambda a, b: F.aggregate(F.zip_with(a, b, lambda u, v: u * v), F.lit(0.0), lambda s, v: s + v)
    lags = part(x, F.lit(3), F.col("p"))
    error = x[0] - F.col("constant") - dot(lags, F.col("ar")) - dot(F.col("lagged"), F.col("ma"))
    ready = ready.withColumn("errors", part(F.concat(F.array(error), "lagged"), 1, F.col("q")))
    out = ready.select("key", F.posexplode(_ahead(F.col("steps"))).alias("i", "yhat"))
    return out.select("key", (F.col("i") + 1).alias("step"), "yhat")


def forecast_test_span(split: DataFrame, orders: DataFrame) -> DataFrame:
    """Forecast over the test rows of each split series, paired by position (TSA8, JON3).

    `split` comes from `split_series`; the result has key, pos, t, y, yhat.
    """
    test = split.where(~F.col("is_train"))
    spans = split.groupBy("key").agg(
        F.count_if("is_train").alias("n_train"), F.count_if(~F.col("is_train")).alias("steps")
    )
    ahead = arima_forecast(split.where("is_train"), orders, spans.where("steps > 0"))
    placed = ahead.join(spans.select("key", "n_train"), "key").select(
        "key", (F.col("step") + F.col("n_train")).alias("pos"), "yhat"
    )
    return test.select("key", "pos", "t", "y").join(placed, ["key", "pos"])


def model_label(p="p", d="d", q="q"):
    """Label text of a model order (FN-LABEL)."""
    return F.format_string("ARIMA(%d, %d, %d)", p, d, q)


def future_forecast(series: DataFrame, orders: DataFrame, horizon: int = 365) -> DataFrame:
    """Refit on the full history and forecast `horizon` days with their dates (TSA11)."""
    ahead = arima_forecast(series, orders, horizon)
    return ahead.join(future_dates(series, horizon), ["key", "step"]).select("key", "step", "t", "yhat")


def publish_forecast(
    future: DataFrame, orders: DataFrame, metrics: DataFrame, generated_at: object = None
) -> DataFrame:
    """Forecast rows with model label, time of generation and the errors of their own series (TSA12)."""
    stamp = F.current_timestamp() if generated_at is None else F.lit(generated_at)
    about = orders.select("key", model_label().alias("modelo_viento")).join(
        metrics.select(
            "key",
            F.col("rmse").alias("rmse_viento"),
            F.col("r2").alias("r2_viento"),
            F.col("mape").alias("mape_viento"),
        ),
        "key",
        "left",
    )
    return future.join(about, "key").select(
        F.col("t").alias("fecha"),
        F.col("yhat").alias("vviento_pred_ms"),
        F.col("key").alias("CodigoNacional"),
        "modelo_viento",
        stamp.alias("fecha_generacion"),
        "rmse_viento",
        "r2_viento",
        "mape_viento",
    )


def run_summary(split: DataFrame, orders: DataFrame, metrics: DataFrame, horizon: int = 365) -> DataFrame:
    """One row per series: extent, split sizes, model, errors, forecast span (TSA13)."""
    extent = split.groupBy("key").agg(
        F.count("*").alias("n_rows"),
        F.min("t").alias("first_day"),
        F.max("t").alias("last_day"),
        F.count_if("is_train").alias("n_train"),
        F.count_if(~F.col("is_train")).alias("n_test"),
    )
    return (
        extent.join(orders.select("key", model_label().alias("model")), "key", "left")
        .join(metrics.select("key", "rmse", "mae", "r2", "mape"), "key", "left")
        .withColumns(
            {
                "train_share": F.try_divide("n_train", "n_rows"),
                "forecast_days": F.lit(horizon),
                "forecast_from": F.date_add("last_day", 1),
                "forecast_to": F.date_add("last_day", horizon),
            }
        )
    )
