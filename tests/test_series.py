import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import plan_of, rows
from veleta.operators import metrics, series

DAY = dt.date(2022, 1, 1)


def daily(spark, **values):
    data = [(k, DAY + dt.timedelta(days=i), None if v is None else float(v)) for k, vs in values.items() for i, v in enumerate(vs)]
    return spark.createDataFrame(data, "key string, t date, y double")


def brute_acf(y, lags):
    c = np.asarray(y) - np.mean(y)
    return [float(c[: len(c) - k] @ c[k:] / (c @ c)) for k in range(lags + 1)]


@pytest.fixture(scope="module")
def noise():
    rng = np.random.default_rng(11)
    return np.cumsum(rng.normal(size=160)) + 10 * np.sin(np.arange(160) / 4)


def test_prepare_series_keeps_the_first_value_of_a_day(spark):
    df = spark.createDataFrame(
        [(400009.0, "2024-01-02 08:00:00", 2.0, 7), (400009.0, "2024-01-02", 3.0, 5), (400009.0, "2024-01-01", 1.0, 9), (1.0, "bad", 4.0, 1)],
        "code double, fecha string, v double, seq int",
    )
    out = series.prepare_series(df, "code", "fecha", "v", "seq")
    assert rows(out.where("t IS NOT NULL"), "t") == [(400009.0, dt.date(2024, 1, 1), 1.0), (400009.0, dt.date(2024, 1, 2), 3.0)]
    plain = series.prepare_series(df, "code", "fecha", "v")
    assert rows(plain.where("t = DATE'2024-01-02'"))[0][2] == 3.0
    again = series.prepare_series(out, "key", "t", "y")
    assert sorted(rows(again), key=repr) == sorted(rows(out), key=repr)


def test_nan_is_missing(spark):
    df = spark.createDataFrame([("a", DAY, float("nan")), ("a", DAY + dt.timedelta(days=1), 2.0)], "k string, t date, v double")
    assert [r[2] for r in rows(series.prepare_series(df, "k", "t", "v"), "t")] == [None, 2.0]
    assert series.acf(series.prepare_series(df, "k", "t", "v"), 3).count() == 1


def test_series_operators_refuse_undaily_input(spark):
    with pytest.raises(TypeError):
        series.acf(spark.sql("SELECT 'a' AS key, TIMESTAMP'2024-01-01' AS t, 1.0D AS y"))


def test_split_sizes(spark):
    out = series.split_series(daily(spark, a=range(101), b=range(10)))
    assert rows(out.groupBy("key").agg(F.count_if("is_train")), "key") == [("a", 80), ("b", 8)]


def test_trailing_730_days(spark):
    df = daily(spark, a=range(800), b=range(5))
    assert rows(series.trailing(df).groupBy("key").count(), "key") == [("a", 730), ("b", 5)]
    assert series.trailing(df, inclusive=True).where("key = 'a'").count() == 731


@pytest.mark.parametrize("d", [0, 1, 2, 3])
def test_difference(spark, noise, d):
    got = [r[0] for r in rows(series.difference(daily(spark, a=noise), d).orderBy("t").select("dy"))]
    assert got[:d] == [None] * d
    assert got[d:] == pytest.approx(list(np.diff(noise, n=d)))


@pytest.mark.parametrize("period", [1, 2, 5, 7, 12])
def test_moving_average(spark, noise, period):
    got = [r[0] for r in rows(series.moving_average(daily(spark, a=noise, b=noise[::-1]), period).where("key = 'a'").orderBy("t").select("trend"))]
    half = period // 2
    weights = np.ones(period) if period % 2 else np.r_[0.5, np.ones(period - 1), 0.5]
    want = np.convolve(noise, weights / period, "valid")
    assert got[:half] == [None] * half and got[len(got) - half:] == [None] * half
    assert got[half: len(got) - half] == pytest.approx(list(want))


def test_acf_against_direct_sums(spark, noise):
    got = series.acf(daily(spark, a=noise, short=[1, 2, 4], flat=[3, 3, 3]), 40)
    a = [r[2] for r in rows(got.where("key = 'a'"), "lag")]
    assert a == pytest.approx(brute_acf(noise, 40)) and a[0] == 1.0
    r = brute_acf(noise, 40)
    bands = [0.0] + [1.959964 * np.sqrt((1 + 2 * sum(v * v for v in r[1:k])) / len(noise)) for k in range(1, 41)]
    assert [x[3] for x in rows(got.where("key = 'a'"), "lag")] == pytest.approx(bands, rel=1e-6)
    assert [r[1] for r in rows(got.where("key = 'short'"), "lag")] == [0, 1, 2]
    assert all(r[2] is None for r in rows(got.where("key = 'flat'")))


def test_pacf_against_yule_walker(spark, noise):
    got = [r[2] for r in rows(series.pacf(daily(spark, a=noise, b=[1, 3, 2]), 20).where("key = 'a'"), "lag")]
    r = brute_acf(noise, 20)
    want = [1.0]
    for k in range(1, 21):
        system = np.array([[r[abs(i - j)] for j in range(k)] for i in range(k)])
        want.append(float(np.linalg.solve(system, r[1: k + 1])[-1]))
    assert got == pytest.approx(want)


def brute_decomposition(y, period):
    half = period // 2
    weights = (np.ones(period) if period % 2 else np.r_[0.5, np.ones(period - 1), 0.5]) / period
    trend = np.full(len(y), np.nan)
    trend[half: len(y) - half] = np.convolve(y, weights, "valid")
    means = np.array([np.nanmean((y - trend)[i::period]) for i in range(period)])
    seasonal = np.resize(means - means.mean(), len(y))
    return trend, seasonal, y - trend - seasonal


@pytest.mark.parametrize("period", [7, 12, 30])
def test_decomposition(spark, noise, period):
    out = series.decompose_additive(daily(spark, a=noise, short=noise[: 2 * period - 1]), period)
    pdf = out.orderBy("t").toPandas()
    assert set(pdf["key"]) == {"a"} and len(pdf) == len(noise)
    trend, seasonal, resid = brute_decomposition(noise, period)
    for name, want in (("trend", trend), ("seasonal", seasonal), ("resid", resid)):
        assert np.allclose(pdf[name].astype(float), want, equal_nan=True)


def test_decomposition_moves_each_row_once(spark, noise):
    assert plan_of(series.decompose_additive(daily(spark, a=noise), 7)).count("Exchange hashpartitioning(key") == 1


def test_missing_values_are_left_out_of_diagnostics(spark, noise):
    gaps = [None if i % 10 == 3 else v for i, v in enumerate(noise)]
    known = [v for v in gaps if v is not None]
    got = [r[2] for r in rows(series.acf(daily(spark, a=gaps), 5), "lag")]
    assert got == pytest.approx(brute_acf(known, 5))


def test_future_dates_and_labelled_union(spark):
    df = daily(spark, a=range(60))
    dates = series.future_dates(df, 3)
    assert rows(dates, "step") == [("a", i, DAY + dt.timedelta(days=59 + i)) for i in (1, 2, 3)]
    both = series.history_plus_forecast(df, dates)
    assert rows(both.groupBy("kind").count(), "kind") == [("forecast", 3), ("history", 60)]


def test_forecast_metrics_by_hand(spark):
    df = spark.createDataFrame(
        [("a", 1, 2.0, 1.0), ("a", 2, 0.0, 1.0), ("a", 3, 4.0, 5.0), ("a", 4, None, 1.0), ("flat", 1, 3.0, 2.0),
         ("flat", 2, 3.0, 4.0), ("zero", 1, 0.0, 1.0)],
        "key string, pos int, y double, yhat double",
    )
    got = {r["key"]: r.asDict() for r in metrics.forecast_metrics(df, ["key"]).collect()}
    assert [got["a"][c] for c in ("n", "mse", "rmse", "mae", "r2", "mape")] == pytest.approx([3, 1.0, 1.0, 1.0, 0.625, 37.5])
    assert got["flat"]["r2"] is None and got["zero"]["mape"] is None


def test_best_candidate_prefers_the_earlier_of_equals(spark):
    df = spark.createDataFrame(
        [("a", 1, 0, 5.0), ("a", 2, 1, 4.0), ("a", 3, 2, 4.0), ("a", 4, 3, None), ("b", 1, 0, None)],
        "key string, p int, grid_pos int, aic double",
    )
    assert rows(metrics.best_candidate(df, ["key"], ["p"])) == [("a", 2, 4.0)]
