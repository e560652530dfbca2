import datetime as dt
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import rows
from test_series import daily
from veleta.operators import forecasting, series
from veleta.operators.unit_root import unit_root_p, unit_root_test
from veleta.plans.forecasting import forecast_all


def simulate(n, const=0.0, ar=(), ma=(), seed=1, burn=200):
    rng = np.random.default_rng(seed)
    e = rng.normal(size=n + burn)
    y = np.zeros(n + burn)
    for t in range(n + burn):
        y[t] = const + e[t]
        y[t] += sum(a * y[t - i - 1] for i, a in enumerate(ar) if t > i)
        y[t] += sum(m * e[t - j - 1] for j, m in enumerate(ma) if t > j)
    return y[burn:]


MODELS = {
    "ar": (2.0, (0.6,), ()), "ma": (0.0, (), (0.5,)), "both": (1.0, (0.5, -0.3), (0.4,)), "two": (0.0, (), (-0.7, 0.2)), "noise": (5.0, (), ()),
}


def orders_of(spark, orders):
    return spark.createDataFrame([(k, *o) for k, o in orders.items()], "key string, p int, d int, q int")


def test_fits_recover_coefficients(spark):
    """All series at once, each with its own order."""
    frame = daily(spark, **{k: simulate(4000, *m, seed=5) for k, m in MODELS.items()})
    orders = orders_of(spark, {k: (len(ar), 0, len(ma)) for k, (_, ar, ma) in MODELS.items()})
    got = {(r["key"], r["name"]): r["value"] for r in forecasting.arima_parameters(frame, orders).collect()}
    for k, (const, ar, ma) in MODELS.items():
        assert got[k, "const"] == pytest.approx(const, abs=0.25)
        assert [got[k, f"ar{i + 1}"] for i in range(len(ar))] == pytest.approx(list(ar), abs=0.08)
        assert [got[k, f"ma{i + 1}"] for i in range(len(ma))] == pytest.approx(list(ma), abs=0.08)
        assert got[k, "sigma2"] == pytest.approx(1.0, abs=0.08)


def lags_of(x, n, rows_):
    return [x[rows_ - k] for k in range(1, n + 1)]


def two_regressions(y, p, q):
    """Hannan and Rissanen written out with plain least squares; (beta, errors left, days)."""
    long = np.arange(forecasting.LONG, len(y))
    x = np.column_stack([np.ones(len(long)), *lags_of(y, forecasting.LONG, long)])
    e = np.zeros(len(y))
    e[long] = y[long] - x @ np.linalg.lstsq(x, y[long], rcond=None)[0]
    days = np.arange(forecasting.LONG + max(p, q) if q else p, len(y))
    x = np.column_stack([np.ones(len(days)), *lags_of(y, p, days), *lags_of(e, q, days)])
    beta = np.linalg.lstsq(x, y[days], rcond=None)[0]
    left = y[days] - x @ beta
    return beta, left, len(days), np.sqrt(np.diag(np.linalg.inv(x.T @ x)) * (left @ left) / len(days))


@pytest.mark.parametrize("p,q", [(2, 0), (1, 1), (0, 2), (3, 3)])
def test_fits_equal_plain_least_squares(spark, p, q):
    y = simulate(300, 0.5, (0.4, 0.2), (0.3,), seed=3)
    beta, left, days, errors = two_regressions(y, p, q)
    order = orders_of(spark, {"s": (p, 0, q)})
    got = {r["name"]: (r["value"], r["std_err"]) for r in forecasting.arima_parameters(daily(spark, s=y), order).collect()}
    names = ["const", *[f"ar{i + 1}" for i in range(p)], *[f"ma{i + 1}" for i in range(q)]]
    if not got:  # estimates that are not stationary and invertible are no fit
        assert (p, q) == (3, 3)
        return
    assert [got[n][0] for n in names] == pytest.approx(list(beta), abs=1e-8)
    assert [got[n][1] for n in names] == pytest.approx(list(errors), abs=1e-8)
    assert got["sigma2"][0] == pytest.approx(left @ left / days)
    rated = forecasting.arima_search(daily(spark, s=y), [(p, 0, q)]).first()
    k = len(beta) + 1
    deviance = days * (math.log(2 * math.pi * (left @ left) / days) + 1)
    assert (rated["aic"], rated["bic"], rated["nobs"]) == (pytest.approx(deviance + 2 * k), pytest.approx(deviance + math.log(days) * k), days)


def test_overdifferenced_series_stays_invertible(spark):
    found = forecasting.arima_search(daily(spark, s=simulate(400, seed=2)))
    kept = found.where("aic IS NOT NULL").collect()
    assert found.count() == 48 and 20 < len(kept)
    assert forecasting._stable(np.array([0.5])) and not forecasting._stable(np.array([1.01]))


def test_short_and_constant_series_do_not_fit(spark):
    frame = daily(spark, flat=np.ones(50), short=np.arange(5.0))
    found = forecasting.arima_search(frame, [(1, 0, 0), (3, 0, 3)])
    assert found.count() == 4 and found.where("aic IS NOT NULL").count() == 0
    tests = unit_root_test(daily(spark, flat=np.ones(50), short=np.arange(3.0))).collect()
    assert [r["statistic"] for r in tests] == [None, None]


def test_forecasts_by_hand(spark):
    """Folds of given fits: drift of second differences, a lag with a constant, an error of the last day."""
    fold = lambda **c: spark.range(1).select(*[F.expr(v).alias(k) for k, v in c.items()]).select(forecasting._ahead(F.lit(3)).alias("o")).first()["o"]
    none = "CAST(array() AS array<double>)"
    drift = fold(constant="0D", ar=none, ma=none, past=none, errors=none, dy="3D", level="7D", d="2")
    ar1 = fold(constant="1D", ar="array(0.5D)", ma=none, past="array(7D)", errors=none, dy="3D", level="7D", d="0")
    ma1 = fold(constant="0D", ar=none, ma="array(0.5D)", past=none, errors="array(2D)", dy="3D", level="7D", d="1")
    assert drift == [10.0, 13.0, 16.0] and ar1 == [4.5, 3.25, 2.625] and ma1 == [8.0, 8.0, 8.0]


def test_forecast_carries_lags_and_errors_on(spark):
    y = simulate(300, 0.5, (0.4,), (0.3,), seed=3)
    beta, left, _, _ = two_regressions(y, 1, 1)
    want = [beta[0] + beta[1] * y[-1] + beta[2] * left[-1]]
    for _ in range(4):
        want.append(beta[0] + beta[1] * want[-1])
    got = forecasting.arima_forecast(daily(spark, s=y), orders_of(spark, {"s": (1, 0, 1)}), 5)
    assert [r["yhat"] for r in got.orderBy("step").collect()] == pytest.approx(want, abs=1e-8)


def test_unit_root_surface_meets_its_critical_values():
    for tau, p in ((-3.43, 0.01), (-2.86, 0.05), (-2.57, 0.10)):
        assert unit_root_p(tau) == pytest.approx(p, abs=0.002)
    assert unit_root_p(-1.6099) == pytest.approx(unit_root_p(-1.6101), abs=0.002)
    assert (unit_root_p(-30), unit_root_p(5)) == (0.0, 1.0)


def test_unit_root_statistic_equals_plain_least_squares(spark):
    y = simulate(250, 0.2, (0.8,), seed=9)
    row = unit_root_test(daily(spark, s=y)).first()
    dy, days = np.diff(y), np.arange(row["lags"], 249)
    x = np.column_stack([y[days], np.ones(len(days)), *lags_of(dy, row["lags"], days)])
    beta, sse = np.linalg.lstsq(x, dy[days], rcond=None)[:2]
    tau = beta[0] / math.sqrt(sse[0] / (len(days) - x.shape[1]) * np.linalg.inv(x.T @ x)[0, 0])
    assert row["statistic"] == pytest.approx(tau, abs=1e-8) and row["nobs"] == len(days)


def test_unit_root_size_and_power(spark):
    """250 series in one run."""
    rng = np.random.default_rng(7)
    frame = daily(spark, **{f"w{i}": np.cumsum(rng.normal(size=300)) for i in range(200)}, **{f"n{i}": rng.normal(size=300) for i in range(50)})
    found = unit_root_test(frame).toPandas()
    walks = found["key"].str.startswith("w")
    assert 0.005 <= found.loc[walks, "is_stationary"].mean() <= 0.13 and found.loc[~walks, "is_stationary"].mean() > 0.95


@pytest.fixture(scope="module")
def pair(spark):
    return daily(
        spark,
        level=20 + simulate(300, 0, (0.7,), seed=4),
        walk=50 + np.cumsum(simulate(300, seed=6)),
        flat=np.ones(30),
    ).persist()


def test_unit_root_frame(pair):
    got = {r["key"]: r.asDict() for r in unit_root_test(pair).collect()}
    assert got["level"]["is_stationary"] is True and got["walk"]["is_stationary"] is False
    assert got["flat"]["statistic"] is None and got["flat"]["n"] == 30
    assert got["level"]["crit_1"] < got["level"]["crit_5"] < got["level"]["crit_10"]


def test_search_covers_the_grid(pair):
    grid = [(0, 0, 0), (1, 0, 0), (0, 1, 0), (0, 1, 1), (1, 1, 1)]
    table = rows(forecasting.arima_search(pair, grid), "key", "grid_pos")
    assert len(table) == 15 and len({r[7] for r in table if r[0] == "level"}) == 1
    assert all(r[5] is None for r in table if r[0] == "flat")
    best = {r[0]: r[1:4] for r in rows(forecasting.best_order(forecasting.arima_search(pair, grid)))}
    # On the days that all orders share, a lag of nearly one does as well as the difference of a plain walk.
    assert best["level"] == (1, 0, 0) and (best["walk"][1] == 1 or best["walk"] == (1, 0, 0)) and "flat" not in best


def test_search_differences_a_walk_whose_steps_hang_together(spark):
    frame = daily(spark, rolling=np.cumsum(simulate(300, ar=(0.6,), seed=6)))
    best = forecasting.best_order(forecasting.arima_search(frame, [(0, 0, 0), (1, 0, 0), (0, 1, 0), (0, 1, 1), (1, 1, 1)])).first()
    assert best["d"] == 1


def test_default_grid_has_48_orders():
    grid = forecasting.parameter_grid()
    assert len(grid) == 48 and grid[0] == (0, 0, 0) and grid[1] == (0, 0, 1) and grid[-1] == (3, 2, 3)


def test_forecast_run(pair):
    stamp = dt.datetime(2024, 1, 1)
    run = forecast_all(pair.where("key <> 'flat'"), [(0, 0, 0), (1, 0, 0), (0, 1, 0)], horizon=10, generated_at=stamp)
    assert run.pairs.count() == 120
    assert run.pairs.where("key = 'level'").agg(F.min("pos"), F.max("pos")).first()[:] == (241, 300)
    published = run.published
    assert published.columns == [
        "fecha", "vviento_pred_ms", "CodigoNacional", "modelo_viento", "fecha_generacion", "rmse_viento", "r2_viento", "mape_viento",
    ]
    assert published.count() == 20 and published.where("rmse_viento IS NULL").count() == 0
    first = published.where("CodigoNacional = 'walk'").orderBy("fecha").first()
    assert first["modelo_viento"] == "ARIMA(0, 1, 0)" and first["fecha_generacion"] == stamp
    assert first["fecha"] == dt.date(2022, 1, 1) + dt.timedelta(days=300)
    last = pair.where("key = 'walk'").agg(F.max_by("y", "t")).first()[0]
    assert first["vviento_pred_ms"] == pytest.approx(last)
    summary = {r["key"]: r.asDict() for r in run.summary.collect()}
    assert (summary["level"]["n_train"], summary["level"]["n_test"], summary["level"]["model"]) == (240, 60, "ARIMA(1, 0, 0)")


def test_parameter_table(pair):
    orders = forecasting.best_order(forecasting.arima_search(pair, [(1, 0, 1)]))
    got = {r["name"]: r for r in forecasting.arima_parameters(pair.where("key = 'level'"), orders).collect()}
    assert set(got) == {"const", "ar1", "ma1", "sigma2"}
    assert got["ar1"]["value"] == pytest.approx(0.7, abs=0.2) and 0 < got["ar1"]["std_err"] < 0.2


def test_steps_may_differ_by_series(spark, pair):
    orders = spark.createDataFrame([("level", 0, 0, 0), ("walk", 0, 1, 0)], "key string, p int, d int, q int")
    steps = spark.createDataFrame([("level", 2), ("walk", 5)], "key string, steps int")
    got = rows(forecasting.arima_forecast(pair, orders, steps).groupBy("key").count(), "key")
    assert got == [("level", 2), ("walk", 5)]
    assert series.future_dates(pair, 2).count() == 6
