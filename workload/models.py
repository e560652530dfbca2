"""Forecasting of every series, imputation, model search."""

from __future__ import annotations

import datetime as dt

from pyspark.ml.regression import LinearRegression
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from veleta.operators import forecasting, series
from veleta.operators.categories import coded, dictionary, fit_categories
from veleta.operators.imputation import apply_imputer, fit_imputer
from veleta.operators.metrics import forecast_metrics
from veleta.operators.ordering import ordered_holdout
from veleta.operators.search import calendar_features, load_model, model_search, prepare_features, save_model
from veleta.operators.search import score
from veleta.operators.unit_root import unit_root_test
from veleta.plans.forecasting import forecast_all
from veleta.session import run_dir, stabilise
from veleta.sinks import open_lakehouse
from veleta.sinks.published import publish
from veleta.sources import scan
from workload.adapters import SERIES_SQL, order_series, table, wind_obs
from workload.registry import registered

STAMP = dt.datetime(2024, 2, 1)


@registered()
def adf_test(spark, sf_dir):
    return unit_root_test(order_series(spark, sf_dir))


def _train(spark, sf_dir):
    return series.split_series(order_series(spark, sf_dir)).where("is_train")


@registered()
def arima_search(spark, sf_dir):
    """All 48 orders for every series."""
    return forecasting.arima_search(_train(spark, sf_dir))


def _published(spark, df, name):
    """Publish a frame in a lakehouse of its own and read it by its name."""
    folder = run_dir(spark, name)
    full = f"{open_lakehouse(spark, folder.rsplit('/', 1)[1], location=folder)}.{name}"
    publish(df, full)
    return scan(spark, full)


def _orders(spark, sf_dir):
    """Best of all 48 orders of every series."""
    return stabilise(forecasting.best_order(forecasting.arima_search(_train(spark, sf_dir))))


@registered()
def arima_parameters(spark, sf_dir):
    return forecasting.arima_parameters(_train(spark, sf_dir), _orders(spark, sf_dir))


@registered()
def arima_test_forecast(spark, sf_dir):
    split = series.split_series(order_series(spark, sf_dir))
    return forecasting.forecast_test_span(split, _orders(spark, sf_dir))


@registered()
def arima_forecast(spark, sf_dir):
    return forecasting.future_forecast(order_series(spark, sf_dir), _orders(spark, sf_dir))


@registered(f"""WITH {SERIES_SQL}
SELECT key, CAST(last + CAST(step AS INTEGER) AS DATE) AS t, round(mean, 9) AS yhat
FROM (SELECT key, max(t) AS last, avg(y) AS mean FROM series GROUP BY key) l, (SELECT unnest(range(1, 366)) AS step) s""", text=["t"])
def mean_model_forecast(spark, sf_dir):
    """Order (0, 0, 0) forecasts the mean of the series, which SQL can check."""
    s = order_series(spark, sf_dir)
    order = s.select("key").distinct().select("key", *[F.lit(0).alias(c) for c in "pdq"])
    return forecasting.future_forecast(s, order).select("key", "t", F.round("yhat", 9).alias("yhat"))


@registered(f"""WITH {SERIES_SQL}
SELECT key, CAST(last + CAST(step AS INTEGER) AS DATE) AS t, round(y, 9) AS yhat
FROM (SELECT key, max(t) AS last, max_by(y, t) AS y FROM series GROUP BY key) l, (SELECT unnest(range(1, 366)) AS step) s""", text=["t"])
def random_walk_forecast(spark, sf_dir):
    """Order (0, 1, 0) carries the last value on, which SQL can check."""
    s = order_series(spark, sf_dir)
    order = s.select("key").distinct().select("key", F.lit(0).alias("p"), F.lit(1).alias("d"), F.lit(0).alias("q"))
    return forecasting.future_forecast(s, order).select("key", "t", F.round("yhat", 9).alias("yhat"))


@registered()
def forecast_published(spark, sf_dir):
    """The forecast as its readers see it: published under a name, then read by that name."""
    return _published(spark, forecast_all(order_series(spark, sf_dir), generated_at=STAMP).published, "predicciones")


@registered()
def forecast_summary(spark, sf_dir):
    return forecast_all(order_series(spark, sf_dir)).summary


# --- autoregressions, which SQL can fit ---------------------------------------------------

AR_ORDERS = [(0, 0, 0), (0, 1, 0), (1, 0, 0), (1, 1, 0)]

# Conditional least squares of the four orders over train days 3 to the last.
AR_SQL = SERIES_SQL + """,
train AS (SELECT * FROM placed WHERE pos <= floor(0.8e0 * n)),
lagged AS (SELECT *, lag(y) OVER w AS y1, lag(y, 2) OVER w AS y2 FROM train WINDOW w AS (PARTITION BY key ORDER BY t)),
errors AS (
  SELECT key, count(*) AS m, var_pop(y) * count(*) AS e000, sum((y - y1) ** 2) AS e010,
         regr_syy(y, y1) - regr_sxy(y, y1) ** 2 / regr_sxx(y, y1) AS e100,
         sum((y - y1) ** 2) - sum((y - y1) * (y1 - y2)) ** 2 / sum((y1 - y2) ** 2) AS e110
  FROM lagged WHERE pos > 2 GROUP BY key
),
fits AS (
  SELECT key, 0 AS p, 0 AS d, 0 AS grid_pos, m, e000 AS sse, 2 AS k FROM errors
  UNION ALL SELECT key, 0, 1, 1, m, e010, 1 FROM errors
  UNION ALL SELECT key, 1, 0, 2, m, e100, 3 FROM errors
  UNION ALL SELECT key, 1, 1, 3, m, e110, 2 FROM errors
),
rated AS (SELECT *, m * (ln(2 * pi() * sse / m) + 1) AS dev FROM fits)"""


@registered(f"""WITH {AR_SQL}
SELECT key, p, d, 0 AS q, grid_pos, round(dev + 2 * k, 4) AS aic, round(dev + ln(m) * k, 4) AS bic, m AS nobs FROM rated""")
def ar_search(spark, sf_dir):
    out = forecasting.arima_search(_train(spark, sf_dir), AR_ORDERS)
    return out.withColumns({c: F.round(c, 4) for c in ("aic", "bic")})


@registered(f"""WITH {AR_SQL}
SELECT key, p, d, 0 AS q, round(dev + 2 * k, 4) AS aic FROM rated
QUALIFY row_number() OVER (PARTITION BY key ORDER BY dev + 2 * k, grid_pos) = 1""")
def ar_best_order(spark, sf_dir):
    found = forecasting.best_order(forecasting.arima_search(_train(spark, sf_dir), AR_ORDERS))
    return found.withColumn("aic", F.round("aic", 4))


# One lag with a constant, fitted over all days but the first of the given rows.
AR1_SQL = """
ar1 AS (
  SELECT key, count(*) AS m, regr_intercept(y, y1) AS c, regr_slope(y, y1) AS phi, avg(y1) AS mean1,
         regr_sxx(y, y1) AS sxx, (regr_syy(y, y1) - regr_sxy(y, y1) ** 2 / regr_sxx(y, y1)) / count(*) AS sigma2,
         max_by(y, t) AS last_y, max(t) AS last_t
  FROM {rows} WHERE y1 IS NOT NULL GROUP BY key
)"""


def _ar1_orders(spark, sf_dir):
    keys = order_series(spark, sf_dir).select("key").distinct()
    return keys.select("key", F.lit(1).alias("p"), F.lit(0).alias("d"), F.lit(0).alias("q"))


@registered(f"""WITH {AR_SQL}, {AR1_SQL.format(rows='lagged')}
SELECT key, 'const' AS name, round(c, 8) AS value, round(sqrt(sigma2 * (1.0e0 / m + mean1 ** 2 / sxx)), 8) AS std_err FROM ar1
UNION ALL SELECT key, 'ar1', round(phi, 8), round(sqrt(sigma2 / sxx), 8) FROM ar1
UNION ALL SELECT key, 'sigma2', round(sigma2, 8), NULL FROM ar1""")
def ar1_parameters(spark, sf_dir):
    out = forecasting.arima_parameters(_train(spark, sf_dir), _ar1_orders(spark, sf_dir))
    return out.withColumns({c: F.round(c, 8) for c in ("value", "std_err")})


@registered(f"""WITH {AR_SQL}, {AR1_SQL.format(rows='lagged')},
pairs AS (
  SELECT p.key, y, c / (1 - phi) + phi ** (pos - floor(0.8e0 * n)) * (last_y - c / (1 - phi)) AS yhat
  FROM placed p JOIN ar1 ON ar1.key = p.key WHERE pos > floor(0.8e0 * n)
)
SELECT key, count(*) AS n, round(sqrt(avg((y - yhat) ** 2)), 8) AS rmse, round(avg(abs(y - yhat)), 8) AS mae,
       round(1 - sum((y - yhat) ** 2) / (var_pop(y) * count(*)), 6) AS r2,
       round(avg(abs((y - yhat) / nullif(y, 0))) * 100, 5) AS mape FROM pairs GROUP BY key""")
def ar1_test_metrics(spark, sf_dir):
    split = series.split_series(order_series(spark, sf_dir))
    pairs = forecasting.forecast_test_span(split, _ar1_orders(spark, sf_dir))
    out = forecast_metrics(pairs, ["key"]).drop("mse")
    return out.withColumns({c: F.round(c, n) for c, n in {"rmse": 8, "mae": 8, "r2": 6, "mape": 5}.items()})


# Search between mean and one lag, test, refit on all days, forecast 30 days, attach errors.
RUN_SQL = AR_SQL + ", " + AR1_SQL.format(rows="lagged") + """,
chosen AS (
  SELECT key, CASE WHEN sse1 > 0 AND m * ln(sse1 / m) + 2 < m * ln(sse0 / m) THEN 1 ELSE 0 END AS p
  FROM (SELECT key, count(*) AS m, var_pop(y) * count(*) AS sse0,
               regr_syy(y, y1) - regr_sxy(y, y1) ** 2 / regr_sxx(y, y1) AS sse1
        FROM lagged WHERE pos > 1 GROUP BY key) e
),
levels AS (SELECT key, avg(y) AS mean FROM train GROUP BY key),
pairs AS (
  SELECT s.key, y, CASE WHEN p = 0 THEN mean
    ELSE c / (1 - phi) + phi ** (pos - floor(0.8e0 * n)) * (last_y - c / (1 - phi)) END AS yhat
  FROM placed s JOIN ar1 ON ar1.key = s.key JOIN chosen ON chosen.key = s.key JOIN levels ON levels.key = s.key
  WHERE pos > floor(0.8e0 * n)
),
errs AS (
  SELECT key, sqrt(avg((y - yhat) ** 2)) AS rmse, avg(abs(y - yhat)) AS mae,
         1 - sum((y - yhat) ** 2) / (var_pop(y) * count(*)) AS r2,
         avg(abs((y - yhat) / nullif(y, 0))) * 100 AS mape FROM pairs GROUP BY key
),
every_day AS (SELECT *, lag(y) OVER (PARTITION BY key ORDER BY t) AS y1 FROM placed),
refit AS (
  SELECT key, avg(y) AS mean, regr_intercept(y, y1) AS c, regr_slope(y, y1) AS phi, max_by(y, t) AS last_y, max(t) AS last_t
  FROM every_day GROUP BY key
)"""
RUN_ORDERS = [(0, 0, 0), (1, 0, 0)]


@registered(f"""WITH {RUN_SQL}
SELECT CAST(last_t + CAST(step AS INTEGER) AS DATE) AS fecha, r.key AS "CodigoNacional",
       round(CASE WHEN p = 0 THEN mean ELSE c / (1 - phi) + phi ** step * (last_y - c / (1 - phi)) END, 8) AS vviento_pred_ms,
       'ARIMA(' || p || ', 0, 0)' AS modelo_viento, TIMESTAMP '2024-02-01' AS fecha_generacion,
       round(rmse, 8) AS rmse_viento, round(r2, 6) AS r2_viento, round(mape, 5) AS mape_viento
FROM refit r JOIN chosen ON chosen.key = r.key JOIN errs ON errs.key = r.key, (SELECT unnest(range(1, 366)) AS step) s""", text=["fecha"])
def ar_run_published(spark, sf_dir):
    out = forecast_all(order_series(spark, sf_dir), RUN_ORDERS, generated_at=STAMP).published
    digits = {"vviento_pred_ms": 8, "rmse_viento": 8, "r2_viento": 6, "mape_viento": 5}
    return out.withColumns({c: F.round(c, n) for c, n in digits.items()})


@registered(f"""WITH {RUN_SQL}
SELECT s.key, count(*) AS n_rows, min(t) AS first_day, max(t) AS last_day, count(*) FILTER (WHERE pos <= floor(0.8e0 * n)) AS n_train,
       count(*) FILTER (WHERE pos > floor(0.8e0 * n)) AS n_test, 'ARIMA(' || any_value(p) || ', 0, 0)' AS model,
       round(any_value(rmse), 8) AS rmse, round(any_value(mae), 8) AS mae, round(any_value(r2), 6) AS r2,
       round(any_value(mape), 5) AS mape, round(count_if(pos <= floor(0.8e0 * n)) / count(*), 6) AS train_share,
       365 AS forecast_days, CAST(max(t) + 1 AS DATE) AS forecast_from, CAST(max(t) + 365 AS DATE) AS forecast_to
FROM placed s JOIN chosen ON chosen.key = s.key JOIN errs ON errs.key = s.key GROUP BY s.key""", text=["first_day", "last_day", "forecast_from", "forecast_to"])
def ar_run_summary(spark, sf_dir):
    out = forecast_all(order_series(spark, sf_dir), RUN_ORDERS).summary
    digits = {"rmse": 8, "mae": 8, "r2": 6, "mape": 5, "train_share": 6}
    return out.withColumns({c: F.round(c, n) for c, n in digits.items()})


# --- imputation --------------------------------------------------------------------------

_GAPS_SQL = """
gaps AS (
  SELECT event_id, CASE WHEN event_id % 11 <> 0 THEN value END AS value,
         CASE WHEN event_id % 7 <> 0 THEN ts END AS seen,
         CASE WHEN event_id % 5 <> 0 THEN CAST(user_id AS DOUBLE) END AS code,
         CASE WHEN event_id % 3 <> 0 THEN event_type END AS kind
  FROM events
)"""


def _gaps(spark, sf_dir):
    i = F.col("event_id")
    return table(spark, sf_dir, "events").select(
        "event_id",
        F.when(i % 11 != 0, F.col("value")).alias("value"),
        F.when(i % 7 != 0, F.col("ts")).alias("seen"),
        F.when(i % 5 != 0, F.col("user_id").cast("double")).alias("code"),
        F.when(i % 3 != 0, F.col("event_type")).alias("kind"),
    )


@registered(f"""WITH {_GAPS_SQL},
kinds AS (SELECT kind FROM gaps WHERE kind IS NOT NULL GROUP BY kind ORDER BY count(*) DESC, kind LIMIT 1),
first_seen AS (SELECT seen FROM gaps WHERE seen IS NOT NULL GROUP BY seen ORDER BY count(*) DESC, seen LIMIT 1)
SELECT event_id,
       round(coalesce(value, (SELECT CASE WHEN skewness(value) <= 1 THEN avg(value) ELSE median(value) END FROM gaps)), 6) AS value,
       coalesce(last_value(seen IGNORE NULLS) OVER (ORDER BY event_id ROWS UNBOUNDED PRECEDING), (SELECT seen FROM first_seen)) AS seen,
       round(coalesce(code, (SELECT CASE WHEN skewness(code) <= 1 THEN avg(code) ELSE median(code) END FROM gaps)), 6) AS code,
       coalesce(kind, (SELECT kind FROM kinds)) AS kind
FROM gaps""")
def fill_missing(spark, sf_dir):
    """Strategy by skewness, forward fill of times by event number, most frequent kind."""
    gaps = _gaps(spark, sf_dir)
    imputer = fit_imputer(gaps, exclude=["event_id"])
    ranges = [F.floor(F.col("event_id") / n) for n in (100_000_000, 100_000)]
    filled = apply_imputer(gaps, imputer, order=["event_id"], chunk=ranges)
    return filled.withColumns({c: F.round(c, 6) for c in ("value", "code")})


@registered(f"""WITH {_GAPS_SQL}
SELECT 'value' AS "column", CASE WHEN skewness(value) <= 1 THEN 'mean' ELSE 'median' END AS strategy FROM gaps
UNION ALL SELECT 'code', CASE WHEN skewness(code) <= 1 THEN 'mean' ELSE 'median' END FROM gaps
UNION ALL SELECT 'kind', 'mode' UNION ALL SELECT 'seen', 'forward'""")
def fill_strategies(spark, sf_dir):
    return fit_imputer(_gaps(spark, sf_dir), exclude=["event_id"]).as_rows(spark).select("column", "strategy")


# --- model search ------------------------------------------------------------------------

def _daily_wind(spark, sf_dir):
    """Daily mean per station with its calendar parts."""
    obs = wind_obs(spark, sf_dir)
    return obs.groupBy(F.col("CodigoNacional"), F.to_date("time").alias("fecha")).agg(
        F.avg("ff_valor").alias("vviento_promedio"), F.avg("dd_valor").alias("dd"), F.max("VRB_Valor").alias("vrb")
    )


def _prepared(spark, sf_dir):
    return prepare_features(_daily_wind(spark, sf_dir), order=["fecha", "CodigoNacional"])


@registered("""
WITH d AS (SELECT user_id, CAST(ts AS DATE) AS fecha FROM events GROUP BY 1, 2)
SELECT CASE WHEN pos <= n - floor(0.2e0 * n) THEN 'train' ELSE 'test' END AS part, count(*) AS n_rows,
       min(fecha) AS first_day, max(fecha) AS last_day, CAST(0 AS BIGINT) AS n_missing
FROM (SELECT *, row_number() OVER (ORDER BY fecha, user_id) AS pos, count(*) OVER () AS n FROM d) p GROUP BY 1""", text=["first_day", "last_day"])
def prepared_features(spark, sf_dir):
    p = _prepared(spark, sf_dir)
    parts = p.train.withColumn("part", F.lit("train")).unionByName(p.test.withColumn("part", F.lit("test")))
    gaps = sum((F.col(c).isNull().cast("int") for c in p.train.columns), start=F.lit(0))
    return parts.groupBy("part").agg(
        F.count("*").alias("n_rows"),
        F.min("fecha").cast("date").alias("first_day"),
        F.max("fecha").cast("date").alias("last_day"),
        F.sum(gaps).alias("n_missing"),
    )


_FEATURES = ["CodigoNacional", "dd", "vrb", "fecha_day", "fecha_dow"]


def _search(spark, sf_dir, trials):
    p = _prepared(spark, sf_dir)
    train = calendar_features(p.train, "fecha")
    return p, *model_search(train, "vviento_promedio", _FEATURES, ["fecha", "CodigoNacional"], max_trials=trials)


@registered()
def model_trials(spark, sf_dir):
    """Ten trials on the ordered holdout."""
    return _published(spark, _search(spark, sf_dir, 10)[2], "ensayos").drop("seconds")


@registered()
def batch_score(spark, sf_dir):
    """Best of ten trials stored, loaded and applied to the held-out days."""
    p, model, _ = _search(spark, sf_dir, 10)
    root = run_dir(spark, "models")
    save_model(model, root, "viento", 1)
    test = calendar_features(p.test, "fecha")
    scored = score(load_model(root, "viento", 1), test, keep=["CodigoNacional", "fecha"])
    return _published(spark, scored, "puntajes")


@registered("""
WITH d AS (SELECT user_id, CAST(ts AS DATE) AS fecha, avg(CAST(json_extract_string(props, '$.k') AS DOUBLE)) AS k,
                  avg(value) AS y FROM events GROUP BY 1, 2),
p AS (SELECT *, row_number() OVER (ORDER BY fecha, user_id) AS pos, count(*) OVER () AS n FROM d),
fit AS (SELECT regr_intercept(y, k) AS a, regr_slope(y, k) AS b FROM p WHERE pos <= n - floor(0.2e0 * n))
SELECT user_id, fecha, round(a + b * k, 3) AS value FROM p, fit WHERE pos > n - floor(0.2e0 * n)""", text=["fecha"])
def linear_score(spark, sf_dir):
    """Search with one plain linear learner, scored on the held-out days; SQL can fit it."""
    daily = table(spark, sf_dir, "events").groupBy("user_id", F.to_date("ts").alias("fecha")).agg(
        F.avg(F.get_json_object("props", "$.k").cast("double")).alias("k"), F.avg("value").alias("y")
    )
    order = ["fecha", "user_id"]
    marked = stabilise(ordered_holdout(daily, [], order))
    space = {"linear": (LinearRegression, {"regParam": [0.0], "solver": ["normal"]})}
    model, _ = model_search(marked.where("is_train"), "y", ["k"], order, max_trials=1, space=space)
    out = model.transform(marked.where("NOT is_train"))
    return _published(spark, out.select("user_id", "fecha", F.round("prediction", 3).alias("value")), "lineal")


_CATEGORIES_SQL = """
o AS (SELECT o_orderkey, CASE WHEN o_orderkey % 9 <> 0 THEN o_orderpriority END AS priority, o_orderstatus AS status,
             o_orderstatus <> 'P' AND o_orderkey % 5 <> 0 AS is_train FROM orders),
counted AS (
  SELECT 'priority' AS "column", priority AS value, count(*) AS n FROM o WHERE is_train AND priority IS NOT NULL GROUP BY priority
  UNION ALL SELECT 'status', status, count(*) FROM o WHERE is_train AND status IS NOT NULL GROUP BY status
),
codes AS (SELECT "column", value, CAST(row_number() OVER (PARTITION BY "column" ORDER BY n DESC, value) - 1 AS INTEGER) AS code FROM counted),
others AS (SELECT "column", CAST(max(code) + 1 AS INTEGER) AS code FROM codes GROUP BY 1)"""


def _categories(spark, sf_dir):
    key = F.col("o_orderkey")
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey", F.when(key % 9 != 0, F.col("o_orderpriority")).alias("priority"), F.col("o_orderstatus").alias("status")
    )
    is_train = (F.col("status") != "P") & (key % 5 != 0)
    return orders, fit_categories(orders.where(is_train), ["priority", "status"])


@registered(f"""WITH {_CATEGORIES_SQL} SELECT "column", value, code FROM codes UNION ALL SELECT "column", NULL, code FROM others""")
def category_dictionary(spark, sf_dir):
    """Codes by frequency of the training rows, and the place for all other values."""
    orders, model = _categories(spark, sf_dir)
    return dictionary(model, orders)


@registered(f"""WITH {_CATEGORIES_SQL}
SELECT o_orderkey, coalesce(p.code, po.code) AS priority_code, coalesce(s.code, so.code) AS status_code
FROM o LEFT JOIN codes p ON p."column" = 'priority' AND p.value = o.priority
       LEFT JOIN codes s ON s."column" = 'status' AND s.value = o.status
       JOIN others po ON po."column" = 'priority' JOIN others so ON so."column" = 'status'""")
def category_codes(spark, sf_dir):
    """Every order coded, with missing priorities and a status that training never saw."""
    orders, model = _categories(spark, sf_dir)
    return coded(model, orders).select(
        "o_orderkey", F.col("priority__code").alias("priority_code"), F.col("status__code").alias("status_code")
    )


@registered("""
SELECT 2 AS version, o_orderpriority AS priority, count(*) AS n, round(sum(o_totalprice), 2) AS total FROM orders GROUP BY 2""")
def published_versions(spark, sf_dir):
    """Two versions with other columns are published; a third one fails its check and is never seen."""
    folder = run_dir(spark, "published")
    name = f"{open_lakehouse(spark, folder.rsplit('/', 1)[1], location=folder)}.resumen"
    by = table(spark, sf_dir, "orders").groupBy(F.col("o_orderpriority").alias("priority"))
    publish(by.agg(F.lit(1).alias("version"), F.count("*").alias("n")), name)
    publish(by.agg(F.lit(2).alias("version"), F.count("*").alias("n"), F.round(F.sum("o_totalprice"), 2).alias("total")), name)

    def refuse(rows):
        raise ValueError("too few rows")

    try:
        publish(by.agg(F.lit(3).alias("version")), name, check=refuse)
    except ValueError:
        pass
    return scan(spark, name)
