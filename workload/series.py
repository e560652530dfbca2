"""Series algebra, diagnostics, forecast evaluation."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from veleta.operators import metrics, ordering, profile, series
from workload.adapters import SERIES_SQL, WIND_SQL, order_series, table, wind_obs
from workload.registry import registered


@registered("""
SELECT o_orderpriority AS key, CAST(o_orderdate AS DATE) AS t, o_totalprice AS y FROM orders
QUALIFY row_number() OVER (PARTITION BY o_orderpriority, CAST(o_orderdate AS DATE) ORDER BY o_orderkey) = 1""", text=["t"])
def series_prepared(spark, sf_dir):
    return series.prepare_series(
        table(spark, sf_dir, "orders"), "o_orderpriority", "o_orderdate", "o_totalprice", "o_orderkey"
    )


@registered(f"""WITH {SERIES_SQL} SELECT key, t, pos, n, pos <= floor(0.8e0 * n) AS is_train FROM placed""", text=["t"])
def ordered_split(spark, sf_dir):
    return series.split_series(order_series(spark, sf_dir)).withColumn("pos", F.col("pos").cast("bigint")).drop("y")


@registered(f"""WITH {SERIES_SQL}
SELECT key, count(*) FILTER (WHERE pos <= n - floor(0.2e0 * n)) AS n_train, count(*) FILTER (WHERE pos > n - floor(0.2e0 * n)) AS n_test FROM placed GROUP BY key""")
def ordered_holdout(spark, sf_dir):
    marked = ordering.ordered_holdout(order_series(spark, sf_dir), ["key"], ["t"])
    return marked.groupBy("key").agg(
        F.count_if("is_train").alias("n_train"), F.count_if(~F.col("is_train")).alias("n_test")
    )


@registered(f"""WITH {SERIES_SQL}
SELECT key, t, round(y - lag(y) OVER w, 9) AS dy FROM series WINDOW w AS (PARTITION BY key ORDER BY t)""", text=["t"])
def difference_d1(spark, sf_dir):
    return series.difference(order_series(spark, sf_dir), 1).select("key", "t", F.round("dy", 9).alias("dy"))


@registered(f"""WITH {SERIES_SQL},
first AS (SELECT key, t, y - lag(y) OVER (PARTITION BY key ORDER BY t) AS dy FROM series)
SELECT key, t, round(dy - lag(dy) OVER (PARTITION BY key ORDER BY t), 9) AS dy FROM first""", text=["t"])
def difference_d2(spark, sf_dir):
    return series.difference(order_series(spark, sf_dir), 2).select("key", "t", F.round("dy", 9).alias("dy"))


@registered(f"""WITH {SERIES_SQL}
SELECT key, t, round(CASE WHEN count(y) OVER w = 7 THEN avg(y) OVER w END, 9) AS trend FROM series
WINDOW w AS (PARTITION BY key ORDER BY t ROWS BETWEEN 3 PRECEDING AND 3 FOLLOWING)""", text=["t"])
def moving_average(spark, sf_dir):
    out = series.moving_average(order_series(spark, sf_dir), 7)
    return out.select("key", "t", F.round("trend", 9).alias("trend"))


ACF_SQL = SERIES_SQL + """,
centred AS (SELECT key, pos, n, y - avg(y) OVER (PARTITION BY key) AS c FROM placed),
lags AS (SELECT unnest(range(0, 41)) AS lag),
acf AS (
  SELECT a.key, CAST(lag AS INTEGER) AS lag, sum(a.c * b.c) / any_value(v.total) AS acf, any_value(a.n) AS n
  FROM centred a CROSS JOIN lags JOIN centred b ON b.key = a.key AND b.pos = a.pos + lag
  JOIN (SELECT key, sum(c * c) AS total FROM centred GROUP BY key) v ON v.key = a.key GROUP BY a.key, lag
)"""


@registered(f"""WITH {ACF_SQL}
SELECT key, lag, round(acf, 6) AS acf,
       round(CASE WHEN lag = 0 THEN 0 ELSE 1.959963984540054e0 * sqrt((1 + 2 * coalesce(sum(CASE WHEN lag > 0 THEN acf * acf END)
         OVER (PARTITION BY key ORDER BY lag ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) / n) END, 6) AS bound
FROM acf""")
def acf(spark, sf_dir):
    return series.acf(order_series(spark, sf_dir)).withColumns({c: F.round(c, 6) for c in ("acf", "bound")})


@registered(f"""WITH RECURSIVE {ACF_SQL},
arrays AS (SELECT key, list(acf ORDER BY lag) AS r FROM acf GROUP BY key),
steps AS (
  SELECT key, r, 1 AS k, [r[2]] AS phi, r[2] AS alpha FROM arrays
  UNION ALL
  SELECT key, r, k + 1, list_append(list_transform(phi, lambda x, j: x - next * phi[k + 1 - j]), next), next
  FROM (SELECT *, (r[k + 2] - list_dot_product(phi, list_reverse(r[2:k + 1])))
               / (1 - list_dot_product(phi, r[2:k + 1])) AS next FROM steps WHERE k < 40) s
)
SELECT key, 0 AS lag, 1.0e0 AS pacf FROM arrays UNION ALL SELECT key, CAST(k AS INTEGER), round(alpha, 6) FROM steps""")
def pacf(spark, sf_dir):
    return series.pacf(order_series(spark, sf_dir)).withColumn("pacf", F.round("pacf", 6))


def _decompose_sql(period: int, digits: int = 7) -> str:
    half = period // 2
    if period % 2:
        trend = f"CASE WHEN count(y) OVER w = {period} THEN avg(y) OVER w END"
    else:
        trend = (
            f"CASE WHEN count(y) OVER w = {period + 1} THEN (sum(y) OVER w - 0.5e0 * first_value(y) OVER w "
            f"- 0.5e0 * last_value(y) OVER w) / {period} END"
        )
    return f"""WITH {SERIES_SQL},
tr AS (SELECT *, {trend} AS trend FROM placed WHERE n >= {2 * period}
       WINDOW w AS (PARTITION BY key ORDER BY t ROWS BETWEEN {half} PRECEDING AND {half} FOLLOWING)),
s0 AS (SELECT key, (pos - 1) % {period} AS phase, avg(y - trend) AS s FROM tr GROUP BY 1, 2),
s1 AS (SELECT key, phase, s - avg(s) OVER (PARTITION BY key) AS s FROM s0)
SELECT tr.key, t, round(y, {digits}) AS y, round(trend, {digits}) AS trend, round(s, {digits}) AS seasonal,
       round(y - trend - s, {digits}) AS resid FROM tr JOIN s1 ON s1.key = tr.key AND s1.phase = (tr.pos - 1) % {period}"""


def _decompose(spark, sf_dir, period, digits=7):
    out = series.decompose_additive(order_series(spark, sf_dir), period)
    return out.select("key", "t", *[F.round(c, digits).alias(c) for c in ("y", "trend", "seasonal", "resid")])


@registered(_decompose_sql(365), text=["t"])
def decompose_yearly(spark, sf_dir):
    return _decompose(spark, sf_dir, 365)


@registered(_decompose_sql(30), text=["t"])
def decompose_monthly(spark, sf_dir):
    """Even period: half weight at both ends of the trend window."""
    return _decompose(spark, sf_dir, 30)


@registered(f"""WITH {SERIES_SQL}
SELECT key, t, round(y, 9) AS y FROM series
QUALIFY t > max(t) OVER (PARTITION BY key) - INTERVAL 730 DAY""", text=["t"])
def trailing_730d(spark, sf_dir):
    return series.trailing(order_series(spark, sf_dir)).withColumn("y", F.round("y", 9))


@registered(f"""WITH {SERIES_SQL}
SELECT key, CAST(step AS INTEGER) AS step, CAST(last + CAST(step AS INTEGER) AS DATE) AS t
FROM (SELECT key, max(t) AS last FROM series GROUP BY key) l, (SELECT unnest(range(1, 366)) AS step) s""", text=["t"])
def date_sequence(spark, sf_dir):
    return series.future_dates(order_series(spark, sf_dir))


@registered(f"""WITH {SERIES_SQL}
SELECT key, t, round(y, 9) AS y, 'history' AS kind FROM series
QUALIFY t > max(t) OVER (PARTITION BY key) - INTERVAL 730 DAY
UNION ALL
SELECT key, CAST(last + CAST(step AS INTEGER) AS DATE), round(y, 9), 'forecast'
FROM (SELECT key, max(t) AS last, max_by(y, t) AS y FROM series GROUP BY key) l, (SELECT unnest(range(1, 31)) AS step) s""", text=["t"])
def history_plus_forecast(spark, sf_dir):
    """Two years of history, then the last value carried on for 30 days."""
    s = order_series(spark, sf_dir)
    last = s.groupBy("key").agg(F.max_by("y", "t").alias("y"))
    ahead = series.future_dates(s, 30).join(last, "key").select("key", "t", "y")
    return series.history_plus_forecast(series.trailing(s), ahead).withColumn("y", F.round("y", 9))


# --- evaluation with naive forecasts -----------------------------------------------------

NAIVE_SQL = SERIES_SQL + """,
pairs AS (SELECT key, pos, y, lag(y) OVER (PARTITION BY key ORDER BY t) AS yhat FROM placed)"""


def naive_pairs(spark, sf_dir, lag: int = 1):
    """Each day forecast by the value `lag` observations earlier, paired by position."""
    placed = series.with_positions(order_series(spark, sf_dir))
    forecast = placed.select("key", (F.col("pos") + lag).alias("pos"), F.col("y").alias("yhat"))
    return metrics.align(placed, forecast, ["key"])


@registered(f"""WITH {NAIVE_SQL}
SELECT key, count(*) AS n, round(avg((y - yhat) ** 2), 9) AS mse, round(sqrt(avg((y - yhat) ** 2)), 9) AS rmse,
       round(avg(abs(y - yhat)), 9) AS mae,
       round(1 - sum((y - yhat) ** 2) / (var_pop(y) * count(*)), 6) AS r2,
       round(avg(abs((y - yhat) / nullif(y, 0))) * 100, 6) AS mape
FROM pairs WHERE yhat IS NOT NULL GROUP BY key""")
def error_metrics(spark, sf_dir):
    out = metrics.forecast_metrics(naive_pairs(spark, sf_dir), ["key"])
    digits = {"mse": 9, "rmse": 9, "mae": 9, "r2": 6, "mape": 6}
    return out.withColumns({c: F.round(c, d) for c, d in digits.items()})


@registered(f"""WITH {NAIVE_SQL}
SELECT key, CAST(pos AS INTEGER) AS pos, round(y - yhat, 9) AS residual FROM pairs WHERE yhat IS NOT NULL""")
def residual_table(spark, sf_dir):
    out = metrics.residuals(naive_pairs(spark, sf_dir))
    return out.select("key", "pos", F.round("residual", 9).alias("residual"))


@registered(f"""WITH {NAIVE_SQL},
r AS (SELECT key, y - yhat AS residual FROM pairs WHERE yhat IS NOT NULL),
e AS (SELECT key, min(residual) AS lo, max(residual) AS hi FROM r GROUP BY key),
c AS (SELECT key, least(CAST(floor((residual - lo) / ((hi - lo) / 30)) AS INTEGER), 29) AS bin, count(*) AS n
      FROM r JOIN e USING (key) GROUP BY 1, 2),
b AS (SELECT key, CAST(bin AS INTEGER) AS bin, lo, (hi - lo) / 30 AS w FROM e, (SELECT unnest(range(0, 30)) AS bin) g)
SELECT b.key, b.bin, round(lo + w * b.bin, 9) AS left_edge, round(lo + w * (b.bin + 1), 9) AS right_edge, coalesce(n, 0) AS n
FROM b LEFT JOIN c ON c.key = b.key AND c.bin = b.bin""")
def residual_histogram(spark, sf_dir):
    r = metrics.residuals(naive_pairs(spark, sf_dir))
    out = profile.histogram(r, "residual", 30, ["key"])
    return out.withColumns({c: F.round(c, 9) for c in ("left_edge", "right_edge")})


@registered("""
WITH e AS (SELECT min(l_extendedprice) AS lo, max(l_extendedprice) AS hi FROM lineitem),
c AS (SELECT least(CAST(floor((l_extendedprice - lo) / ((hi - lo) / 30)) AS INTEGER), 29) AS bin, count(*) AS n
      FROM lineitem, e GROUP BY 1),
b AS (SELECT CAST(bin AS INTEGER) AS bin, lo, (hi - lo) / 30 AS w FROM e, (SELECT unnest(range(0, 30)) AS bin) g)
SELECT b.bin, round(lo + w * b.bin, 4) AS left_edge, round(lo + w * (b.bin + 1), 4) AS right_edge, coalesce(n, 0) AS n
FROM b LEFT JOIN c ON c.bin = b.bin""")
def price_histogram(spark, sf_dir):
    out = profile.histogram(table(spark, sf_dir, "lineitem"), "l_extendedprice", 30)
    return out.withColumns({c: F.round(c, 4) for c in ("left_edge", "right_edge")})


# Candidates: the value k observations earlier, k = 1..14, rated like a one-parameter model.
CANDIDATES_SQL = SERIES_SQL + """,
lagged AS (SELECT p.key, k, p.y, q.y AS yhat FROM placed p, (SELECT unnest(range(1, 15)) AS k) ks, placed q
           WHERE q.key = p.key AND q.pos = p.pos - k),
candidates AS (SELECT key, CAST(k AS INTEGER) AS k, count(*) * ln(avg((y - yhat) ** 2)) + 4 AS aic FROM lagged GROUP BY 1, 2)"""


def lag_candidates(spark, sf_dir):
    placed = series.with_positions(order_series(spark, sf_dir))
    w = Window.partitionBy("key").orderBy("t")
    wide = placed.select("key", *[(F.col("y") - F.lag("y", k).over(w)).alias(f"e{k}") for k in range(1, 15)])
    scored = wide.groupBy("key").agg(
        F.array(
            *[
                F.struct(
                    F.lit(k).alias("k"),
                    (F.count(f"e{k}") * F.log(F.avg(F.col(f"e{k}") * F.col(f"e{k}"))) + 4).alias("aic"),
                )
                for k in range(1, 15)
            ]
        ).alias("c")
    )
    return scored.select("key", F.inline("c"))


@registered(f"WITH {CANDIDATES_SQL} SELECT key, min_by(k, aic) AS k, round(min(aic), 6) AS aic FROM candidates GROUP BY key")
def best_candidate(spark, sf_dir):
    found = metrics.best_candidate(lag_candidates(spark, sf_dir), ["key"], ["k"], grid="k")
    return found.withColumn("aic", F.round("aic", 6))


@registered(f"""WITH {CANDIDATES_SQL}
SELECT key, k, round(aic, 6) AS aic, CAST(row_number() OVER (PARTITION BY key ORDER BY aic, k) AS INTEGER) AS rank
FROM candidates QUALIFY rank <= 10""")
def top10_candidates(spark, sf_dir):
    out = ordering.top_k(lag_candidates(spark, sf_dir), "aic", 10, ["key"], ["k"])
    return out.withColumn("aic", F.round("aic", 6))


@registered(f"WITH {CANDIDATES_SQL} SELECT key, k, round(aic, 6) AS aic FROM candidates ORDER BY candidates.aic, key LIMIT 10")
def global_top10(spark, sf_dir):
    out = ordering.top_k(lag_candidates(spark, sf_dir), "aic", 10, tiebreak=["key", "k"])
    return out.withColumn("aic", F.round("aic", 6))


@registered(f"""WITH {WIND_SQL}
SELECT CodigoNacional AS key, CAST(time AS DATE) AS t, min_by(ff_valor, event_id) AS y
FROM wind_obs WHERE ff_valor IS NOT NULL GROUP BY 1, 2""", text=["t"])
def station_series(spark, sf_dir):
    obs = wind_obs(spark, sf_dir).where("ff_valor IS NOT NULL")
    return series.prepare_series(obs, "CodigoNacional", "time", "ff_valor", "event_id")
