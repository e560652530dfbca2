"""Semantic layer, JSON observations and scores, alerts."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from veleta.functions import shred
from veleta.operators.rollup import month_rollup
from veleta.operators.semantic import Measure, Relationship, SemanticModel, cross_filter, relate
from veleta.operators.shaping import in_local_day
from veleta.plans.medallion import wind_fact
from veleta.plans.running_score import FIELDS, running_score
from veleta.streaming.alerts import AlertRule, alerts
from workload.adapters import (
    FACT_SQL, SCORED_SQL, STATION_SQL, WEATHER_SQL, stations, table, weather_obs, wind_obs,
)
from workload.registry import registered

# Monthly means stay unrounded here; sums over them are rounded at the end.
MONTHLY_SQL = FACT_SQL + ",\n" + STATION_SQL + """,
monthly AS (
  SELECT year(time) AS anno, month(time) AS mes, CodigoNacional, max(dd_valor) AS Dir_racha1,
         max(dd_valor) AS Dir_racha2, avg(ff_valor) AS vv_viento_promedio
  FROM wind_fact GROUP BY 1, 2, 3
)"""


def wind_model(spark, sf_dir) -> SemanticModel:
    return SemanticModel(
        fact=month_rollup(wind_fact(wind_obs(spark, sf_dir)), digits=None),
        dims={"dim_estaciones": stations(spark, sf_dir)},
        relationships=[Relationship("CodigoNacional", "dim_estaciones", "CodigoNacional")],
        measures={
            "VelocidadViento": Measure("sum", "vv_viento_promedio"),
            "VelocidadMedia": Measure("avg", "vv_viento_promedio"),
        },
        summarize_by={
            "anno": "sum", "mes": "sum", "Dir_racha1": "sum", "Dir_racha2": "sum",
            "vv_viento_promedio": "sum", "CodigoNacional": "none",
        },
    )


@registered(f"""WITH {MONTHLY_SQL}
SELECT CAST(anno AS INTEGER) AS anno, CAST(mes AS INTEGER) AS mes, round(sum(vv_viento_promedio), 9) AS VelocidadViento
FROM monthly GROUP BY 1, 2 ORDER BY 1, 2""")
def measure_by_month(spark, sf_dir):
    out = wind_model(spark, sf_dir).query(["anno", "mes"], ["VelocidadViento"], order=["anno", "mes"])
    return out.withColumn("VelocidadViento", F.round("VelocidadViento", 9))


@registered(f"""WITH {MONTHLY_SQL}
SELECT nombreEstacion, CAST(mes AS INTEGER) AS mes, round(sum(vv_viento_promedio), 9) AS VelocidadViento,
       round(avg(vv_viento_promedio), 9) AS VelocidadMedia
FROM monthly LEFT JOIN stations USING (CodigoNacional) GROUP BY 1, 2""")
def measure_by_station_name(spark, sf_dir):
    out = wind_model(spark, sf_dir).query(
        ["dim_estaciones.nombreEstacion", "mes"], ["VelocidadViento", "VelocidadMedia"]
    )
    return out.withColumns({c: F.round(c, 9) for c in ("VelocidadViento", "VelocidadMedia")})


@registered(f"""WITH {FACT_SQL}, {STATION_SQL}
SELECT nombreEstacion, count(ff_valor) AS readings, min(ff_valor) AS least, max(ff_valor) AS greatest,
       round(avg(ff_valor), 9) AS mean, round(sum(ff_valor * dd_valor) / sum(CASE WHEN ff_valor IS NOT NULL THEN dd_valor END), 6) AS by_direction
FROM wind_fact LEFT JOIN stations USING (CodigoNacional) GROUP BY 1""")
def measures_over_raw_facts(spark, sf_dir):
    """All measure kinds over the unaggregated fact, by a dimension column."""
    model = SemanticModel(
        fact=wind_fact(wind_obs(spark, sf_dir)),
        dims={"st": stations(spark, sf_dir)},
        relationships=[Relationship("CodigoNacional", "st", "CodigoNacional")],
        measures={
            "readings": Measure("count", "ff_valor"),
            "least": Measure("min", "ff_valor"),
            "greatest": Measure("max", "ff_valor"),
            "mean": Measure("avg", "ff_valor"),
            "by_direction": Measure("weighted_avg", "ff_valor", "dd_valor"),
        },
    )
    out = model.query(["st.nombreEstacion"], list(model.measures))
    return out.withColumns({"mean": F.round("mean", 9), "by_direction": F.round("by_direction", 6)})


@registered(f"""WITH {FACT_SQL}, {STATION_SQL}
SELECT time, ff_valor, CodigoNacional, latitud, longitud, nombreEstacion
FROM wind_fact LEFT JOIN stations USING (CodigoNacional)""")
def fact_dim_join(spark, sf_dir):
    fact = wind_fact(wind_obs(spark, sf_dir)).select("time", "ff_valor", "CodigoNacional")
    return relate(fact, stations(spark, sf_dir), "CodigoNacional", "CodigoNacional")


@registered(f"""WITH {FACT_SQL}, {STATION_SQL}
SELECT * FROM wind_fact WHERE CodigoNacional IN (SELECT CodigoNacional FROM stations WHERE nombreEstacion = 'EST-17')""")
def cross_filtered_facts(spark, sf_dir):
    fact = wind_fact(wind_obs(spark, sf_dir))
    chosen = F.col("nombreEstacion") == "EST-17"
    return cross_filter(fact, stations(spark, sf_dir), "CodigoNacional", "CodigoNacional", chosen)


@registered(f"""WITH {MONTHLY_SQL}
SELECT CAST(anno AS INTEGER) AS anno, CAST(mes AS INTEGER) AS mes, round(sum(vv_viento_promedio), 9) AS VelocidadViento
FROM monthly WHERE CodigoNacional IN (SELECT CodigoNacional FROM stations WHERE nombreEstacion = 'EST-21') GROUP BY 1, 2""")
def cross_filtered_measure(spark, sf_dir):
    out = wind_model(spark, sf_dir).query(
        ["anno", "mes"], ["VelocidadViento"], selections={"dim_estaciones": F.col("nombreEstacion") == "EST-21"}
    )
    return out.withColumn("VelocidadViento", F.round("VelocidadViento", 9))


@registered(f"""WITH {MONTHLY_SQL}
SELECT CodigoNacional, sum(anno) :: BIGINT AS anno, sum(mes) :: BIGINT AS mes, sum(Dir_racha1) AS Dir_racha1,
       sum(Dir_racha2) AS Dir_racha2, round(sum(vv_viento_promedio), 9) AS vv_viento_promedio FROM monthly GROUP BY 1""")
def default_summary(spark, sf_dir):
    out = wind_model(spark, sf_dir).default_summary(["CodigoNacional"])
    return out.withColumn("vv_viento_promedio", F.round("vv_viento_promedio", 9))


_SCORED = SCORED_SQL.format(where="")
_TODAY = SCORED_SQL.format(where="WHERE fecha_hora >= TIMESTAMP '2024-01-14' AND fecha_hora < TIMESTAMP '2024-01-15'")
AS_OF = dt.datetime(2024, 1, 15, 2, 30)


@registered(f"""WITH {_SCORED}
SELECT fecha_hora, round(sum(temperatura), 6) AS temperatura, CAST(sum(score_temperatura) AS BIGINT) AS score_temperatura,
       CAST(sum(score_lluvia) AS BIGINT) AS score_lluvia, round(sum(lluvia_ultima_hora), 6) AS lluvia_ultima_hora
FROM labelled GROUP BY 1 ORDER BY 1""")
def implicit_sum(spark, sf_dir):
    """Dashboard visuals: default sums of the scored rows per time."""
    scored = running_score(weather_obs(spark, sf_dir), all_days=True, ordered=False)
    cols = ["temperatura", "score_temperatura", "score_lluvia", "lluvia_ultima_hora"]
    model = SemanticModel(fact=scored, summarize_by=dict.fromkeys(cols, "sum"))
    out = model.query(["fecha_hora"], cols, order=["fecha_hora"])
    return out.withColumns({c: F.round(c, 6) for c in ("temperatura", "lluvia_ultima_hora")})


_TYPED = ", ".join(f"round({c}, 6) AS {c}" if kind == "double" else c for c, (_, _, kind) in FIELDS.items())


def _rounded(df):
    return df.withColumns({c: F.round(c, 6) for c, (_, _, kind) in FIELDS.items() if kind == "double"})


@registered(f"WITH {WEATHER_SQL} SELECT _ingested, {_TYPED} FROM deliveries")
def json_shred(spark, sf_dir):
    return _rounded(shred(weather_obs(spark, sf_dir), FIELDS)).select("_ingested", *FIELDS)


_RESULT = f"""fecha_hora, {_TYPED}, score_temperatura, score_viento, score_humedad, score_lluvia, score_uv,
       score_total, condicion_running"""


@registered(f"WITH {_SCORED} SELECT {_RESULT} FROM labelled")
def running_score_all_days(spark, sf_dir):
    return _rounded(running_score(weather_obs(spark, sf_dir), all_days=True))


@registered(f"WITH {_TODAY} SELECT {_RESULT} FROM labelled ORDER BY fecha_hora")
def running_score_today(spark, sf_dir):
    return _rounded(running_score(weather_obs(spark, sf_dir), AS_OF))


@registered("SELECT event_id, ts FROM events WHERE ts >= TIMESTAMP '2024-01-14' AND ts < TIMESTAMP '2024-01-15'")
def today_filter(spark, sf_dir):
    return in_local_day(table(spark, sf_dir, "events"), "ts", AS_OF).select("event_id", "ts")


@registered(f"""WITH {_SCORED}
SELECT condicion_running, count(*) AS n, min(score_total) AS least, max(score_total) AS greatest FROM labelled GROUP BY 1""")
def score_labels(spark, sf_dir):
    scored = running_score(weather_obs(spark, sf_dir), all_days=True, ordered=False)
    return scored.groupBy("condicion_running").agg(
        F.count("*").alias("n"), F.min("score_total").alias("least"), F.max("score_total").alias("greatest")
    )


# --- alerts ------------------------------------------------------------------------------

ALERT_SQL = """
SELECT event_id, 'Alerta de eventos' AS subject, 'La condición se ha cumplido.' AS headline,
       'guardia@example.org;turno@example.org' AS sent_to, 'jefe@example.org' AS copy_to, '' AS blind_copy_to,
       '' AS message, 'user: ' || CAST(user_id AS VARCHAR) AS extra, 'en-us' AS locale
FROM events"""


def _alerts(events, rule):
    """Alerts with their lists as text."""
    lists = ("sent_to", "copy_to", "blind_copy_to", "extra")
    return alerts(events, rule, keep=["event_id"]).withColumns({c: F.array_join(c, ";") for c in lists})


def _rule(**changes) -> AlertRule:
    base = {
        "subject": "Alerta de eventos",
        "headline": "La condición se ha cumplido.",
        "sent_to": ["guardia@example.org", "turno@example.org"],
        "copy_to": ["jefe@example.org"],
        "extra": {"user": F.col("user_id")},
        "enabled": True,
    }
    return AlertRule(**{**base, **changes})


@registered(ALERT_SQL)
def alert_rows(spark, sf_dir):
    return _alerts(table(spark, sf_dir, "events"), _rule())


@registered(ALERT_SQL + " WHERE value > 100 AND event_type = 'error'")
def alert_rows_on_condition(spark, sf_dir):
    rule = _rule(condition=(F.col("value") > 100) & (F.col("event_type") == "error"))
    return _alerts(table(spark, sf_dir, "events"), rule)


@registered(ALERT_SQL + " WHERE false")
def alert_rule_disabled(spark, sf_dir):
    return _alerts(table(spark, sf_dir, "events"), _rule(enabled=False))
