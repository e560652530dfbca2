"""Given tables seen as the inputs the operators expect, in Spark and as SQL CTEs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from veleta.operators.series import daily_mean_series


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _k():
    return F.get_json_object("props", "$.k").cast("int")


def wind_obs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as wind observations of 150 or more stations, with gaps in every measure."""
    moved = (F.col("user_id") % 40 == 0) & (F.col("event_type") == "click")
    return (
        table(spark, sf_dir, "events")
        .withColumn("k", _k())
        .select(
            "event_id",
            F.col("ts").alias("time"),
            F.when(F.col("event_id") % 13 != 0, (F.col("k") * 37 % 360).cast("double")).alias("dd_valor"),
            F.when(F.col("event_id") % 11 != 0, F.col("value")).alias("ff_valor"),
            F.when(F.col("event_type") == "error", F.col("k").cast("double")).alias("VRB_Valor"),
            F.col("user_id").cast("double").alias("CodigoNacional"),
            (F.col("user_id") % 50 - 60 + F.when(moved, 0.5).otherwise(0.0)).cast("double").alias("latitud"),
            (F.col("user_id") % 7 - 75).cast("double").alias("longitud"),
            F.concat(F.lit("EST-"), (F.col("user_id") % 60).cast("string")).alias("nombreEstacion"),
        )
    )


WIND_SQL = """
wind_obs AS (
  SELECT event_id, ts AS time,
         CASE WHEN event_id % 13 <> 0 THEN CAST(k * 37 % 360 AS DOUBLE) END AS dd_valor,
         CASE WHEN event_id % 11 <> 0 THEN value END AS ff_valor,
         CASE WHEN event_type = 'error' THEN CAST(k AS DOUBLE) END AS VRB_Valor,
         CAST(user_id AS DOUBLE) AS CodigoNacional,
         CAST(user_id % 50 - 60 + CASE WHEN user_id % 40 = 0 AND event_type = 'click' THEN 0.5 ELSE 0.0 END AS DOUBLE) AS latitud,
         CAST(user_id % 7 - 75 AS DOUBLE) AS longitud,
         'EST-' || CAST(user_id % 60 AS VARCHAR) AS nombreEstacion
  FROM (SELECT *, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events) e
)"""

FACT_SQL = WIND_SQL + """,
wind_fact AS (
  SELECT time, dd_valor, ff_valor, VRB_Valor, CodigoNacional FROM wind_obs
  WHERE dd_valor IS NOT NULL OR ff_valor IS NOT NULL OR VRB_Valor IS NOT NULL
)"""

# One row per station: the dimension of the semantic layer.
STATION_SQL = """
stations AS (
  SELECT DISTINCT CAST(user_id AS DOUBLE) AS CodigoNacional,
         CAST(user_id % 50 - 60 AS DOUBLE) AS latitud, CAST(user_id % 7 - 75 AS DOUBLE) AS longitud,
         'EST-' || CAST(user_id % 60 AS VARCHAR) AS nombreEstacion
  FROM events WHERE user_id <> 3
)"""


def stations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per station; station 3 is absent, so that some facts have no dimension row."""
    return (
        table(spark, sf_dir, "events")
        .where("user_id <> 3")
        .select(
            F.col("user_id").cast("double").alias("CodigoNacional"),
            (F.col("user_id") % 50 - 60).cast("double").alias("latitud"),
            (F.col("user_id") % 7 - 75).cast("double").alias("longitud"),
            F.concat(F.lit("EST-"), (F.col("user_id") % 60).cast("string")).alias("nombreEstacion"),
        )
        .distinct()
    )


def weather_obs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as deliveries of hourly weather observations with JSON-text columns.

    Several deliveries share an hour; some hold malformed or incomplete JSON.
    """
    value = lambda c: F.to_json(F.struct(c.alias("value")))
    k, i = F.col("k"), F.col("event_id")
    wind = F.to_json(
        F.struct(
            F.struct((k * 0.5).alias("value")).alias("speed"),
            F.struct(F.col("event_type").alias("description"), (k * 3.5).alias("degrees")).alias("direction"),
        )
    )
    return (
        table(spark, sf_dir, "events")
        .withColumn("k", _k())
        .select(
            i.alias("_ingested"),
            F.date_format(F.date_trunc("hour", "ts"), "yyyy-MM-dd'T'HH:mm:ss").alias("dateTime"),
            F.when(i % 17 == 0, F.lit('{"value": ')).otherwise(value(k * 0.4 - 2)).alias("temperature"),
            value(k * 0.4 - 3).alias("apparentTemperature"),
            F.when(i % 19 == 0, F.lit("{}")).otherwise(value(k * 0.25)).alias("wetBulbTemperature"),
            F.when(i % 23 != 0, wind).alias("wind"),
            F.to_json(F.struct(F.struct((k * 0.75).alias("value")).alias("speed"))).alias("windGust"),
            F.when(i % 29 != 0, (i * 7 % 101).cast("string")).alias("relativeHumidity"),
            value(k * 0.125).alias("dewPoint"),
            value(k * 0.5 + 1).alias("visibility"),
            F.concat((i * 3 % 101).cast("string"), F.lit(".5")).alias("cloudCover"),
            F.col("event_type").alias("description"),
            (i % 2 == 0).cast("string").alias("daytime"),
            (i * 3 % 11).cast("string").alias("uvIndex"),
            F.concat(F.lit("uv-"), (i * 3 % 11).cast("string")).alias("uvIndexDescription"),
            F.to_json(
                F.struct(
                    F.struct((k % 5 * 0.5).alias("value")).alias("pastHour"),
                    F.struct((k % 7 * 0.5).alias("value")).alias("past6Hours"),
                )
            ).alias("precipitationSummary"),
            F.when(i % 31 != 0, (i % 3 == 0).cast("string")).alias("hasPrecipitation"),
        )
    )


# The same deliveries as typed values, without any JSON.
WEATHER_SQL = """
deliveries AS (
  SELECT event_id AS _ingested, date_trunc('hour', ts) AS fecha_hora,
         CASE WHEN event_id % 17 <> 0 THEN k * 0.4e0 - 2 END AS temperatura,
         k * 0.4e0 - 3 AS sensacion_termica,
         CASE WHEN event_id % 19 <> 0 THEN k * 0.25e0 END AS temp_bulbo_humedo,
         CASE WHEN event_id % 23 <> 0 THEN k * 0.5e0 END AS viento_velocidad,
         CASE WHEN event_id % 23 <> 0 THEN event_type END AS viento_direccion,
         CASE WHEN event_id % 23 <> 0 THEN CAST(floor(k * 3.5e0) AS INTEGER) END AS viento_grados,
         k * 0.75e0 AS rafaga_velocidad,
         CASE WHEN event_id % 29 <> 0 THEN CAST(event_id * 7 % 101 AS INTEGER) END AS humedad_relativa,
         k * 0.125e0 AS punto_rocio, k * 0.5e0 + 1 AS visibilidad_km,
         CAST(event_id * 3 % 101 AS INTEGER) AS nubosidad_pct,
         event_type AS descripcion_cielo, event_id % 2 = 0 AS es_de_dia,
         CAST(event_id * 3 % 11 AS INTEGER) AS uv_index,
         'uv-' || CAST(event_id * 3 % 11 AS VARCHAR) AS uv_descripcion,
         k % 5 * 0.5e0 AS lluvia_ultima_hora, k % 7 * 0.5e0 AS lluvia_6h,
         CASE WHEN event_id % 31 <> 0 THEN event_id % 3 = 0 END AS hay_precipitacion
  FROM (SELECT *, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events) e
)"""

SCORES_SQL = """
  CASE WHEN temperatura >= 10 AND temperatura <= 18 THEN 30 WHEN temperatura > 18 AND temperatura <= 24 THEN 20
       WHEN temperatura > 24 AND temperatura <= 28 THEN 10 ELSE 0 END AS score_temperatura,
  CASE WHEN viento_velocidad <= 15 THEN 25 WHEN viento_velocidad <= 25 THEN 15
       WHEN viento_velocidad <= 35 THEN 5 ELSE 0 END AS score_viento,
  CASE WHEN humedad_relativa >= 40 AND humedad_relativa <= 60 THEN 20
       WHEN humedad_relativa > 60 AND humedad_relativa <= 75 THEN 12
       WHEN humedad_relativa > 75 THEN 5 ELSE 15 END AS score_humedad,
  CASE WHEN hay_precipitacion = false THEN 15 WHEN lluvia_ultima_hora <= 1 THEN 8 ELSE 0 END AS score_lluvia,
  CASE WHEN uv_index <= 2 THEN 10 WHEN uv_index <= 5 THEN 8 WHEN uv_index <= 7 THEN 4 ELSE 0 END AS score_uv"""

SCORED_SQL = WEATHER_SQL + """,
latest AS (SELECT * FROM deliveries {where}
           QUALIFY row_number() OVER (PARTITION BY fecha_hora ORDER BY _ingested DESC) = 1),
scored AS (SELECT *, """ + SCORES_SQL + """ FROM latest),
totals AS (SELECT *, score_temperatura + score_viento + score_humedad + score_lluvia + score_uv AS score_total FROM scored),
labelled AS (SELECT * EXCLUDE (_ingested),
  CASE WHEN score_total >= 80 THEN '🟢 Condiciones ideales' WHEN score_total >= 60 THEN '🟡 Condiciones aceptables'
       WHEN score_total >= 40 THEN '🟠 Condiciones difíciles' ELSE '🔴 No recomendado' END AS condicion_running
  FROM totals)"""


def order_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Logarithm of the mean order value per day for each of the five priorities.

    Means of whole cents fall on halves of the last digit when rounded; their logarithms do not.
    """
    daily = daily_mean_series(table(spark, sf_dir, "orders"), "o_orderpriority", "o_orderdate", "o_totalprice")
    return daily.withColumn("y", F.log("y"))


SERIES_SQL = """
series AS (
  SELECT o_orderpriority AS key, CAST(o_orderdate AS DATE) AS t, ln(avg(o_totalprice)) AS y
  FROM orders GROUP BY 1, 2
),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY key ORDER BY t) AS pos, count(*) OVER (PARTITION BY key) AS n FROM series
)"""
