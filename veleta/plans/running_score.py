"""Weather observations to typed, scored rows for runners (SCR1-7, FLT2, SRC9)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from veleta.functions.casts import parse_time
from veleta.functions.json_paths import shred
from veleta.operators.dedup import latest_per_key
from veleta.operators.scoring import Rule, band_rules, label_by_threshold, rule_score
from veleta.operators.shaping import in_local_day, project_as

# Output column, source column, path and type of each observed value.
FIELDS = {
    "temperatura": ("temperature", "$.value", "double"),
    "sensacion_termica": ("apparentTemperature", "$.value", "double"),
    "temp_bulbo_humedo": ("wetBulbTemperature", "$.value", "double"),
    "viento_velocidad": ("wind", "$.speed.value", "double"),
    "viento_direccion": ("wind", "$.direction.description", "string"),
    "viento_grados": ("wind", "$.direction.degrees", "int"),
    "rafaga_velocidad": ("windGust", "$.speed.value", "double"),
    "humedad_relativa": ("relativeHumidity", "$", "int"),
    "punto_rocio": ("dewPoint", "$.value", "double"),
    "visibilidad_km": ("visibility", "$.value", "double"),
    "nubosidad_pct": ("cloudCover", "$", "int"),
    "descripcion_cielo": ("description", "$", "string"),
    "es_de_dia": ("daytime", "$", "boolean"),
    "uv_index": ("uvIndex", "$", "int"),
    "uv_descripcion": ("uvIndexDescription", "$", "string"),
    "lluvia_ultima_hora": ("precipitationSummary", "$.pastHour.value", "double"),
    "lluvia_6h": ("precipitationSummary", "$.past6Hours.value", "double"),
    "hay_precipitacion": ("hasPrecipitation", "$", "boolean"),
}

# Upper limit of each band and its points.
TEMPERATURE_FLOOR, TEMPERATURE_BANDS = 10, [(18, 30), (24, 20), (28, 10)]
WIND_BANDS = [(15, 25), (25, 15), (35, 5)]
HUMIDITY_FLOOR, HUMIDITY_BANDS = 40, [(60, 20), (75, 12), (float("inf"), 5)]
RAIN_DRY_POINTS, RAIN_BANDS = 15, [(1, 8)]
UV_BANDS = [(2, 10), (5, 8), (7, 4)]
HUMIDITY_OTHERWISE = 15
LABELS = [
    (80, "🟢 Condiciones ideales"),
    (60, "🟡 Condiciones aceptables"),
    (40, "🟠 Condiciones difíciles"),
]
LABEL_OTHERWISE = "🔴 No recomendado"

# Column order of the result.
RESULT_COLUMNS = [
    "fecha_hora", "es_de_dia", "descripcion_cielo", "temperatura", "sensacion_termica",
    "temp_bulbo_humedo", "viento_velocidad", "viento_direccion", "viento_grados",
    "rafaga_velocidad", "humedad_relativa", "punto_rocio", "visibilidad_km", "nubosidad_pct",
    "uv_index", "uv_descripcion", "hay_precipitacion", "lluvia_ultima_hora", "lluvia_6h",
    "score_temperatura", "score_viento", "score_humedad", "score_lluvia", "score_uv",
    "score_total", "condicion_running",
]


def running_rules() -> dict[str, list[Rule]]:
    return {
        "score_temperatura": band_rules(F.col("temperatura"), TEMPERATURE_BANDS, TEMPERATURE_FLOOR),
        "score_viento": band_rules(F.col("viento_velocidad"), WIND_BANDS),
        "score_humedad": band_rules(F.col("humedad_relativa"), HUMIDITY_BANDS, HUMIDITY_FLOOR),
        "score_lluvia": [(~F.col("hay_precipitacion"), RAIN_DRY_POINTS)]
        + band_rules(F.col("lluvia_ultima_hora"), RAIN_BANDS),
        "score_uv": band_rules(F.col("uv_index"), UV_BANDS),
    }


def score_conditions(typed: DataFrame) -> DataFrame:
    """Append the five scores, their sum and its label to typed observations."""
    scored = rule_score(typed, running_rules(), {"score_humedad": HUMIDITY_OTHERWISE}, "score_total")
    return label_by_threshold(scored, "score_total", LABELS, LABEL_OTHERWISE, "condicion_running")


def running_score(
    obs: DataFrame,
    as_of: dt.datetime | None = None,
    offset_hours: int = 3,
    ingested: str = "_ingested",
    all_days: bool = False,
    ordered: bool = True,
) -> DataFrame:
    """Observations with JSON text to one scored row per time (SCR7).

    Rows of the local day of `as_of` are kept, then the latest delivery per time; JSON is
    parsed only for the survivors. `all_days` keeps every day.
    """
    timed = obs.withColumn("dt", parse_time(F.col("dateTime")))
    today = timed if all_days else in_local_day(timed, "dt", as_of, offset_hours)
    # Equal delivery times are told apart by content, as far as its types have an order.
    payload = [
        f.name
        for f in obs.schema
        if f.name != ingested and isinstance(f.dataType, T.AtomicType) and not isinstance(f.dataType, T.VariantType)
    ]
    latest = latest_per_key(today, ["dt"], ingested, payload)
    scored = score_conditions(shred(latest, FIELDS))
    result = project_as(scored, {c: "dt" if c == "fecha_hora" else c for c in RESULT_COLUMNS})
    return result.orderBy("fecha_hora") if ordered else result
