import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from conftest import plan_of, rows
from veleta.operators.scoring import label_by_threshold, rule_score
from veleta.plans.running_score import (
    LABEL_OTHERWISE, LABELS, RESULT_COLUMNS, running_rules, running_score, score_conditions,
)

TYPED = (
    "temperatura double, viento_velocidad double, humedad_relativa int, hay_precipitacion boolean, "
    "lluvia_ultima_hora double, uv_index int"
)
BLANK = {"temperatura": None, "viento_velocidad": None, "humedad_relativa": None,
         "hay_precipitacion": None, "lluvia_ultima_hora": None, "uv_index": None}

BOUNDS = {
    ("temperatura", "score_temperatura"): [
        (9.9, 0), (10.0, 30), (18.0, 30), (18.1, 20), (24.0, 20), (24.1, 10), (28.0, 10), (28.1, 0), (None, 0)],
    ("viento_velocidad", "score_viento"): [
        (0.0, 25), (15.0, 25), (15.1, 15), (25.0, 15), (25.1, 5), (35.0, 5), (35.1, 0), (None, 0)],
    ("humedad_relativa", "score_humedad"): [
        (39, 15), (40, 20), (60, 20), (61, 12), (75, 12), (76, 5), (100, 5), (None, 15)],
    ("uv_index", "score_uv"): [(0, 10), (2, 10), (3, 8), (5, 8), (6, 4), (7, 4), (8, 0), (None, 0)],
}


@pytest.mark.parametrize("columns", list(BOUNDS))
def test_score_bounds(spark, columns):
    source, score = columns
    cases = BOUNDS[columns]
    df = spark.createDataFrame([tuple({**BLANK, source: v}.values()) for v, _ in cases], TYPED)
    got = [r[0] for r in score_conditions(df).select(score).collect()]
    assert got == [points for _, points in cases]


def test_rain_score(spark):
    cases = [(False, 5.0, 15), (False, None, 15), (True, 1.0, 8), (True, 1.1, 0), (None, 0.5, 8), (True, None, 0), (None, None, 0)]
    df = spark.createDataFrame([(None, None, None, f, r, None) for f, r, _ in cases], TYPED)
    assert [r[0] for r in score_conditions(df).select("score_lluvia").collect()] == [p for *_, p in cases]


def test_labels_and_total(spark):
    totals = [100, 80, 79, 60, 59, 40, 39, 0]
    df = spark.createDataFrame([(t,) for t in totals], "score_total int")
    out = label_by_threshold(df, "score_total", LABELS, LABEL_OTHERWISE, "label")
    marks = [r["label"][0] for r in out.collect()]
    assert marks == ["🟢", "🟢", "🟡", "🟡", "🟠", "🟠", "🔴", "🔴"]
    best = spark.createDataFrame([(15.0, 10.0, 50, False, 0.0, 1)], TYPED)
    assert score_conditions(best).first()["score_total"] == 100


def test_rule_score_takes_the_first_match(spark):
    df = spark.createDataFrame([(5,)], "x int")
    rules = {"a": [(F.col("x") > 1, 3), (F.col("x") > 4, 9)], "b": [(F.col("x") > 9, 1)]}
    assert rows(rule_score(df, rules, {"b": 7}, "t")) == [(5, 3, 7, 10)]
    assert set(running_rules()) == {c for c in RESULT_COLUMNS if c.startswith("score_") and c != "score_total"}


def delivery(when, ingested, **changes):
    row = {
        "dateTime": when, "_ingested": ingested, "temperature": json.dumps({"value": 15}),
        "apparentTemperature": json.dumps({"value": 14.5}), "wetBulbTemperature": "{}",
        "wind": json.dumps({"speed": {"value": 12.0}, "direction": {"description": "SW", "degrees": 225}}),
        "windGust": json.dumps({"speed": {"value": 20}}), "relativeHumidity": "55", "dewPoint": "broken {",
        "visibility": json.dumps({"value": 10}), "cloudCover": "30", "description": "clear", "daytime": "true",
        "uvIndex": "2", "uvIndexDescription": "low",
        "precipitationSummary": json.dumps({"pastHour": {"value": 0}, "past6Hours": {"value": 0.5}}),
        "hasPrecipitation": "false",
    }
    return {**row, **changes}


COLUMNS = list(delivery("", None))
SCHEMA = ", ".join(f"{c} {'timestamp' if c == '_ingested' else 'string'}" for c in COLUMNS)


def observations(spark, deliveries):
    return spark.createDataFrame([tuple(d[c] for c in COLUMNS) for d in deliveries], SCHEMA)


def test_running_score_end_to_end(spark):
    t0 = dt.datetime(2024, 5, 1, 12)
    obs = observations(spark, [
        delivery("2024-05-01T10:00:00", t0, temperature=json.dumps({"value": 30})),
        delivery("2024-05-01T10:00:00", t0 + dt.timedelta(minutes=5)),
        delivery("2024-05-01T10:00:00", None, temperature=json.dumps({"value": -5})),
        delivery("2024-05-01T09:00:00Z", t0, hasPrecipitation="true", uvIndex="x"),
        delivery("2024-05-02T00:30:00", t0),
        delivery("2024-04-30T23:59:59", t0),
        delivery("garbage", t0),
    ])
    out = running_score(obs, dt.datetime(2024, 5, 2, 2, 59))
    assert out.columns == RESULT_COLUMNS
    got = [r.asDict() for r in out.collect()]
    assert [r["fecha_hora"].hour for r in got] == [9, 10]
    late = got[1]
    assert (late["temperatura"], late["viento_grados"], late["punto_rocio"]) == (15.0, 225, None)
    assert (late["score_total"], late["condicion_running"][0]) == (100, "🟢")
    assert got[0]["uv_index"] is None and got[0]["score_total"] == 30 + 25 + 20 + 8 + 0
    types = dict(out.dtypes)
    assert (types["fecha_hora"], types["es_de_dia"], types["uv_index"], types["lluvia_6h"]) == (
        "timestamp", "boolean", "int", "double")


def test_json_is_parsed_after_the_latest_delivery_is_chosen(spark):
    plan = plan_of(running_score(observations(spark, [delivery("2024-05-01T10:00:00", None)]), all_days=True))
    assert plan.index("from_json") < plan.index("WindowGroupLimit")


def test_variant_columns_score_like_text(spark):
    text = observations(spark, [delivery("2024-05-01T10:00:00", dt.datetime(2024, 5, 1, 12))])
    docs = ["temperature", "wind", "windGust", "precipitationSummary"]
    variant = text.withColumns({c: F.parse_json(c) for c in docs})
    assert rows(running_score(variant, all_days=True)) == rows(running_score(text, all_days=True))
