import datetime as dt

import pytest
from pyspark.sql import functions as F

from conftest import rows
from veleta.functions import (
    catalog_name, clean_identifier, flat_name, parse_time, shred, to_bool, to_double, to_int, to_long,
)


def one(spark, value, fn, kind="string"):
    return spark.createDataFrame([(value,)], f"v {kind}").select(fn(F.col("v"))).first()[0]


@pytest.mark.parametrize(
    "text,fn,want",
    [
        ("45.7", to_int, 45), ("-3", to_int, -3), ("x", to_int, None), (None, to_int, None),
        ("1e2", to_double, 100.0), ("", to_double, None), ("12", to_long, 12), ("12.9", to_long, 12),
        ("true", to_bool, True), ("FALSE", to_bool, False), ("0", to_bool, False), ("2", to_bool, True),
        ("maybe", to_bool, None),
        ("2024-01-02T03:04:05", parse_time, dt.datetime(2024, 1, 2, 3, 4, 5)),
        ("2024-01-02T03:04:05+02:00", parse_time, dt.datetime(2024, 1, 2, 1, 4, 5)),
        ("not a time", parse_time, None),
    ],
)
def test_casts_give_null_on_failure(spark, text, fn, want):
    assert one(spark, text, fn) == want


def test_large_long_keeps_every_digit(spark):
    assert one(spark, "9007199254740993", to_long) == 9007199254740993


def test_shred_reads_nested_paths_once_and_survives_bad_text(spark):
    df = spark.createDataFrame(
        [
            (1, '{"speed": {"value": 3.5}, "direction": {"degrees": 90.9, "description": "E"}}'),
            (2, '{"speed": {"value": "4"}}'),
            (3, '{"speed": '),
            (4, None),
            (5, '{"speed": 7}'),
            (6, '{"speed": {"value": "n/a"}, "direction": {"degrees": null}}'),
        ],
        "id int, wind string",
    )
    fields = {
        "v": ("wind", "$.speed.value", "double"),
        "g": ("wind", "$.direction.degrees", "int"),
        "n": ("wind", "$.direction.description", "string"),
    }
    out = shred(df, fields)
    assert rows(out.select("id", "v", "g", "n"), "id") == [
        (1, 3.5, 90, "E"), (2, 4.0, None, None), (3, None, None, None),
        (4, None, None, None), (5, None, None, None), (6, None, None, None),
    ]
    assert out._jdf.queryExecution().optimizedPlan().toString().count("from_json") == 1


def test_shred_of_variant_and_of_plain_columns(spark):
    df = spark.sql("""SELECT parse_json('{"a": {"b": 2}}') AS doc, '7.9' AS plain""")
    out = shred(df, {"b": ("doc", "$.a.b", "double"), "missing": ("doc", "$.z", "double"), "i": ("plain", "$", "int")})
    assert rows(out.select("b", "missing", "i")) == [(2.0, None, 7)]


def test_shred_may_replace_its_own_source(spark):
    df = spark.createDataFrame([('{"value": 1}',)], "temperature string")
    assert rows(shred(df, {"temperature": ("temperature", "$.value", "double")})) == [(1.0,)]


def test_names():
    assert clean_identifier("humanresources department") == "humanresources_department"
    assert clean_identifier("a  (b)-c") == "a_b_c"
    assert flat_name("a.b predictions") == "a_b_predictions"
    assert catalog_name("lh.dbo.my table") == "lh__dbo.my_table"
    assert catalog_name("dbo.t") == "dbo.t"
    assert catalog_name("t") == "t"
    with pytest.raises(ValueError):
        catalog_name("a.b.c.d")
