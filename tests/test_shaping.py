import datetime as dt

import pytest
from pyspark.sql import functions as F

from conftest import plan_of, rows
from veleta.operators import dedup, shaping


def test_keep_any_not_null(spark):
    df = spark.createDataFrame(
        [(1, None, None, None), (2, 1.0, None, None), (3, None, 2.0, None), (4, None, None, 3.0)],
        "id int, a double, b double, c double",
    )
    assert [r[0] for r in rows(shaping.keep_any_not_null(df, ["a", "b", "c"]), "id")] == [2, 3, 4]


def test_derived_columns_see_earlier_ones(spark):
    out = shaping.derive(spark.range(1), a=F.lit(2), b=F.col("a") + 1)
    assert rows(out) == [(0, 2, 3)]


def test_local_day_bounds_and_pushdown(spark, tmp_path):
    moments = [
        dt.datetime(2024, 1, 13, 23, 59, 59, 999999), dt.datetime(2024, 1, 14), dt.datetime(2024, 1, 14, 23, 59, 59),
        dt.datetime(2024, 1, 15),
    ]
    path = str(tmp_path / "t")
    spark.createDataFrame([(m,) for m in moments], "ts timestamp").write.parquet(path)
    df = spark.read.parquet(path)
    # Half past two in the night, three hours back, is still the day before.
    today = shaping.in_local_day(df, "ts", dt.datetime(2024, 1, 15, 2, 30))
    assert [r[0] for r in rows(today, "ts")] == moments[1:3]
    assert "GreaterThanOrEqual(ts" in plan_of(today) and "LessThan(ts" in plan_of(today)
    later = shaping.in_local_day(df, "ts", dt.datetime(2024, 1, 15, 3, 0))
    assert [r[0] for r in rows(later)] == moments[3:]
    assert shaping.in_local_day(df, "ts").count() == 0


@pytest.mark.parametrize("kind,pushed", [("timestamp_ntz", "GreaterThanOrEqual(ts,2024-01-14T00:00"), ("date", "GreaterThanOrEqual(ts,2024-01-14)")])
def test_local_day_is_pushed_down_for_every_time_type(spark, tmp_path, kind, pushed):
    path = str(tmp_path / kind)
    spark.sql(f"SELECT CAST(d AS {kind}) AS ts FROM VALUES (DATE'2024-01-13'), (DATE'2024-01-14'), (DATE'2024-01-15') t(d)").write.parquet(path)
    today = shaping.in_local_day(spark.read.parquet(path), "ts", dt.datetime(2024, 1, 15, 2, 30))
    assert today.count() == 1 and pushed in plan_of(today)


def test_sanitised_names_must_not_meet(spark):
    assert shaping.sanitise_columns(spark.sql("SELECT 1 AS `a b`, 2 AS c")).columns == ["a_b", "c"]
    with pytest.raises(ValueError):
        shaping.sanitise_columns(spark.sql("SELECT 1 AS `a b`, 2 AS `a-b`"))


def test_time_first(spark):
    out = shaping.time_first(spark.createDataFrame([(1, "2024-02-29", 2)], "a int, t string, b int"), "t")
    assert out.columns == ["t", "a", "b"] and rows(out) == [(dt.datetime(2024, 2, 29), 1, 2)]


def test_drop_all_null_and_select_types(spark):
    df = spark.sql("SELECT 1 AS n, CAST(NULL AS DOUBLE) AS gone, 'x' AS s, DATE'2024-01-01' AS d, true AS b")
    assert shaping.drop_all_null(df).columns == ["n", "s", "d", "b"]
    assert shaping.select_types(df).columns == ["n", "gone", "d"]
    assert shaping.select_types(df, ["text", "boolean"]).columns == ["s", "b"]


def test_tighten_types(spark):
    df = spark.createDataFrame(
        [("1", "1.5", "2024-01-01", "true", "x", 2.0, 2.5, None), ("-2", ".5e1", "2024-01-02 03:04:05", "No", "1", 3.0, None, None)],
        "a string, b string, c string, d string, e string, f double, g double, h string",
    )
    out = shaping.tighten_types(df)
    assert [t for _, t in out.dtypes] == ["bigint", "double", "timestamp", "boolean", "string", "bigint", "double", "string"]
    assert rows(out, "a")[0][:4] == (-2, 5.0, dt.datetime(2024, 1, 2, 3, 4, 5), False)


def test_latest_and_first_per_key(spark):
    df = spark.createDataFrame(
        [("a", 1, 5, "p"), ("a", 2, 5, "q"), ("a", 3, None, "r"), ("b", 4, None, "s"), (None, 5, 1, "t"), (None, 6, 2, "u")],
        "k string, id int, ord int, x string",
    )
    latest = dedup.latest_per_key(df, ["k"], "ord", ["id"])
    assert {r[1] for r in rows(latest)} == {2, 4, 6}
    first = dedup.first_per_key(df, ["k"], ["ord", "id"])
    assert {r[1] for r in rows(first)} == {1, 4, 5}
    again = dedup.latest_per_key(latest, ["k"], "ord", ["id"])
    assert sorted(rows(again), key=repr) == sorted(rows(latest), key=repr)


def test_one_row_per_key_is_limited_before_the_shuffle(spark):
    df = spark.range(1000).selectExpr("id % 3 AS k", "id AS ord", "id AS id2")
    plan = plan_of(dedup.latest_per_key(df, ["k"], "ord", ["id2"]))
    assert plan.count("WindowGroupLimit") == 2 and "Partial" in plan


def test_distinct_keeps_every_combination(spark):
    df = spark.createDataFrame([(1, 1.0), (1, 2.0), (1, 1.0)], "k int, lat double")
    assert rows(dedup.distinct_rows(df, ["k", "lat"]), "lat") == [(1, 1.0), (1, 2.0)]
