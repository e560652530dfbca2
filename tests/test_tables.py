import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from conftest import plan_of, rows
from veleta.plans.medallion import bronze_to_silver, run_chain, silver_rollups, silver_to_gold
from veleta.sinks import assert_written, create_table, load_to_new_table, save_path, write_table
from veleta.sinks.published import publish, roll_back, version_of
from veleta.sources import as_table, jdbc_options, load_path, pages_to_records, query, read_any, records_frame, scan

RECORD = "id INT, name STRING, phrases ARRAY<STRING>"


def page(n, results, more="next"):
    return n, json.dumps({"results": results, **({"next": more} if more else {})})


def rec(i, **k):
    return {"id": i, "name": f"n{i}", "phrases": ["a", "b"], **k}


def ids(spark, pages, start=60, **kw):
    schema = "page bigint, body string" + (", source string" if kw else "")
    return [r[0] for r in rows(pages_to_records(spark.createDataFrame(pages, schema), RECORD, start, **kw).select("id"), "id")]


def test_pages_stop_after_the_last_page(spark):
    pages = [page(59, [rec(0)]), page(60, [rec(1), rec(2)]), page(61, [rec(3)], None), page(62, [rec(4)])]
    assert ids(spark, pages) == [1, 2, 3]


def test_pages_stop_before_empty_missing_and_unreadable_ones(spark):
    assert ids(spark, [page(60, [rec(1)]), page(61, []), page(62, [rec(3)])]) == [1]
    assert ids(spark, [page(60, [rec(1)]), page(62, [rec(3)])]) == [1]
    assert ids(spark, [page(60, [rec(1)]), (61, "<html>"), page(62, [rec(3)])]) == [1]
    assert ids(spark, [page(60, [rec(1)]), (61, None), page(62, [rec(3)])]) == [1]
    assert ids(spark, [page(61, [rec(1)])]) == []
    assert ids(spark, [page(60, [rec(1)], "")]) == [1]


def test_page_records_keep_duplicates_nulls_and_arrays(spark):
    df = spark.createDataFrame(
        [page(1, [rec(1), rec(1), rec(2, phrases=None), rec(3, phrases=[]), {"id": 4}], None)], "page bigint, body string"
    )
    got = rows(pages_to_records(df, RECORD, 1), "id")
    assert [r[1] for r in got] == [1, 1, 2, 3, 4]
    assert [r[3] for r in got] == [["a", "b"], ["a", "b"], None, [], None]


def test_page_sequences_stop_on_their_own(spark):
    pages = [(*page(60, [rec(1)]), "x"), (*page(61, [rec(2)]), "x"), (*page(60, [rec(3)], None), "y"), (*page(61, [rec(4)]), "y"),
             (*page(61, [rec(5)]), "z")]
    assert ids(spark, pages, source="source") == [1, 2, 3]


def test_jdbc_options():
    plain = jdbc_options("jdbc:postgresql://h/db", "humanresources", "department", user="u")
    assert plain["dbtable"] == "humanresources.department" and plain["user"] == "u" and "numPartitions" not in plain
    split = jdbc_options("jdbc:x", "s", "t", split_on="id", bounds=(1, 900), partitions=9)
    assert (split["partitionColumn"], split["lowerBound"], split["upperBound"], split["numPartitions"]) == ("id", "1", "900", "9")
    with pytest.raises(ValueError):
        jdbc_options("jdbc:x", "s", "t", split_on="id")


def test_table_round_trips(spark, tmp_path, lake):
    base = lake("lh_bronze")
    df = records_frame(spark, [(1, "a"), (2, None)], "id int, `group name` string")
    load_to_new_table(df, f"{base}.humanresources department")
    stored = scan(spark, f"{base}.humanresources department")
    assert stored.columns == ["id", "group_name"] and stored.count() == 2
    assert_written(stored, f"{base}.humanresources department")
    with pytest.raises(AssertionError):
        assert_written(stored.limit(1), f"{base}.humanresources department")
    with pytest.raises(AssertionError):
        assert_written(stored.withColumn("id", F.col("id").cast("bigint")), f"{base}.humanresources department")

    arrays = spark.range(2).select(F.array(F.col("id")).alias("a"))
    write_table(arrays, f"{base}.arrays")
    assert_written(arrays, f"{base}.arrays")

    path = save_path(df.toDF("id", "g"), str(tmp_path / "files"))
    assert load_path(spark, path).count() == 2 and read_any(spark, path).count() == 2
    assert as_table(spark, f"{base}.shortcut", path).count() == 2
    assert rows(query(spark, "SELECT max(id) FROM {t}", t=stored)) == [(2,)]


def test_declared_table_is_kept_and_overwrite_replaces_schema(spark, lake):
    name = f"{lake('lh_x')}.t"
    create_table(spark, name, {"id": "STRING", "ts_registro": "TIMESTAMP"})
    create_table(spark, name, {"other": "INT"})
    assert scan(spark, name).columns == ["id", "ts_registro"]
    write_table(spark.range(3).toDF("n"), name, replace_schema=True, partition_by=[])
    assert scan(spark, name).columns == ["n"]
    write_table(spark.range(2).toDF("n"), name, mode="append")
    assert scan(spark, name).count() == 5
    with pytest.raises(Exception):
        write_table(spark.range(2).toDF("n"), name, mode="errorifexists")


def test_medallion(spark, lake):
    bronze, silver, gold = (lake(n) for n in ("bronze", "silver", "gold"))
    obs = [
        (dt.datetime(2024, 2, 29, 1), 90.0, 1.0, None, 1.0, -33.0, -70.0, "A"),
        (dt.datetime(2024, 2, 29, 2), None, None, None, 1.0, -33.0, -70.0, "A"),
        (dt.datetime(2024, 3, 1, 2), None, None, 5.0, 1.0, -33.5, -70.0, "A"),
        (dt.datetime(2024, 3, 1, 3), None, 2.0, None, 2.0, -34.0, -71.0, "B"),
    ]
    df = spark.createDataFrame(
        obs, "time timestamp, dd_valor double, ff_valor double, VRB_Valor double, CodigoNacional double, latitud double, longitud double, nombreEstacion string"
    )
    write_table(df, f"{bronze}.viento_dmc")
    run_chain([
        lambda: bronze_to_silver(spark, f"{bronze}.viento_dmc", silver),
        lambda: silver_rollups(spark, silver),
        lambda: silver_to_gold(spark, silver, gold),
    ])
    assert scan(spark, f"{silver}.ft_vientos").count() == 3
    assert scan(spark, f"{silver}.dim_estaciones").count() == 3
    assert rows(scan(spark, f"{silver}.ft_viento_anno_mes_dia"), "mes") == [(2024, 2, 29, 90.0, 90.0, 1.0), (2024, 3, 1, None, None, 2.0)]
    assert scan(spark, f"{silver}.ft_viento_anno_mes").count() == 3
    gold_rows = rows(scan(spark, f"{gold}.ml_train_data_viento_promedio"), "CodigoNacional", "fecha")
    assert gold_rows[1] == (1.0, 2024, 3, 1, dt.date(2024, 3, 1), None) and len(gold_rows) == 3


def test_chain_stops_at_the_first_failure():
    seen = []

    def fail():
        raise RuntimeError("import failed")

    with pytest.raises(RuntimeError):
        run_chain([lambda: seen.append("a"), fail, lambda: seen.append("b")])
    assert seen == ["a"]


def test_first_gap_among_many_pages(spark):
    """Bitmaps of 32,768 pages: gaps inside, at the border and behind; a page is parsed once."""
    body = F.concat(F.lit('{"results": [{"id": '), "page", F.lit('}], "next": "x"}'))
    pages = spark.range(7, 100_007).select(F.col("id").alias("page"), F.lit(None).cast("string").alias("who")).withColumn("body", body)
    stop = lambda df: pages_to_records(df, RECORD, 7, source="who").agg(F.max("page")).first()[0]
    assert stop(pages) == 100_006
    for gap in (8, 32_774, 32_775, 65_543, 99_999):
        assert stop(pages.where(F.col("page") != gap)) == gap - 1
        assert stop(pages.withColumn("body", F.when(F.col("page") != gap, F.col("body")))) == gap - 1
    assert stop(pages.where("page > 7")) is None and stop(pages.where("page > 40000")) is None
    plan = plan_of(pages_to_records(pages, RECORD, 7))
    assert "from_json" not in plan  # what is left reads the stored pages


def test_published_versions(spark, lake):
    name = f"{lake('pub')}.t"
    first = publish(spark.range(5), name)
    assert scan(spark, name).count() == 5 and version_of(spark, name) == first
    reader = scan(spark, name)
    second = publish(spark.range(7).selectExpr("id", "CAST(id AS STRING) AS s"), name)
    assert scan(spark, name).columns == ["id", "s"] and reader.count() == 5

    def refuse(rows):
        assert rows.count() > 100, "too few rows"

    with pytest.raises(AssertionError):
        publish(spark.range(3), name, check=refuse)
    with pytest.raises(Exception, match="(?i)divide"):
        publish(spark.range(3).selectExpr("id / (id - id) AS x"), name)
    assert version_of(spark, name) == second and scan(spark, name).count() == 7
    roll_back(spark, name, first)
    assert scan(spark, name).columns == ["id"]
