import datetime as dt

import pandas as pd
import pytest
from pyspark.sql import functions as F

from conftest import plan_of, rows
from veleta.operators import ordering

START = dt.datetime(2024, 1, 1)


def two_levels():
    return [F.date_trunc("day", "t"), F.date_trunc("hour", "t")]


def three_levels():
    return [F.date_trunc("month", "t"), F.date_trunc("hour", "t"), F.date_trunc("minute", "t")]


@pytest.fixture(scope="module")
def frame(spark):
    """2,000 rows over 60 hours with gaps; one key holds two thirds of them."""
    pdf = pd.DataFrame({"id": range(2000)})
    pdf["k"] = pdf["id"].map(lambda i: "hot" if i % 3 else f"k{i % 5}")
    pdf["t"] = pdf["id"].map(lambda i: START + dt.timedelta(minutes=(i * 7919 % 1800) * 2))
    pdf["v"] = pdf["id"].map(lambda i: None if i % 4 else float(i))
    pdf["w"] = pdf["id"].map(lambda i: None if i % 97 else f"w{i}")
    return spark.createDataFrame(pdf).persist(), pdf


@pytest.mark.parametrize("chunk", [None, "hour", "year", "minute", two_levels, three_levels])
def test_positions_do_not_depend_on_the_chunk(frame, chunk):
    df, pdf = frame
    chunk = chunk() if callable(chunk) else chunk
    want = pdf.sort_values(["k", "t", "id"]).assign(pos=lambda d: d.groupby("k").cumcount() + 1)
    want["n"] = want.groupby("k")["id"].transform("size")
    got = ordering.positions(df, ["k"], ["t", "id"], chunk).select("id", "pos", "n").toPandas()
    merged = got.merge(want[["id", "pos", "n"]], on="id", suffixes=("", "_want"))
    assert len(merged) == 2000
    assert (merged["pos"] == merged["pos_want"]).all() and (merged["n"] == merged["n_want"]).all()


@pytest.mark.parametrize(
    "rows_per_chunk,unit", [(2000, "year"), (1000, "day"), (500, "hour"), (10, "minute"), (2, "minute"), (0, "second")]
)
def test_time_unit_is_the_coarsest_that_fits(frame, rows_per_chunk, unit):
    df, pdf = frame
    assert ordering.time_unit_for(df, ["k"], "t", rows_per_chunk) == unit
    forms = {"year": "%Y", "day": "%Y%m%d", "hour": "%Y%m%d%H", "minute": "%Y%m%d%H%M"}
    if unit in forms:
        assert pdf.groupby(["k", pdf["t"].dt.strftime(forms[unit])]).size().max() <= rows_per_chunk


def test_dates_are_cut_by_day_at_most(spark):
    df = spark.range(100).selectExpr("id", "date_add(DATE'2024-01-01', CAST(id % 2 AS INT)) AS t")
    assert ordering.time_unit_for(df, [], "t", 60) == "day" and ordering.time_unit_for(df, [], "t", 5) == "day"


def test_positions_without_keys(frame):
    df, _ = frame
    got = [r[0] for r in rows(ordering.positions(df, [], ["t", "id"]).select("pos"), "pos")]
    assert got == list(range(1, 2001))


def test_forward_fill(frame):
    df, pdf = frame
    ordered = pdf.sort_values(["k", "t", "id"])
    want = ordered.assign(**{c: ordered.groupby("k")[c].ffill() for c in ("v", "w")}).set_index("id")
    for chunk in ("hour", "day", two_levels(), three_levels()):
        got = ordering.forward_fill(df, ["v", "w"], ["k"], ["t", "id"], chunk).toPandas().set_index("id")
        assert len(got) == 2000
        for c in ("v", "w"):
            pairs = pd.DataFrame({"got": got[c], "want": want[c]})
            same = (pairs["got"] == pairs["want"]) | (pairs["got"].isna() & pairs["want"].isna())
            assert same.all()


@pytest.mark.parametrize("n", [0, 1, 37, 666, 1999, 2000, 5000])
def test_first_rows(frame, n):
    df, pdf = frame
    want = set(pdf.sort_values(["t", "id"])["id"].head(n))
    for chunk in ("hour", two_levels()):
        assert {r[0] for r in rows(ordering.first_rows(df, n, ["t", "id"], chunk).select("id"))} == want


def test_first_rows_on_a_chunk_boundary(frame):
    df, pdf = frame
    first_day = int((pdf["t"] < START + dt.timedelta(days=1)).sum())
    got = ordering.first_rows(df, first_day, ["t", "id"], "day")
    assert got.count() == first_day and got.agg(F.max("t")).first()[0] < START + dt.timedelta(days=1)


def test_rows_without_key_or_time_are_kept(spark):
    df = spark.createDataFrame(
        [(None, START, 1, 5.0), (None, None, 2, None), ("a", None, 3, 7.0), ("a", START, 4, None), ("a", None, 5, None)],
        "k string, t timestamp, id int, v double",
    )
    got = {r["id"]: (r["pos"], r["n"]) for r in ordering.positions(df, ["k"], ["t", "id"]).collect()}
    assert got == {2: (1, 2), 1: (2, 2), 3: (1, 3), 5: (2, 3), 4: (3, 3)}
    by_levels = ordering.positions(df, ["k"], ["t", "id"], [*two_levels(), F.floor(F.col("id") / 2)])
    assert {r["id"]: (r["pos"], r["n"]) for r in by_levels.collect()} == got
    filled = {r["id"]: r["v"] for r in ordering.forward_fill(df, ["v"], ["k"], ["t", "id"]).collect()}
    assert filled == {1: 5.0, 2: None, 3: 7.0, 5: 7.0, 4: 7.0}
    for n, want in ((2, {2, 3}), (3, {2, 3, 5}), (4, {1, 2, 3, 5})):
        assert {r["id"] for r in ordering.first_rows(df, n, ["t", "id"]).collect()} == want


def test_one_shuffle_moves_the_rows(spark):
    df = spark.range(100).selectExpr("id % 3 AS k", "timestamp_seconds(id) AS t", "id")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = plan_of(ordering.positions(df, ["k"], ["t"]))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    # Rows once; summaries once by chunk, once by key, once back.
    assert plan.count("Exchange hashpartitioning") == 4 and "SinglePartition" not in plan


def test_split_and_holdout_round_differently(spark):
    df = spark.range(101).withColumn("t", F.timestamp_seconds(F.col("id") * 3600))
    split = ordering.ordered_split(df, [], ["t"])
    hold = ordering.ordered_holdout(df, [], ["t"])
    assert split.where("is_train").count() == 80
    assert hold.where("is_train").count() == 81
    assert hold.where("NOT is_train").agg(F.min("id")).first()[0] == 81
    assert split.count() == 101


def test_earlier_positions_are_replaced(spark):
    df = spark.range(10).withColumn("n", F.timestamp_seconds(F.col("id") * 3600))
    once = ordering.ordered_split(df, [], ["n"])
    again = ordering.ordered_split(once.withColumn("t", F.timestamp_seconds(-F.col("id"))), [], ["t"])
    assert again.columns.count("n") == 1 and again.where("is_train").agg(F.min("id")).first()[0] == 2


def test_top_k(spark):
    df = spark.createDataFrame([("a", 3.0, 1), ("a", 1.0, 2), ("a", None, 3), ("b", 1.0, 4)], "k string, aic double, g int")
    assert [r[2] for r in rows(ordering.top_k(df, "aic", 2, tiebreak=["g"]))] == [2, 4]
    per_key = ordering.top_k(df, "aic", 1, ["k"], ["g"])
    assert {r[2] for r in rows(per_key)} == {2, 4}


def test_any_order_type_and_no_chunk(spark):
    """Numbers, text and days order rows without a word about chunks; nothing has to fit a calendar."""
    df = spark.range(3000).selectExpr("id", "id % 3 AS k", "lpad(CAST(id * 7919 % 3000 AS STRING), 5, '0') AS s", "CAST(NULL AS DOUBLE) AS v").repartition(7)
    assert [tuple(r) for r in ordering.positions(df, [], ["id"]).select("id", "pos", "n").orderBy("id").head(3)] == [(0, 1, 3000), (1, 2, 3000), (2, 3, 3000)]
    by_text = ordering.positions(df, ["k"], ["s"])
    want = df.toPandas().sort_values(["k", "s"])
    want["pos"] = want.groupby("k").cumcount() + 1
    got = by_text.select("id", "pos").toPandas().merge(want[["id", "pos"]], on="id", suffixes=("", "_want"))
    assert len(got) == 3000 and (got["pos"] == got["pos_want"]).all()
    holes = df.withColumn("v", F.when(F.col("id") % 10 == 0, F.col("id")))
    filled = ordering.forward_fill(holes, ["v"], [], ["id"])
    assert filled.where("v <> id - id % 10").count() == 0 and filled.where("v IS NULL").count() == 0
    assert {r[0] for r in ordering.first_rows(df, 1234, ["id"]).select("id").collect()} == set(range(1234))


def test_a_busy_day_is_split(spark):
    """A hundred thousand rows on one date: no chunk holds much more than its share of the table."""
    df = spark.range(110_000).selectExpr("id", "IF(id < 10000, date_add(DATE'2024-01-01', CAST(id % 50 AS INT)), DATE'2024-06-01') AS t")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        cut = ordering._cut(df, [], ["t"], None)
        sizes = [r["count"] for r in cut.rows.groupBy(*cut.group()).count().collect()]
        assert len(sizes) == 4 and max(sizes) < 2 * 110_000 / 4
        at = ordering.positions(df, [], ["t"])
        assert at.agg(F.count_distinct("pos"), F.min("pos"), F.max("pos")).first() == (110_000, 1, 110_000)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
