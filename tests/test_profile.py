import datetime as dt

import numpy as np
import pandas as pd
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from conftest import plan_of, rows
from veleta.operators import profile, quantiles, rollup

OBS = [
    (dt.datetime(2023, 12, 31, 23, 30), 10.0, 1.0, 1.0),
    (dt.datetime(2024, 1, 1, 0, 0), 350.0, 2.0, 1.0),
    (dt.datetime(2024, 1, 1, 12, 0), 20.0, 3.005, 2.0),
    (dt.datetime(2024, 2, 29, 5, 0), None, None, 1.0),
    (dt.datetime(2024, 2, 29, 6, 0), 90.0, 4.0, 1.0),
    (dt.datetime(2024, 3, 1, 0, 0), 5.0, None, 1.0),
]


@pytest.fixture()
def obs(spark):
    return spark.createDataFrame(OBS, "time timestamp, dd_valor double, ff_valor double, CodigoNacional double")


def test_day_rollup(obs):
    assert rows(rollup.day_rollup(obs), "año", "mes", "dia") == [
        (2023, 12, 31, 10.0, 10.0, 1.0), (2024, 1, 1, 350.0, 20.0, 2.5025),
        (2024, 2, 29, 90.0, 90.0, 4.0), (2024, 3, 1, 5.0, 5.0, None),
    ]


def test_month_rollup_gives_the_greatest_direction_twice(obs):
    out = rollup.month_rollup(obs)
    assert out.columns == ["anno", "mes", "Dir_racha1", "Dir_racha2", "vv_viento_promedio", "CodigoNacional"]
    assert (2024, 1, 20.0, 20.0, 3.01, 2.0) in rows(out)
    assert out.count() == 5


def test_station_daily_mean(obs):
    out = rollup.station_daily_mean(obs)
    assert out.columns == ["CodigoNacional", "anio", "mes", "dia", "fecha", "vviento_promedio"]
    assert (1.0, 2024, 2, 29, dt.date(2024, 2, 29), 4.0) in rows(out)
    assert out.count() == 5


def test_counts_and_description(spark, obs):
    assert rows(profile.row_count(obs)) == [(6,)]
    assert rows(profile.group_counts(obs, ["CodigoNacional"])) == [(1.0, 5), (2.0, 1)]
    assert rows(profile.null_counts(obs)) == [(0, 1, 2, 0)]
    got = rows(profile.describe(obs, ["ff_valor"]))[0]
    want = pd.Series([1.0, 2.0, 3.005, 4.0]).describe()
    assert got[:2] == ("ff_valor", 4)
    assert got[2:] == pytest.approx((want["mean"], want["std"], 1.0, 4.0))
    assert rows(profile.series_extent(obs, ["CodigoNacional"], "time", "ff_valor"), "CodigoNacional")[0] == (
        1.0, OBS[0][0], OBS[5][0], 5, 2,
    )


def test_skewness_equals_the_bias_corrected_form(spark):
    rng = np.random.default_rng(3)
    values = rng.gamma(2, 3, 500)
    df = spark.createDataFrame(pd.DataFrame({"k": ["a"] * 498 + ["b"] * 2, "v": values, "c": 1.0}))
    got = {r[0]: r[1:] for r in rows(profile.skew_corrected(df, ["v", "c"], ["k"]))}
    assert got["a"][0] == pytest.approx(pd.Series(values[:498]).skew())
    assert got["a"][1] == 0.0 and got["b"] == (None, None)


def test_most_frequent_takes_the_lowest_of_a_tie(spark):
    df = spark.createDataFrame([(10, "b"), (9, "b"), (10, "a"), (9, "a"), (None, None)], "n int, s string")
    assert dict(rows(profile.most_frequent(df, ["n", "s"]))) == {"n": "9", "s": "a"}


def test_histogram_keeps_empty_bins_and_closes_the_last(spark):
    values = [0.0, 0.1, 1.0, 9.95, 10.0, 10.0]
    df = spark.createDataFrame([(v,) for v in [*values, None]], "v double")
    got = rows(profile.histogram(df, "v", 30), "bin")
    counts, edges = np.histogram(values, bins=30)
    assert [r[3] for r in got] == counts.tolist()
    assert [r[1] for r in got] == pytest.approx(edges[:-1])
    assert got[-1][2] == pytest.approx(10.0)


def test_histogram_of_constant_values_and_by_key(spark):
    df = spark.createDataFrame([("a", 4.0), ("a", 4.0), ("b", 1.0), ("b", 2.0), (None, 3.0)], "k string, v double")
    got = rows(profile.histogram(df, "v", 4, ["k"]), "k", "bin")
    assert [r[4] for r in got if r[0] == "a"] == np.histogram([4.0, 4.0], bins=4)[0].tolist()
    assert [r[4] for r in got if r[0] == "b"] == [1, 0, 0, 1]
    assert [r[4] for r in got if r[0] is None] == [0, 0, 1, 0]


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(
    values=st.lists(st.one_of(st.none(), st.floats(-5, 5), st.integers(-2, 2).map(float)), min_size=1, max_size=60)
)
def test_medians_equal_numpy(spark, values):
    known = [v for v in values if v is not None]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    got = quantiles.exact_medians(df, ["v"])["v"]
    assert got == (pytest.approx(float(np.median(known))) if known else None)


@pytest.mark.parametrize("shape", ["spread", "one heavy value", "two halves", "few values"])
def test_order_statistics_of_many_rows(spark, shape):
    """Every rank must be exact, however the values are spread."""
    column = {
        "spread": "abs(hash(id)) / 7.0D",
        "one heavy value": "IF(id % 3 = 0, 5.0D, abs(hash(id)) % 1000 / 10.0D)",
        "two halves": "IF(id % 2 = 0, 1.0D, 2.0D)",
        "few values": "CAST(id % 7 AS DOUBLE)",
    }[shape]
    df = spark.range(30_000).select(F.expr(column).alias("v")).persist()
    ordered = np.sort([r[0] for r in df.collect()])
    ranks = [1, 2, 7_500, 15_000, 15_001, 29_999, 30_000]
    got = quantiles.order_statistics(df, {"v": ranks})
    assert [got["v", r] for r in ranks] == [ordered[r - 1] for r in ranks]
    df.unpersist()


def test_order_statistics_keep_the_type_and_all_digits(spark):
    from decimal import Decimal

    rows_ = [
        (2**53 + 1, -(2**63), "12345678901234567890.123456789012345678", Decimal("1.25"), dt.date(2024, 1, 1), dt.datetime(2024, 1, 1, 2, 3, 4, 567891), 7),
        (2**53 + 1, 2**63 - 1, "-99999999999999999999.999999999999999999", Decimal("-7.50"), dt.date(1960, 5, 5), dt.datetime(1950, 1, 1), None),
        (2**53 + 3, 5, "0.000000000000000001", Decimal("3.00"), None, None, 9),
    ]
    df = spark.createDataFrame(rows_, "a bigint, b bigint, c string, d decimal(10,2), e date, f timestamp, g int")
    df = df.withColumn("c", F.col("c").cast("decimal(38,18)"))
    got = quantiles.order_statistics(df, {c: [1, 2, 3] for c in df.columns})
    for c in df.columns:
        known = sorted(r[c] for r in df.select(c).collect() if r[c] is not None)
        assert [got.get((c, k + 1)) for k in range(len(known))] == known and (c, len(known) + 1) not in got
    medians = quantiles.exact_medians(df, ["a", "b", "g"])
    assert medians == {"a": 2**53 + 1, "b": 5, "g": 8} and isinstance(medians["a"], int)


def test_bits_of_doubles_sort_like_the_doubles(spark):
    import math
    import random
    import struct

    rng = random.Random(4)
    values = [0.0, 5e-324, 2.2250738585072014e-308, 2.2250738585072009e-308, 1.7976931348623157e308, math.inf, 0.1]
    values += [2.0**k for k in range(-1074, 1024, 11)] + [math.nextafter(2.0**k, 0) for k in range(-1000, 1024, 13)]
    values += [rng.random() * 10.0 ** rng.randint(-300, 300) for _ in range(300)]
    df = spark.createDataFrame([(v * s,) for v in values for s in (1, -1)], "v double")
    for v, bits in df.select("v", quantiles._bits(F.col("v"))).collect():
        whole = struct.unpack("<q", struct.pack("<d", abs(v)))[0]
        assert bits == (-whole if v < 0 else whole) and quantiles._from_bits(bits) == v


def test_most_frequent_of_many_columns_takes_one_pass(spark):
    df = spark.createDataFrame(
        [(1, "b", None), (10, "a", None), (9, "b", None), (9, "a", None), (None, None, None), (10, "c", None)], "n int, s string, e double"
    )
    top = profile.most_frequent(df, ["n", "s", "e"])
    assert dict(rows(top, "column")) == {"n": "9", "s": "a", "e": None}
    assert plan_of(top).count("Generate") == 1
