import datetime as dt

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from conftest import rows
from veleta.operators import search
from veleta.operators.imputation import apply_imputer, choose_strategies, fit_imputer


@pytest.fixture()
def gaps(spark):
    days = [dt.date(2024, 1, 1) + dt.timedelta(days=i) for i in range(6)]
    return spark.createDataFrame(
        [(1, 1.0, 1.0, None, "b", True), (2, 2.0, 1.0, days[1], "a", None), (3, 3.0, None, None, "a", True),
         (4, None, 1.0, days[3], None, True), (5, 2.0, 90.0, None, "b", False), (6, 2.0, 2.0, days[1], "c", False)],
        "id int, even double, tail double, seen date, kind string, flag boolean",
    )


def test_strategies_follow_skewness_and_caller(gaps):
    got = choose_strategies(gaps, exclude=["id"])
    assert got == {"even": "mean", "tail": "median", "seen": "forward", "kind": "mode", "flag": "mode"}
    named = choose_strategies(gaps, mean=["tail"], mode=["even"], exclude=["id"])
    assert named["tail"] == "mean" and named["even"] == "mode"


def test_fill_values(gaps):
    imputer = fit_imputer(gaps, exclude=["id"])
    assert imputer.values["even"] == 2.0 and imputer.values["tail"] == 1.0
    assert imputer.values["kind"] == "a" and imputer.values["flag"] == "true"
    out = rows(apply_imputer(gaps, imputer, order=["id"], chunk=F.col("id")), "id")
    day = lambda n: dt.date(2024, 1, n)
    assert [r[3] for r in out] == [day(2), day(2), day(2), day(4), day(4), day(2)]
    assert out[3][1:3] == (2.0, 1.0) and out[3][4] == "a" and out[1][5] is True
    assert all(v is not None for r in out for v in r)


def test_whole_number_columns_are_not_cut_to_a_whole_mean(spark):
    df = spark.createDataFrame([(1,), (2,), (None,), (2,)], "n int")
    assert sorted(r[0] for r in rows(apply_imputer(df, fit_imputer(df)))) == pytest.approx([1.0, 5 / 3, 2.0, 2.0])


def test_fills_come_from_train_rows_only(spark):
    df = spark.createDataFrame([(i, float(i) if i % 7 else None) for i in range(100)], "id int, v double")
    df = df.withColumn("day", F.timestamp_seconds(F.col("id") * 86400))
    p = search.prepare_features(df, order=["day"])
    assert (p.train.count(), p.test.count()) == (80, 20)
    want = np.mean([i for i in range(80) if i % 7])
    assert p.imputer.values["v"] == pytest.approx(want)
    assert p.test.where("id = 84").first()["v"] == pytest.approx(want)


@pytest.fixture(scope="module")
def wavy(spark):
    rng = np.random.default_rng(0)
    pdf = pd.DataFrame({"day": pd.date_range("2022-01-01", periods=400), "x": rng.normal(size=400), "z": rng.normal(size=400)})
    pdf["y"] = 3 * pdf["x"] - pdf["z"] + rng.normal(scale=0.1, size=400)
    return spark.createDataFrame(pdf).persist()


def test_trials_are_seeded_and_take_learners_in_turn():
    a, b = search.draw_trials(10, 41), search.draw_trials(10, 41)
    assert a == b and len(a) == 10 and {n for n, _ in a[:4]} == set(search.SPACE)
    assert search.draw_trials(10, 42) != a
    assert len({str(t) for t in a}) == 10


def test_search_finds_the_linear_model_and_round_trips(wavy, tmp_path):
    train, test = wavy.where("day < '2022-12-01'"), wavy.where("day >= '2022-12-01'")
    model, trials = search.model_search(train, "y", ["x", "z"], ["day"], max_trials=5, chunk="month")
    table = trials.orderBy("trial").toPandas()
    assert len(table) == 5 and table["is_best"].sum() == 1 and table["error"].isna().all()
    assert table.loc[table["is_best"], "metric"].iloc[0] == table["metric"].min()
    path = search.save_model(model, str(tmp_path), "m", 3)
    assert path.endswith("m/v=3")
    scored = search.score(search.load_model(str(tmp_path), "m", 3), test, keep=["day"])
    assert scored.dtypes == [("day", "timestamp"), ("value", "float")]
    both = scored.join(test, "day").agg(F.corr("value", "y")).first()[0]
    assert both > 0.95
    assert search.score(model, test).columns == ["value"]


def test_a_failed_trial_is_a_row(wavy):
    space = {"linear": search.SPACE["linear"], "broken": (search.DecisionTreeRegressor, {"maxBins": [1]})}
    _, trials = search.model_search(wavy, "y", ["x"], ["day"], max_trials=2, chunk="month", space=space)
    table = trials.toPandas().set_index("estimator")
    assert table.loc["broken", "metric"] is None or np.isnan(table.loc["broken", "metric"])
    assert table.loc["broken", "error"] and table.loc["linear", "is_best"]


def test_calendar_features(spark):
    out = search.calendar_features(spark.sql("SELECT TIMESTAMP'2024-02-29 10:00:00' AS t"), "t").first()
    assert (out["t_month"], out["t_doy"]) == (2.0, 60.0)


def test_text_features_reach_the_learner(spark, tmp_path):
    rng = np.random.default_rng(1)
    kinds = [f"k{i}" for i in range(40)]
    pdf = pd.DataFrame({"day": pd.date_range("2022-01-01", periods=600), "kind": rng.choice(kinds, size=600), "x": rng.normal(size=600)})
    pdf["y"] = pdf["kind"].str[1:].astype(int) % 2 * 10.0 + pdf["x"]
    pdf.loc[::50, "kind"] = None
    train = spark.createDataFrame(pdf)
    model, trials = search.model_search(train, "y", ["kind", "x"], ["day"], max_trials=4)
    assert trials.where("error IS NOT NULL").count() == 0
    path = search.save_model(model, str(tmp_path), "m", 1)
    unseen = spark.createDataFrame([("k1", 0.0), ("k2", 0.0), ("never", 0.0), (None, 0.0)], "kind string, x double")
    got = [r["value"] for r in search.score(search.load_model(str(tmp_path), "m", 1), unseen, keep=["kind"]).collect()]
    assert path and len(got) == 4 and all(np.isfinite(got)) and got[0] - got[1] > 5


def test_prepared_categories(spark):
    df = spark.createDataFrame([(i, "ab"[i % 2] if i % 5 else None, float(i)) for i in range(50)], "id int, `the kind` string, v double")
    p = search.prepare_features(df, order=["id"], exclude=["id"], categories=["the kind"])
    assert p.train.columns == ["id", "the_kind", "v"] and p.train.where("the_kind IS NULL").count() == 0
    assert search.prepare_features(df, order=["id"]).train.columns == ["id", "v"]


def test_fits_take_one_task_for_each_core_however_many_partitions_there_are(spark):
    seen = []

    class Watched(search.LinearRegression):
        def _fit(self, dataset):
            seen.append((dataset.rdd.getNumPartitions(), dataset.count()))
            return super()._fit(dataset)

    cores = spark.sparkContext.defaultParallelism
    # A join that is not broadcast deals its rows to all shuffle partitions.
    confs = {"spark.sql.shuffle.partitions": str(3 * cores + 1), "spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    old = {k: spark.conf.get(k) for k in confs}
    df = spark.range(500).select("id", F.rand(1).alias("x"), (F.col("id") * 0.5).alias("y"))
    try:
        for k, v in confs.items():
            spark.conf.set(k, v)
        search.model_search(df, "y", ["x"], ["id"], max_trials=1, space={"linear": (Watched, {"regParam": [0.0]})})
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    assert [rows for _, rows in seen] == [400, 500] and all(n <= cores for n, _ in seen)
