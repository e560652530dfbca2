import pytest
from pyspark.sql import functions as F

from conftest import plan_of, rows
from veleta.operators.semantic import Measure, Relationship, SemanticModel, cross_filter, relate, repeated_keys


@pytest.fixture()
def fact(spark):
    return spark.createDataFrame(
        [(2024, 1, 1.0, 10.0, 1), (2024, 1, 2.0, 20.0, 3), (2024, 2, 1.0, 30.0, 1), (2024, 2, 9.0, 40.0, 2), (2024, 2, 2.0, None, 5)],
        "anno bigint, mes bigint, code double, vv double, w int",
    )


@pytest.fixture()
def dim(spark):
    return spark.createDataFrame(
        [(1.0, "north"), (2.0, "south"), (3.0, "unused")], "code double, nombre string"
    )


@pytest.fixture()
def model(fact, dim):
    return SemanticModel(
        fact=fact,
        dims={"st": dim},
        relationships=[Relationship("code", "st", "code")],
        measures={
            "total": Measure("sum", "vv"), "mean": Measure("avg", "vv"), "n": Measure("count", "vv"),
            "low": Measure("min", "vv"), "high": Measure("max", "vv"), "weighted": Measure("weighted_avg", "vv", "w"),
        },
        summarize_by={"vv": "sum", "w": "sum", "code": "none"},
    )


def test_measures_by_time(model):
    assert rows(model.query(["anno", "mes"], ["total"], order=["anno", "mes"])) == [(2024, 1, 30.0), (2024, 2, 70.0)]


def test_measures_by_dimension_column(model):
    got = {r[0]: r[1:] for r in rows(model.query(["st.nombre"], ["total", "mean", "n", "low", "high", "weighted"]))}
    assert got == {
        "north": (40.0, 20.0, 2, 10.0, 30.0, 20.0),
        "south": (20.0, 20.0, 1, 20.0, 20.0, 20.0),
        None: (40.0, 40.0, 1, 40.0, 40.0, 40.0),
    }


def test_mean_over_groups_is_a_mean_of_rows_not_of_means(model):
    assert rows(model.query([], ["mean", "weighted"])) == [(25.0, pytest.approx((10 + 60 + 30 + 80) / 7))]


def test_fact_is_aggregated_before_it_meets_the_dimension(model):
    plan = plan_of(model.query(["st.nombre"], ["total"]))
    join = plan.index("Join")
    assert "HashAggregate" in plan[join:] and "HashAggregate" in plan[:join]


def test_default_sums_and_unknown_measures(model):
    got = {r[0]: r[1:] for r in rows(model.default_summary(["code"]))}
    assert got[1.0] == (40.0, 2) and got[9.0] == (40.0, 2)
    with pytest.raises(ValueError):
        model.query(["mes"], ["nombre"])


def test_filter_and_selection(model):
    out = model.query(["mes"], ["total"], where=F.col("mes") == 2, selections={"st": F.col("nombre") == "north"})
    assert rows(out) == [(2, 30.0)]


def test_relate_keeps_facts_without_dimension_and_checks_keys(fact, dim):
    joined = relate(fact, dim, "code", "code")
    assert joined.count() == 5 and joined.where("nombre IS NULL").count() == 1
    twice = dim.union(dim.where("code = 1"))
    assert rows(repeated_keys(twice, "code")) == [(1.0, 2)]
    with pytest.raises(ValueError):
        relate(fact, twice, "code", "code")
    assert relate(fact, twice, "code", "code", check=False).count() == 7


def test_cross_filter_never_multiplies_rows(fact, dim):
    twice = dim.union(dim)
    out = cross_filter(fact, twice, "code", "code", F.col("nombre") == "south")
    assert out.count() == 2 and out.columns == fact.columns
