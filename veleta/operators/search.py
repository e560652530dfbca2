"""Feature preparation and model search (MLA3-7, PRJ12)."""

from __future__ import annotations

import itertools
import random
import time
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from multiprocessing.pool import ThreadPool

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import (
    DecisionTreeRegressor, GBTRegressor, LinearRegression, RandomForestRegressor,
)
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from veleta.functions.naming import clean_identifier
from veleta.operators.categories import SUFFIX, fit_categories
from veleta.operators.imputation import Imputer, apply_imputer, fit_imputer
from veleta.operators.ordering import Chunk, ordered_holdout
from veleta.operators.shaping import drop_all_null, sanitise_columns, select_types, tighten_types
from veleta.session import stabilise

# Learners and the settings that a search draws from.
SPACE: dict[str, tuple[type, dict[str, Sequence]]] = {
    "gbt": (GBTRegressor, {"maxDepth": [3, 4, 5], "maxIter": [10, 20], "stepSize": [0.1, 0.3]}),
    "random_forest": (RandomForestRegressor, {"maxDepth": [4, 6, 8], "numTrees": [10, 20]}),
    "decision_tree": (DecisionTreeRegressor, {"maxDepth": [3, 5, 8]}),
    "linear": (LinearRegression, {"regParam": [0.0, 0.01, 0.1], "elasticNetParam": [0.0, 0.5]}),
}
_SEEDED = (GBTRegressor, RandomForestRegressor, DecisionTreeRegressor)


@dataclass(frozen=True)
class Prepared:
    train: DataFrame
    test: DataFrame
    imputer: Imputer


def prepare_features(
    df: DataFrame, order: Sequence[str], keys: Sequence[str] = (), test_share: float = 0.2,
    chunk: Chunk = None, exclude: Sequence[str] = (), categories: Sequence[str] = (),
) -> Prepared:
    """Raw frame to filled train and test frames (MLA3).

    Clean names, tighten types, drop empty columns, keep numbers, dates and the text columns
    named in `categories`, hold out the last rows in `order`, fit the fills on the train rows and
    apply them to both.
    """
    # The frame is computed once; types, empty columns and fills are found on the stored columns.
    raw = stabilise(sanitise_columns(df), "raw")
    tight = drop_all_null(tighten_types(raw))
    named = {clean_identifier(c) for c in categories}
    chosen = set(select_types(tight, ("number", "datetime")).columns) | named
    kept = tight.select(*[F.col(f"`{c}`").cast("string").alias(c) if c in named else F.col(f"`{c}`") for c in tight.columns if c in chosen])
    marked = stabilise(ordered_holdout(kept, keys, order, test_share, chunk=chunk), "holdout")
    train = marked.where("is_train").select(*kept.columns)
    test = marked.where(~F.col("is_train")).select(*kept.columns)
    imputer = fit_imputer(train, exclude=exclude)
    fill = {"keys": keys, "order": order, "chunk": chunk}
    return Prepared(apply_imputer(train, imputer, **fill), apply_imputer(test, imputer, **fill), imputer)


def calendar_features(df: DataFrame, ts: str) -> DataFrame:
    """Numeric calendar parts of the time column, for learners that take numbers only."""
    return df.withColumns(
        {
            f"{ts}_day": F.unix_date(F.to_date(ts)).cast("double"),
            f"{ts}_month": F.month(ts).cast("double"),
            f"{ts}_dow": F.dayofweek(ts).cast("double"),
            f"{ts}_doy": F.dayofyear(ts).cast("double"),
        }
    )


def draw_trials(max_trials: int = 10, seed: int = 41, space: Mapping = SPACE) -> list[tuple[str, dict]]:
    """Trials in a seeded sequence that takes the learners in turn."""
    rng = random.Random(seed)
    decks = {}
    for name, (_, options) in space.items():
        combos = [dict(zip(options, values)) for values in itertools.product(*options.values())]
        rng.shuffle(combos)
        decks[name] = combos
    turns = itertools.chain.from_iterable(itertools.zip_longest(*[[(n, c) for c in cs] for n, cs in decks.items()]))
    return [t for t in turns if t is not None][:max_trials]


def model_search(
    train: DataFrame,
    label: str,
    features: Sequence[str],
    order: Sequence[str],
    keys: Sequence[str] = (),
    max_trials: int = 10,
    parallelism: int = 3,
    seed: int = 41,
    valid_share: float = 0.2,
    chunk: Chunk = None,
    metric: str = "rmse",
    space: Mapping = SPACE,
) -> tuple[PipelineModel, DataFrame]:
    """Best model, refitted on all training rows, and one row per trial (MLA4-5).

    Trials are compared on the last rows in `order`, which none of them was fitted on. Each
    fit is a distributed job; `parallelism` of them are submitted side by side. Text features
    become codes by frequency on the rows that trials are fitted on; the codes are part of the
    model.
    """
    spark = train.sparkSession
    marked = ordered_holdout(train.where(F.col(label).isNotNull()), keys, order, valid_share, chunk=chunk)
    texts = [c for c in features if isinstance(train.schema[c].dataType, T.StringType)]
    before = [fit_categories(marked.where("is_train"), texts)] if texts else []
    bins = max([32, *[len(labels) + 1 for stage in before for labels in stage.labelsArray]])
    inputs = [f"{c}{SUFFIX}" if c in texts else c for c in features]
    assembler = VectorAssembler(inputCols=inputs, outputCol="features", handleInvalid="keep")
    ready = PipelineModel(stages=[*before, assembler]).transform(marked).select("features", F.col(label).cast("double").alias("label"), "is_train")
    # Every round of a tree is a job whose tasks each report to the driver, so fits take one task for each core.
    ready = ready.coalesce(spark.sparkContext.defaultParallelism).persist()
    fit_rows, valid_rows = ready.where("is_train"), ready.where(~F.col("is_train"))
    evaluator = RegressionEvaluator(metricName=metric)

    def build(name: str, params: dict):
        kind = space[name][0]
        extra = {"seed": seed} if issubclass(kind, _SEEDED) else {}
        if issubclass(kind, _SEEDED) and bins > 32:
            extra["maxBins"] = bins  # a tree needs a bin for every code
        return kind(featuresCol="features", labelCol="label", **{**extra, **params})

    def run(trial):
        number, (name, params) = trial
        begun = time.monotonic()
        try:
            score = evaluator.evaluate(build(name, params).fit(fit_rows).transform(valid_rows))
            error = None
        except Exception as failed:  # a failed trial is a row, not the end of the search
            score, error = None, str(failed)
        return number, name, params, score, time.monotonic() - begun, error

    trials = list(enumerate(draw_trials(max_trials, seed, space)))
    try:
        with ThreadPool(parallelism) as pool:
            results = pool.map(run, trials)
        scored = [r for r in results if r[3] is not None]
        if not scored:
            raise RuntimeError(f"every trial failed: {results[0][5] if results else 'no trial'}")
        sign = -1 if evaluator.isLargerBetter() else 1
        best = min(scored, key=lambda r: (sign * r[3], r[0]))
        learner = build(best[1], best[2])
        model = Pipeline(stages=[learner]).fit(ready.select("features", "label"))
    finally:
        ready.unpersist()
    rows = [(n, e, str(p), m, s, n == best[0], err) for n, e, p, m, s, err in results]
    table = spark.createDataFrame(
        rows, "trial int, estimator string, params string, metric double, seconds double, is_best boolean, error string"
    )
    return PipelineModel(stages=[*before, assembler, *model.stages]), table


def save_model(model: PipelineModel, root: str, name: str, version: int) -> str:
    """Store a model under its name and version (MLA6)."""
    path = f"{root.rstrip('/')}/{name}/v={version}"
    model.write().overwrite().save(path)
    return path


def load_model(root: str, name: str, version: int) -> PipelineModel:
    return PipelineModel.load(f"{root.rstrip('/')}/{name}/v={version}")


def score(model: PipelineModel, df: DataFrame, keep: Sequence[str] = (), out: str = "value") -> DataFrame:
    """Predictions as one FLOAT column, next to the key columns in `keep` (MLA7)."""
    return model.transform(df).select(*keep, F.col("prediction").cast(T.FloatType()).alias(out))
