"""Text columns as codes, for learners that take numbers (PRJ10, MLA3)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import StringIndexer, StringIndexerModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SUFFIX = "__code"


def fit_categories(train: DataFrame, cols: Sequence[str]) -> StringIndexerModel:
    """Codes of the values of text columns: 0 for the most frequent one, equal counts in order of the text.

    All values that occur in `train` have a code of their own. The place behind the last one is for
    NULL and for values that `train` did not have. The model is a pipeline stage, so it is stored
    with the learner that was fitted on its codes.
    """
    indexer = StringIndexer(
        inputCols=list(cols), outputCols=[f"{c}{SUFFIX}" for c in cols], stringOrderType="frequencyDesc", handleInvalid="keep"
    )
    return indexer.fit(train)


def dictionary(model: StringIndexerModel, df: DataFrame) -> DataFrame:
    """column, value and code of a fitted model; the place for all other values has a NULL value."""
    rows = []
    for column, labels in zip(model.getInputCols(), model.labelsArray):
        rows += [(column, value, k) for k, value in enumerate(labels)] + [(column, None, len(labels))]
    return df.sparkSession.createDataFrame(rows, "column string, value string, code int")


def coded(model: StringIndexerModel, df: DataFrame) -> DataFrame:
    """The frame with a whole number beside every coded column."""
    return model.transform(df).withColumns({c: F.col(c).cast("int") for c in model.getOutputCols()})
