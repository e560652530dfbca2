"""Forecast errors and candidate choice (JON3, AGG15, AGG17, TSA9-10)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def align(actual: DataFrame, predicted: DataFrame, keys: Sequence[str], pos: str = "pos") -> DataFrame:
    """Pair actual and predicted values of a series by position (JON3)."""
    return actual.join(predicted, [*keys, pos])


def forecast_metrics(pairs: DataFrame, keys: Sequence[str], y: str = "y", yhat: str = "yhat") -> DataFrame:
    """MSE, RMSE, MAE, R2 and MAPE per key in one hash aggregate (AGG15).

    Pairs without both values are left out. Zero actuals do not count in MAPE; constant
    actuals have no R2. The total sum of squares is the population variance times n, so the
    mean of the actuals needs no pass of its own.
    """
    error = F.col(y) - F.col(yhat)
    paired = pairs.where(F.col(y).isNotNull() & F.col(yhat).isNotNull())
    return paired.groupBy(*keys).agg(
        F.count("*").alias("n"),
        F.avg(error * error).alias("mse"),
        F.sqrt(F.avg(error * error)).alias("rmse"),
        F.avg(F.abs(error)).alias("mae"),
        (1 - F.try_divide(F.sum(error * error), F.nullif(F.var_pop(y) * F.count("*"), F.lit(0.0)))).alias("r2"),
        (F.avg(F.abs(F.try_divide(error, F.nullif(F.col(y), F.lit(0.0))))) * 100).alias("mape"),
    )


def residuals(pairs: DataFrame, y: str = "y", yhat: str = "yhat", out: str = "residual") -> DataFrame:
    return pairs.withColumn(out, F.col(y) - F.col(yhat))


def best_candidate(
    candidates: DataFrame, keys: Sequence[str], params: Sequence[str], metric: str = "aic", grid: str = "grid_pos"
) -> DataFrame:
    """Candidate with the least metric per key; the earlier grid position wins a tie (AGG17).

    Failed candidates carry a NULL metric and never win.
    """
    fitted = candidates.where(F.col(metric).isNotNull())
    chosen = F.min_by(F.struct(*params, metric), F.struct(metric, grid)).alias("best")
    return fitted.groupBy(*keys).agg(chosen).select(*keys, "best.*")
