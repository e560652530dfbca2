"""Search, test, refit and publish forecasts of every series (TSA1-13 in one run)."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame

from veleta.operators.forecasting import (
    arima_search, best_order, forecast_test_span, future_forecast, publish_forecast, run_summary,
)
from veleta.operators.metrics import forecast_metrics
from veleta.operators.series import split_series
from veleta.session import stabilise


@dataclass(frozen=True)
class ForecastRun:
    candidates: DataFrame
    orders: DataFrame
    pairs: DataFrame
    metrics: DataFrame
    published: DataFrame
    summary: DataFrame


def forecast_all(
    series: DataFrame,
    orders: list[tuple[int, int, int]] | None = None,
    horizon: int = 365,
    train_share: float = 0.8,
    generated_at: object = None,
) -> ForecastRun:
    """Forecast run over all series.

    The candidates of the grid search and the test pairs feed several results and are costly,
    so both are stored; they are one row per candidate and one per test day.
    """
    split = split_series(series, train_share)
    candidates = stabilise(arima_search(split.where("is_train"), orders))
    chosen = best_order(candidates)
    pairs = stabilise(forecast_test_span(split, chosen))
    metrics = forecast_metrics(pairs, ["key"])
    future = future_forecast(series, chosen, horizon)
    return ForecastRun(
        candidates=candidates,
        orders=chosen,
        pairs=pairs,
        metrics=metrics,
        published=publish_forecast(future, chosen, metrics, generated_at),
        summary=run_summary(split, chosen, metrics, horizon),
    )
