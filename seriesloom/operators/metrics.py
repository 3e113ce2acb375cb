"""Forecast accuracy and ensembles."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seriesloom.plans.groupstats import attach


def forecast_metrics(
    df: DataFrame, y: str, yhat: str, by: Sequence[str] = ("ticker", "model")
) -> DataFrame:
    """MAE, MSE, RMSE and MAPE (percent) per group; rows without a prediction are skipped."""
    known = df.where(F.col(y).isNotNull() & F.col(yhat).isNotNull())
    err = F.col(y) - F.col(yhat)
    return known.groupBy(*by).agg(
        F.avg(F.abs(err)).alias("mae"),
        F.avg(err * err).alias("mse"),
        F.sqrt(F.avg(err * err)).alias("rmse"),
        (F.avg(F.abs(F.try_divide(err, F.col(y)))) * 100).alias("mape"),
    )


def ensemble(
    forecasts: DataFrame,
    method: str = "mean",
    weights: Mapping[str, float] | None = None,
    key: str = "ticker",
) -> DataFrame:
    """Combine all models step by step, cut to the model with the fewest steps.

    ``weighted`` gives a model without a weight 1.0 and normalises; an unknown
    method, or ``weighted`` without weights, is the mean.
    """
    yhat = F.col("yhat")
    if method == "weighted" and weights:
        weight = F.lit(1.0)
        for model, value in weights.items():
            weight = F.when(F.col("model") == model, F.lit(float(value))).otherwise(weight)
        combined = F.try_divide(F.sum(weight * yhat), F.sum(weight))
    elif method == "median":
        combined = F.percentile(yhat, F.lit(0.5))
    else:
        combined = F.avg(yhat)
    # Steps run 1..n per model, so the shortest model has the smallest last step.
    lengths = forecasts.groupBy(key, "model").agg(F.max("step").alias("__len"))
    shortest = lengths.groupBy(key).agg(F.min("__len").alias("__len"))
    steps = forecasts.groupBy(key, "step").agg(combined.alias("yhat"))
    return (
        attach(steps, shortest, [key])
        .where(F.col("step") <= F.col("__len"))
        .drop("__len")
    )
