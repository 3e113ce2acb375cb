"""Write raw and aggregated series, CSV exports and wide prediction tables."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seriesloom.operators.returns import monthly_returns


def require_rows(df: DataFrame, what: str) -> DataFrame:
    """Stop with an error on an empty input."""
    if df.isEmpty():
        raise ValueError(f"no data available: {what}")
    return df


def has_rows(df: DataFrame) -> bool:
    """For jobs that skip an empty input."""
    return not df.isEmpty()


def write_raw_and_agg(
    bars: DataFrame, raw_path: str, agg_path: str, key: str = "ticker"
) -> None:
    """Write daily bars and their monthly returns.

    The raw write is the shared intermediate: the returns are computed from the
    stored, column-pruned bars, so the upstream plan runs once. Rows of a series
    are spread by month so that one large series is written by many tasks.
    """
    month = F.trunc("d", "month")
    bars.repartition(key, month).write.mode("overwrite").partitionBy(key).parquet(
        raw_path
    )
    stored = bars.sparkSession.read.schema(bars.schema).parquet(raw_path)
    monthly_returns(stored).write.mode("overwrite").parquet(agg_path)


def snapshot_path(folder: str, ticker: str, at: datetime) -> str:
    """``<folder>/<ticker>_<UTC stamp>.csv``"""
    return f"{folder.rstrip('/')}/{ticker.lower()}_{at:%Y%m%dT%H%M%SZ}.csv"


def write_csv(df: DataFrame, path: str) -> None:
    """CSV with a header; the time index is an ordinary column."""
    df.write.mode("overwrite").option("header", True).csv(path)


def predictions_wide(
    forecasts: DataFrame, models: Sequence[str], bounds: Sequence[str] = ()
) -> DataFrame:
    """One row per series and date, ``<model>_prediction`` columns, bounds for some models.

    Models are joined by date; a model without a value for a date leaves null.
    """
    aggs = []
    for m in models:
        own = F.col("model") == m
        aggs.append(F.max(F.when(own, F.col("yhat"))).alias(f"{m}_prediction"))
        if m in bounds:
            aggs.append(F.max(F.when(own, F.col("lower"))).alias(f"{m}_lower"))
            aggs.append(F.max(F.when(own, F.col("upper"))).alias(f"{m}_upper"))
    return forecasts.groupBy("ticker", "d").agg(*aggs)
