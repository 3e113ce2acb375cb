"""Daily bars from raw ticks, and the trailing period of a history."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seriesloom.plans.groupstats import attach


def ohlcv_bars(
    ticks: DataFrame, key: str, ts: str, price: str, order: str
) -> DataFrame:
    """One open/high/low/close/volume row per series and day.

    One map-side combined aggregate, so a busy series is reduced before the
    shuffle. ``order`` must be unique within a day.
    """
    return ticks.groupBy(
        F.col(key).alias("ticker"), F.col(ts).cast("date").alias("d")
    ).agg(
        F.min_by(price, order).alias("open"),
        F.max(price).alias("high"),
        F.min(price).alias("low"),
        F.max_by(price, order).alias("close"),
        F.count(F.lit(1)).alias("volume"),
    )


def period_start(last: Column, period: str) -> Column:
    """First day of a trailing period such as ``5d``, ``6mo`` or ``1y`` ending at ``last``."""
    match = re.fullmatch(r"(\d+)(d|mo|y)", period)
    if not match:
        raise ValueError(f"unknown period: {period}")
    n, unit = int(match.group(1)), match.group(2)
    if unit == "d":
        return F.date_sub(last, n)
    return F.add_months(last, -n * (12 if unit == "y" else 1))


def trailing_period(
    df: DataFrame, period: str, key: str = "ticker", ts: str = "d"
) -> DataFrame:
    """Rows of each series within ``period`` of its last day; ``max`` keeps everything."""
    if period == "max":
        return df
    last = df.groupBy(key).agg(F.max(F.col(ts).cast("date")).alias("__last"))
    start = period_start(F.col("__last"), period)
    return (
        attach(df, last, [key])
        .where(F.col(ts).cast("date") >= start)
        .drop("__last")
    )
