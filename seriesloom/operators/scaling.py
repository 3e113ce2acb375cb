"""Min/max scaling per series, with its inverse."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seriesloom.plans.groupstats import attach


def fit_minmax(
    df: DataFrame,
    cols: Sequence[str],
    key: str = "ticker",
    fit_on: Column | None = None,
) -> DataFrame:
    """Minimum and maximum of each column per series, one row per series.

    ``fit_on`` restricts the fit, for example to training rows; by default all
    rows take part.
    """
    def part(c: str) -> Column:
        return F.col(c) if fit_on is None else F.when(fit_on, F.col(c))

    return df.groupBy(key).agg(
        *(F.min(part(c)).cast("double").alias(f"__min_{c}") for c in cols),
        *(F.max(part(c)).cast("double").alias(f"__max_{c}") for c in cols),
    )


def _drop(cols: Sequence[str]) -> list[str]:
    return [f"__{s}_{c}" for c in cols for s in ("min", "max")]


def minmax_scale(
    df: DataFrame,
    stats: DataFrame,
    cols: Sequence[str],
    key: str = "ticker",
    ts: str = "d",
    suffix: str = "",
) -> DataFrame:
    """``(x - min) / (max - min)``; a constant column becomes 0."""
    joined = attach(df, stats, [key])
    scaled = {}
    for c in cols:
        lo, hi = F.col(f"__min_{c}"), F.col(f"__max_{c}")
        # A zero range divides by one, which leaves x - min.
        width = F.when(hi == lo, F.lit(1.0)).otherwise(hi - lo)
        scaled[f"{c}{suffix}"] = (F.col(c) - lo) / width
    return joined.withColumns(scaled).drop(*_drop(cols))


def minmax_inverse(
    df: DataFrame,
    stats: DataFrame,
    source: dict[str, str],
    key: str = "ticker",
    ts: str = "d",
) -> DataFrame:
    """Undo the scaling: ``source`` maps each output column to the fitted column."""
    joined = attach(df, stats, [key])
    out = {}
    for name, c in source.items():
        lo, hi = F.col(f"__min_{c}"), F.col(f"__max_{c}")
        width = F.when(hi == lo, F.lit(1.0)).otherwise(hi - lo)
        out[name] = F.col(name) * width + lo
    return joined.withColumns(out).drop(*_drop(list(source.values())))
