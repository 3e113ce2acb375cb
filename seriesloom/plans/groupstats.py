"""Attach per-series statistics to rows without gathering a hot series in one task."""

from __future__ import annotations

from pyspark.sql import DataFrame


def attach(df: DataFrame, stats: DataFrame, on: list[str], *, how: str = "left") -> DataFrame:
    """Join one-row-per-group ``stats`` to ``df``.

    Spark broadcasts ``stats`` when it measures that they are small; otherwise the adaptive
    skew join splits a partition that a hot group fills, at the cost of reading that group's
    single statistics row once per part. Nothing is copied per salt, so the broadcast table
    is as large as measured.
    """
    return df.join(stats, on, how)
