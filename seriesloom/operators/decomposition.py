"""Classical seasonal decomposition."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from seriesloom.operators.filters import series_length
from seriesloom.plans.groupstats import attach
from seriesloom.plans.layout import POS, Layout, lay_out


def centred_mean(x: Column, w: WindowSpec, period: int) -> Column:
    """Centred moving mean; an even period gives the two end rows half weight."""
    half = period // 2
    inner = half if period % 2 else half - 1
    f = w.rowsBetween(-inner, inner)
    total = F.sum(x).over(f)
    if period % 2 == 0:
        ends = F.lag(x, half).over(w) + F.lead(x, half).over(w)
        total = total + 0.5 * ends
    whole = F.count(x).over(f) == 2 * inner + 1
    return F.when(whole, total / period)


def decompose(
    df: DataFrame,
    period: int = 252,
    model: str = "additive",
    value: str = "close",
    layout: Layout = Layout(),
    *,
    strict: bool = False,
) -> DataFrame:
    """``trend``, ``seasonal`` and ``resid`` columns.

    The trend is null half a period from either end. The seasonal component is
    the mean of the detrended values at each position modulo the period, centred
    on 0 (or on 1 for ``multiplicative``). A series shorter than two periods gets
    nulls, or an error with ``strict``.
    """
    if model not in ("additive", "multiplicative"):
        raise ValueError(f"unknown decomposition model: {model}")
    additive = model == "additive"
    lengths = series_length(df, layout.key)
    if strict:
        short = lengths.where(F.col("__n") < 2 * period).first()
        if short is not None:
            raise ValueError(f"{short[0]}: fewer than two full periods of {period}")
    half = period // 2
    laid = lay_out(df, layout, back=half, ahead=half)
    x = F.col(value).cast("double")
    trended = laid.with_columns({"trend": centred_mean(x, laid.w, period)}).close(
        keep_pos=True
    )
    rest = x - F.col("trend") if additive else F.try_divide(x, F.col("trend"))
    phased = trended.withColumns(
        {"__phase": F.pmod(F.col(POS), F.lit(period)), "__rest": rest}
    )
    phase = phased.groupBy(layout.key, "__phase").agg(
        F.avg("__rest").alias("__mean"), F.count(F.lit(1)).alias("__rows")
    )
    w = Window.partitionBy(layout.key)
    centre = F.avg("__mean").over(w)
    centred = (
        F.col("__mean") - centre if additive else F.try_divide(F.col("__mean"), centre)
    )
    enough = F.sum("__rows").over(w) >= 2 * period
    seasons = phase.select(
        layout.key,
        "__phase",
        F.when(enough, centred).alias("seasonal"),
        enough.alias("__enough"),
    )
    out = attach(phased, seasons, [layout.key, "__phase"])
    trend = F.when(F.col("__enough"), F.col("trend"))
    resid = (
        x - trend - F.col("seasonal")
        if additive
        else F.try_divide(x, trend * F.col("seasonal"))
    )
    return out.select(*df.columns, trend.alias("trend"), "seasonal", resid.alias("resid"))
