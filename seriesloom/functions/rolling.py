"""Rolling, lag, momentum and velocity features as window Columns.

``w`` is an ordered WindowSpec (``Laid.w``). Frames that end one row before the
current one cannot see the current value. ``min_periods=None`` asks for full
windows. Every builder returns ``{name: Column}``.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Sequence

import numpy as np
from pyspark.sql import Column, WindowSpec
from pyspark.sql import functions as F

LAGS = (1, 2, 3, 5, 10, 20)
MEAN_WINDOWS = (5, 10, 20, 50, 100)
STD_WINDOWS = (5, 10, 20, 50)
STAT_WINDOWS = (5, 10, 20)


def as_windows(ws: int | Iterable[int], start: int) -> list[int]:
    """An int n stands for ``start..n``; anything else is taken as listed."""
    return list(range(start, ws + 1)) if isinstance(ws, int) else list(ws)


def before(w: WindowSpec, size: int) -> WindowSpec:
    return w.rowsBetween(-size, -1)


def trailing(w: WindowSpec, size: int) -> WindowSpec:
    return w.rowsBetween(-(size - 1), 0)


def gated(
    value: Column, x: Column, frame: WindowSpec, size: int, min_periods: int | None
) -> Column:
    """Null unless the frame holds enough non-null values."""
    need = size if min_periods is None else min_periods
    if need <= 1:
        return value
    return F.when(F.count(x).over(frame) >= need, value)


def lags(
    x: Column, ks: int | Iterable[int], w: WindowSpec, prefix: str = "lag"
) -> dict[str, Column]:
    return {f"{prefix}_{k}": F.lag(x, k).over(w) for k in as_windows(ks, 1)}


def rolling_mean(
    x: Column,
    ws: int | Iterable[int],
    w: WindowSpec,
    min_periods: int | None = 1,
    prefix: str = "ma",
) -> dict[str, Column]:
    return {
        f"{prefix}_{n}": gated(
            F.avg(x).over(before(w, n)), x, before(w, n), n, min_periods
        )
        for n in as_windows(ws, 2)
    }


def rolling_std(
    x: Column,
    ws: int | Iterable[int],
    w: WindowSpec,
    min_periods: int | None = 1,
    prefix: str = "std",
) -> dict[str, Column]:
    """Sample standard deviation; a frame with one value gives null."""
    return {
        f"{prefix}_{n}": gated(
            F.stddev_samp(x).over(before(w, n)), x, before(w, n), n, min_periods
        )
        for n in as_windows(ws, 2)
    }


def _skew(x: Column, f: WindowSpec) -> Column:
    # Spark's skewness is the population one and null on a constant frame.
    n = F.count(x).over(f).cast("double")
    adjusted = F.skewness(x).over(f) * F.sqrt(n * (n - 1)) / F.nullif(n - 2, F.lit(0.0))
    return F.when(n >= 3, F.coalesce(adjusted, F.lit(0.0)))


def _kurt(x: Column, f: WindowSpec) -> Column:
    n = F.count(x).over(f).cast("double")
    scale = (n - 1) / F.nullif((n - 2) * (n - 3), F.lit(0.0))
    adjusted = ((n + 1) * F.kurtosis(x).over(f) + 6) * scale
    return F.when(n >= 4, F.coalesce(adjusted, F.lit(-3.0)))


def interpolated(ordered: Column, n: int, q: float) -> Column:
    """Linear-interpolated quantile of a sorted array known to hold n values."""
    at = q * (n - 1)
    lo = math.floor(at)
    part = at - lo
    low = F.get(ordered, F.lit(lo))
    if part == 0:
        return low
    return low + (F.get(ordered, F.lit(lo + 1)) - low) * F.lit(part)


def rolling_stats(
    x: Column,
    ws: int | Iterable[int],
    w: WindowSpec,
    stats: Sequence[str] = ("min", "max", "skew", "kurt"),
    min_periods: int | None = 1,
    prefix: str = "roll",
) -> dict[str, Column]:
    """``stats`` from min, max, skew, kurt, median, q25, q75.

    The three quantiles of one window are read from a single sorted frame array,
    so they need full windows.
    """
    quantiles = {"q25": 0.25, "median": 0.5, "q75": 0.75}
    if min_periods is not None and any(s in quantiles for s in stats):
        raise ValueError("rolling quantiles need full windows (min_periods=None)")
    out: dict[str, Column] = {}
    for n in as_windows(ws, 2):
        f = before(w, n)
        ordered = F.sort_array(F.collect_list(x).over(f))
        for s in stats:
            if s == "min":
                value = F.min(x).over(f)
            elif s == "max":
                value = F.max(x).over(f)
            elif s == "skew":
                value = _skew(x, f)
            elif s == "kurt":
                value = _kurt(x, f)
            elif s in quantiles:
                value = interpolated(ordered, n, quantiles[s])
            else:
                raise ValueError(f"unknown rolling statistic: {s}")
            out[f"{prefix}_{s}_{n}"] = gated(value, x, f, n, min_periods)
    return out


def ma_cross(
    x: Column,
    shorts: Iterable[int] = (5, 10),
    longs: Iterable[int] = (20, 50),
    w: WindowSpec | None = None,
) -> dict[str, Column]:
    """Difference and ratio of a short and a long full-window mean."""
    out: dict[str, Column] = {}
    for s in shorts:
        for n in longs:
            if s >= n:
                continue
            a = gated(F.avg(x).over(before(w, s)), x, before(w, s), s, None)
            b = gated(F.avg(x).over(before(w, n)), x, before(w, n), n, None)
            out[f"ma_diff_{s}_{n}"] = a - b
            out[f"ma_ratio_{s}_{n}"] = F.try_divide(a, b)
    return out


def trailing_mean(x: Column, size: int, w: WindowSpec) -> Column:
    """Full-window mean that includes the current row."""
    f = trailing(w, size)
    return gated(F.avg(x).over(f), x, f, size, None)


def relative_change(x: Column, k: int, w: WindowSpec) -> Column:
    return F.try_divide(x, F.lag(x, k).over(w)) - 1


def momentum(
    x: Column,
    ws: Iterable[int],
    w: WindowSpec,
    absolute: bool = False,
    padded: Column | None = None,
    prefix: str = "momentum",
) -> dict[str, Column]:
    """Relative change over k rows (current row included), optionally the change in points.

    ``padded`` is the forward-filled value to use for the relative change.
    """
    out: dict[str, Column] = {}
    for k in ws:
        out[f"{prefix}_{k}"] = relative_change(x if padded is None else padded, k, w)
        if absolute:
            out[f"{prefix}_abs_{k}"] = x - F.lag(x, k).over(w)
    return out


def endpoint_slope_weights(n: int) -> list[float]:
    """Weights (oldest first) giving the end-point derivative of a quadratic fit."""
    basis = np.vander(np.arange(n, dtype=float), 3)
    fit = np.linalg.pinv(basis)
    return list(2.0 * (n - 1) * fit[0] + fit[1])


def velocity(
    x: Column,
    ws: Iterable[int],
    w: WindowSpec,
    method: str = "diff",
    pos: Column | None = None,
) -> dict[str, Column]:
    """Speed of change over the last n rows, current row included.

    diff, log and pct compare with the value n rows back; slope, quadratic and
    logslope fit the last n values and are null for the first n rows (``pos`` is
    the 1-based row number). For pct pass the forward-filled value as ``x``.
    """
    out: dict[str, Column] = {}
    for n in ws:
        f = trailing(w, n)
        back = F.lag(x, n).over(w)
        if method == "diff":
            out[f"velocidad_{n}"] = (x - back) / n
        elif method == "log":
            positive = (x > 0) & (back > 0)
            out[f"velocidad_log_{n}"] = F.when(positive, (F.ln(x) - F.ln(back)) / n)
        elif method == "pct":
            out[f"velocidad_pct_{n}"] = relative_change(x, n, w) / n
        elif method in ("slope", "quadratic", "logslope"):
            ready = (pos > n) & (F.count(x).over(f) == n)
            if method == "slope":
                fit = F.regr_slope(x, pos.cast("double")).over(f)
                out[f"velocidad_lineal_{n}"] = F.when(ready, fit)
            elif method == "logslope":
                logs = F.when(x > 0, F.ln(x))
                fit = F.regr_slope(logs, pos.cast("double")).over(f)
                out[f"velocidad_log_{n}"] = F.when(
                    ready & (F.min(x).over(f) > 0), fit
                )
            else:
                terms = [
                    F.lag(x, n - 1 - i).over(w) * F.lit(float(c))
                    for i, c in enumerate(endpoint_slope_weights(n))
                ]
                total = terms[0]
                for t in terms[1:]:
                    total = total + t
                out[f"velocidad_polinomial_{n}"] = F.when(ready, total)
        else:
            raise ValueError(f"unknown velocity method: {method}")
    return out
