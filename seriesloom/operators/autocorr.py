"""Autocorrelation, partial autocorrelation and the suggested autoregressive order."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seriesloom.plans.gram import per_series
from seriesloom.plans.groupstats import attach
from seriesloom.plans.layout import Layout, lay_out

# Fixed value: two-sided 95% point of the normal distribution.
Z95 = 1.959963984540054


def autocovariances(
    df: DataFrame, k: int, value: str = "close", layout: Layout = Layout()
) -> DataFrame:
    """``n`` and ``acov``: lagged product sums of the centred series for lags 0..k.

    All lags come from one windowed pass and one aggregate with map-side sums.
    """
    x = df.select(layout.key, layout.ts, F.col(value).cast("double").alias("__x"))
    means = x.groupBy(layout.key).agg(F.avg("__x").alias("__m"))
    centred = attach(x, means, [layout.key]).withColumn(
        "__c", F.col("__x") - F.col("__m")
    )
    laid = lay_out(centred.drop("__x", "__m"), layout, back=k)
    cols = {
        f"__p{i}": F.col("__c") * (F.lag("__c", i).over(laid.w) if i else F.col("__c"))
        for i in range(k + 1)
    }
    products = laid.with_columns(cols).close()
    sums = products.groupBy(layout.key).agg(
        F.count("__c").alias("n"), *(F.sum(c).alias(c) for c in cols)
    )
    return sums.select(layout.key, "n", F.array(*cols).alias("acov"))


def acf(
    df: DataFrame, k: int = 20, value: str = "close", layout: Layout = Layout()
) -> DataFrame:
    """One row per series and lag with the +-1.96/sqrt(n) band."""
    cov = autocovariances(df, k, value, layout)
    return cov.select(
        layout.key, "n", F.posexplode("acov").alias("lag", "__s"), F.get("acov", F.lit(0)).alias("__0")
    ).select(
        layout.key,
        "lag",
        F.try_divide(F.col("__s"), F.col("__0")).alias("acf"),
        (F.lit(Z95) / F.sqrt(F.col("n"))).alias("band"),
    )


def levinson(r: np.ndarray) -> np.ndarray:
    """Partial autocorrelations from autocorrelations (lag 0 first)."""
    out = np.full(len(r), np.nan)
    out[0] = 1.0
    coef = np.zeros(0)
    error = r[0]
    for k in range(1, len(r)):
        if not error > 0:
            break
        step = (r[k] - coef @ r[k - 1 : 0 : -1]) / error if k > 1 else r[1] / error
        coef = np.append(coef - step * coef[::-1], step)
        error *= 1.0 - step * step
        out[k] = step
    return out


def pacf(
    df: DataFrame,
    k: int = 20,
    value: str = "close",
    layout: Layout = Layout(),
    adjusted: bool = False,
) -> DataFrame:
    """Yule-Walker partial autocorrelations with the +-1.96/sqrt(n) band.

    ``adjusted`` divides the lag-j covariance by n - j instead of n. Only k + 1
    sums per series reach Python.
    """
    key = layout.key

    def solve(row: dict) -> list[dict]:
        n, s = row["n"], np.asarray(row["acov"], dtype=float)
        lags = np.arange(len(s))
        r = s / np.maximum(n - lags, 1) if adjusted else s / n
        values = levinson(r / r[0]) if r[0] > 0 else np.full(len(s), np.nan)
        return [
            {
                key: row[key],
                "lag": int(i),
                "pacf": None if np.isnan(v) else float(v),
                "band": Z95 / np.sqrt(n),
            }
            for i, v in enumerate(values)
        ]

    cov = autocovariances(df, k, value, layout)
    return per_series(cov, solve, f"{key} string, lag int, pacf double, band double")


def suggest_ar_order(
    df: DataFrame, k: int = 20, value: str = "close", layout: Layout = Layout()
) -> DataFrame:
    """Lags outside the band and the largest of them (0 when there is none)."""
    p = pacf(df, k, value, layout, adjusted=True)
    out = (F.col("lag") > 0) & (F.abs("pacf") > F.col("band"))
    return p.groupBy(layout.key).agg(
        F.array_sort(F.collect_list(F.when(out, F.col("lag")))).alias("significant_lags"),
        F.coalesce(F.max(F.when(out, F.col("lag"))), F.lit(0)).alias("ar_order"),
    )
