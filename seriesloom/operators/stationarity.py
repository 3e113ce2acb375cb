"""Augmented Dickey-Fuller test (constant, lag count by AIC) and differencing on its verdict."""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from seriesloom.operators.filters import between_ts
from seriesloom.plans.gram import Fit, full_matrix, gram, per_series
from seriesloom.plans.groupstats import attach
from seriesloom.plans.layout import POS, Layout, lay_out
from seriesloom.session import cut_lineage

# Fixed values (MacKinnon 1994, 2010; constant, one series): critical value
# polynomials in 1/T by significance level.
CRITICAL = {
    "crit_1": (-3.43035, -6.5393, -16.786, -79.433),
    "crit_5": (-2.86154, -2.8903, -4.234, -40.040),
    "crit_10": (-2.56677, -1.5384, -2.809),
}
# Polynomials in the statistic whose normal probability is the p-value,
# below and above the switch point, and the range outside which it is 0 or 1.
P_SMALL = (2.1659, 1.4412, 0.038269)
P_LARGE = (1.7339, 0.93202, -0.12745, -0.010368)
P_SWITCH, P_MIN, P_MAX = -1.61, -18.83, 2.74
STATIONARY_AT = 0.05


def adf_pvalue(stat: float) -> float:
    if stat > P_MAX:
        return 1.0
    if stat < P_MIN:
        return 0.0
    coef = P_SMALL if stat <= P_SWITCH else P_LARGE
    z = sum(c * stat**i for i, c in enumerate(coef))
    return 0.5 * math.erfc(-z / math.sqrt(2))


def default_max_lag(n: int) -> int:
    return max(min(n // 2 - 2, math.ceil(12.0 * (n / 100.0) ** 0.25)), 0)


def _solve_adf(key: str, width: int):
    """Columns of the Gram matrix: 1, level, lagged differences 1..width, difference."""
    dep = width + 2

    def solve(row: dict) -> list[dict]:
        top = int(row["max_lag"])
        blank = {key: row[key], "n_rows": int(row["n"])}
        if row["g"] is None or top < 0:
            return [blank]
        m = full_matrix(row["g"], width + 3)
        n = m[0, 0]
        if n < top + 4 or m[dep, dep] <= 0:
            return [blank]
        best = min(
            (Fit(m, range(p + 2), dep, n).aic(), p) for p in range(top + 1)
        )[1]
        # The final regression also uses the rows the shorter lag count frees.
        x = np.asarray(row["head"], dtype=float)[: top + 1]
        x = (x - row["__m"]) / (row["__s"] or 1.0)
        d = np.diff(x)
        for t in range(best + 1, min(top, len(x) - 1) + 1):
            v = np.zeros(width + 3)
            v[0], v[1], v[dep] = 1.0, x[t - 1], d[t - 1]
            v[2 : 2 + best] = d[t - 1 - best : t - 1][::-1]
            m = m + np.outer(v, v)
        n = m[0, 0]
        fit = Fit(m, range(best + 2), dep, n)
        if not fit.errors[1] > 0:
            return [blank]
        stat = float(fit.beta[1] / fit.errors[1])
        p = adf_pvalue(stat)
        out = blank | {
            "statistic": stat,
            "p_value": p,
            "used_lag": best,
            "n_obs": int(n),
            "stationary": bool(p <= STATIONARY_AT),
        }
        for name, coef in CRITICAL.items():
            out[name] = sum(c / n**i for i, c in enumerate(coef))
        return [out]

    return solve


def adf_test(
    df: DataFrame,
    max_lag: int | None = None,
    value: str = "close",
    layout: Layout = Layout(),
) -> DataFrame:
    """One row per series: statistic, p-value, lags used, critical values, verdict.

    One windowed pass builds the lagged differences, partial Gram sums reduce them,
    and the lag search works on sub-matrices. When ``max_lag`` is not given the
    widest search any series needs follows from the longest series (one count).
    """
    key = layout.key
    x = df.select(key, layout.ts, F.col(value).cast("double").alias("__x")).where(
        F.col("__x").isNotNull()
    )
    stats = x.groupBy(key).agg(
        F.count("__x").alias("n"),
        F.avg("__x").alias("__m"),
        F.stddev_samp("__x").alias("__s"),
    )
    if max_lag is None:
        longest = stats.agg(F.max("n")).first()[0] or 0
        width = default_max_lag(longest)
        rule = F.ceil(12.0 * F.pow(F.col("n") / 100.0, F.lit(0.25)))
    else:
        width = max_lag
        rule = F.lit(max_lag)
    room = F.floor(F.col("n") / 2) - 2
    stats = stats.withColumn("max_lag", F.least(rule, room).cast("int"))
    scale = F.when(F.col("__s") > 0, F.col("__s")).otherwise(F.lit(1.0))
    z = attach(x, stats, [key]).withColumn(
        "__z", (F.col("__x") - F.col("__m")) / scale
    )
    laid = lay_out(
        z.select(key, layout.ts, "__z", "max_lag"), layout, back=width + 1
    )
    back = [F.col("__z")] + [F.lag("__z", i).over(laid.w) for i in range(1, width + 2)]
    laid = laid.with_columns({f"__z{i}": c for i, c in enumerate(back)})
    rows = laid.close(keep_pos=True)

    def diff(i: int):
        # Lags a short series does not search are absent in its first rows.
        return F.col(f"__z{i}") - F.col(f"__z{i + 1}")

    cols = {"__1": F.lit(1.0), "__level": F.col("__z1")}
    for j in range(1, width + 1):
        cols[f"__d{j}"] = F.when(F.lit(j) <= F.col("max_lag"), diff(j)).otherwise(0.0)
    cols["__dep"] = diff(0)
    design = rows.where(F.col(POS) > F.col("max_lag")).select(
        key, *(c.alias(n) for n, c in cols.items())
    )
    sums = gram(design, key, list(cols))
    # First values of each series; the limit is applied before the shuffle.
    first = Window.partitionBy(key).orderBy(layout.ts)
    heads = (
        x.withColumn("__rn", F.row_number().over(first))
        .where(F.col("__rn") <= width + 1)
        .groupBy(key)
        .agg(F.array_sort(F.collect_list(F.struct("__rn", "__x"))).alias("__h"))
        .select(key, F.transform("__h", lambda e: e["__x"]).alias("head"))
    )
    joined = stats.join(sums, key, "left").join(heads, key, "left")
    schema = (
        f"{key} string, n_rows bigint, statistic double, p_value double, used_lag int,"
        " n_obs bigint, crit_1 double, crit_5 double, crit_10 double, stationary boolean"
    )
    return per_series(joined, _solve_adf(key, width), schema)


def stationarize(
    df: DataFrame,
    start: str | None = None,
    value: str = "close",
    layout: Layout = Layout(),
    max_lag: int | None = None,
) -> DataFrame:
    """First difference of the series the test does not call stationary, the others unchanged.

    Adds ``x`` and the flag ``differenced``; rows without a difference are dropped.
    """
    if start is not None:
        df = between_ts(df, start, None, layout.ts)
    return _differenced(df, adf_test(df, max_lag, value, layout), value, layout)


def stationarity_report(
    df: DataFrame,
    start: str | None = None,
    value: str = "close",
    layout: Layout = Layout(),
    max_lag: int | None = None,
) -> DataFrame:
    """One row per series: the test of the values and, where they were differenced, of the result.

    ``ready`` tells whether the input that ``stationarize`` makes is stationary. The second test
    reads only the series that failed the first one.
    """
    if start is not None:
        df = between_ts(df, start, None, layout.ts)
    key = layout.key
    first = cut_lineage(adf_test(df, max_lag, value, layout))
    failed = first.where(~F.coalesce("stationary", F.lit(False))).select(key)
    changed = _differenced(df.join(failed, key, "left_semi"), first, value, layout)
    second = adf_test(changed, max_lag, "x", layout)
    of = ("statistic", "p_value", "used_lag", "n_obs", "stationary")
    again = second.select(key, *(F.col(c).alias(f"{c}_diff") for c in of))
    return first.select(key, *of).join(again, key, "left").withColumns(
        {
            "differenced": ~F.coalesce("stationary", F.lit(False)),
            "ready": F.coalesce("stationary", F.lit(False))
            | F.coalesce("stationary_diff", F.lit(False)),
        }
    )


def _differenced(df: DataFrame, tests: DataFrame, value: str, layout: Layout) -> DataFrame:
    verdict = tests.select(
        layout.key, F.coalesce("stationary", F.lit(False)).alias("__ok")
    )
    laid = lay_out(df, layout, back=1)
    diffs = laid.with_columns(
        {"__diff": F.col(value) - F.lag(value, 1).over(laid.w)}
    ).close()
    flagged = attach(diffs, verdict, [layout.key])
    out = flagged.withColumns(
        {
            "x": F.when(F.col("__ok"), F.col(value)).otherwise(F.col("__diff")),
            "differenced": ~F.col("__ok"),
        }
    )
    return out.where(F.col("x").isNotNull()).drop("__ok", "__diff")
