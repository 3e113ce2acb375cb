"""Additive model: piecewise-linear trend, weekly and yearly waves, event effects.

The design is a list of Spark expressions of the date, the fit a penalised least
squares on one Gram matrix per series, the forecast the same expressions times
the coefficients. Changes of the trend have a Laplace prior, so most of them are zero;
waves and events have normal priors. Intervals hold the noise and the changes that the
trend may yet make: as often as the model allows for in training, as large as those found.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seriesloom.operators.autocorr import Z95
from seriesloom.operators.calendars import future_calendar
from seriesloom.operators.joins import Event, in_event
from seriesloom.plans.gram import Fit, full_matrix, gram, per_series
from seriesloom.plans.groupstats import attach
from seriesloom.plans.layout import Layout
from seriesloom.session import cut_lineage

TWO_PI = 2.0 * math.pi
WEEK, YEAR = 7.0, 365.25


@dataclass(frozen=True)
class AdditiveConfig:
    """Shape of the model and the prior scales of its effects."""

    weekly: int = 3
    yearly: int = 10
    changepoints: int = 25
    changepoint_range: float = 0.8
    changepoint_scale: float = 0.05
    seasonality_scale: float = 10.0
    event_scale: float = 10.0
    events: tuple[Event, ...] = ()

    def names(self) -> list[str]:
        out = ["1", "t"]
        out += [f"hinge_{j}" for j in range(1, self.changepoints + 1)]
        for label, order in (("week", self.weekly), ("year", self.yearly)):
            for k in range(1, order + 1):
                out += [f"{label}_sin_{k}", f"{label}_cos_{k}"]
        return out + [f"event_{i}" for i in range(1, len(self.events) + 1)]

    def prior_precision(self) -> np.ndarray:
        waves = 2 * (self.weekly + self.yearly)
        return np.array(
            [0.0, 0.0]
            + [0.0] * self.changepoints
            + [self.seasonality_scale**-2] * waves
            + [self.event_scale**-2] * len(self.events)
        )


def sparse_changes(
    m: np.ndarray, penalty: np.ndarray, hinges: slice, weight: float, sweeps: int = 5000
) -> np.ndarray:
    """Minimiser of b'Ab/2 - c'b + sum(penalty * b^2)/2 + weight * sum |b| over the hinges.

    ``m`` is the Gram matrix with the target last. All other coefficients are eliminated, so
    coordinates are descended over the hinges alone; the signs found then give the solution
    of a linear system, which is kept if it has these signs.
    """
    k = len(penalty)
    a, c = m[:k, :k] + np.diag(penalty), m[:k, k]
    h = np.arange(k)[hinges]
    r = np.setdiff1d(np.arange(k), h)
    inner = np.linalg.pinv(a[np.ix_(r, r)], hermitian=True)
    cross = a[np.ix_(r, h)]
    s = a[np.ix_(h, h)] - cross.T @ inner @ cross
    q = c[h] - cross.T @ inner @ c[r]
    x, slope, diagonal = np.zeros(len(h)), q.copy(), np.diag(s)
    for _ in range(sweeps):
        moved = 0.0
        for j in np.flatnonzero(diagonal > 1e-12):
            at = slope[j] + diagonal[j] * x[j]
            new = np.sign(at) * max(abs(at) - weight, 0.0) / diagonal[j]
            if new != x[j]:
                slope -= s[:, j] * (new - x[j])
                moved = max(moved, abs(new - x[j]))
                x[j] = new
        if moved <= 1e-10:
            break
    on = np.flatnonzero(x)
    if len(on):
        exact = np.linalg.lstsq(s[np.ix_(on, on)], q[on] - weight * np.sign(x[on]), rcond=None)[0]
        if (np.sign(exact) == np.sign(x[on])).all():
            x[on] = exact
    beta = np.zeros(k)
    beta[h], beta[r] = x, inner @ (c[r] - cross @ x)
    return beta


def design(cfg: AdditiveConfig, d: Column, t0: Column, t1: Column) -> dict[str, Column]:
    """Design columns of a date; ``t0, t1`` are the first and last training day."""
    day = F.datediff(d, F.lit("1970-01-01").cast("date")).cast("double")
    span = F.nullif(F.datediff(t1, t0), F.lit(0))
    t = F.coalesce(F.try_divide(F.datediff(d, t0), span), F.lit(0.0))
    out = {"1": F.lit(1.0), "t": t}
    for j in range(1, cfg.changepoints + 1):
        at = cfg.changepoint_range * j / (cfg.changepoints + 1)
        out[f"hinge_{j}"] = F.greatest(t - F.lit(at), F.lit(0.0))
    for label, order, period in (("week", cfg.weekly, WEEK), ("year", cfg.yearly, YEAR)):
        for k in range(1, order + 1):
            angle = day * F.lit(TWO_PI * k / period)
            out[f"{label}_sin_{k}"] = F.sin(angle)
            out[f"{label}_cos_{k}"] = F.cos(angle)
    for i, e in enumerate(cfg.events, 1):
        out[f"event_{i}"] = in_event(d, e).cast("double")
    return out


def additive_fit(
    df: DataFrame,
    cfg: AdditiveConfig = AdditiveConfig(),
    value: str = "close",
    layout: Layout = Layout(),
) -> DataFrame:
    """Coefficients per series, with the time span and scale they refer to.

    The fit is computed here and its (small) table stored.
    """
    key = layout.key
    x = df.select(
        key,
        F.col(layout.ts).cast("date").alias("__d"),
        F.col(value).cast("double").alias("__x"),
    ).where(F.col("__x").isNotNull())
    top = F.max(F.abs("__x"))
    stats = x.groupBy(key).agg(
        F.min("__d").alias("t0"),
        F.max("__d").alias("t1"),
        F.when(top > 0, top).otherwise(F.lit(1.0)).alias("scale"),
    )
    rows = attach(x, stats, [key])
    cols = design(cfg, F.col("__d"), F.col("t0"), F.col("t1"))
    wide = rows.select(
        key,
        *(c.alias(f"__{n}") for n, c in cols.items()),
        (F.col("__x") / F.col("scale")).alias("__y"),
    )
    names = [f"__{n}" for n in cols]
    k = len(names)
    prior = cfg.prior_precision()

    def solve(row: dict) -> list[dict]:
        m = full_matrix(row["g"], k + 1)
        n = m[0, 0]
        # Noise from a weakly penalised fit turns prior scales into penalties.
        noise = Fit(m, range(k), k, n, np.full(k, 1e-8)).sigma2
        hinges = slice(2, 2 + cfg.changepoints)
        beta = sparse_changes(m, prior * noise + 1e-8, hinges, noise / cfg.changepoint_scale)
        ssr = max(m[k, k] - 2 * beta @ m[:k, k] + beta @ m[:k, :k] @ beta, 0.0)
        square = float((beta[hinges] ** 2).mean()) if cfg.changepoints else 0.0
        return [
            {
                key: row[key],
                "t0": row["t0"],
                "t1": row["t1"],
                "coef": (beta * row["scale"]).tolist(),
                "sigma": math.sqrt(ssr / max(n - 1, 1)) * row["scale"],
                "n_obs": int(n),
                # Variance of the slope's changes in one unit of time, at the places' rate.
                "drift": cfg.changepoints / cfg.changepoint_range * square * row["scale"] ** 2,
            }
        ]

    joined = gram(wide, key, [*names, "__y"]).join(stats, key)
    fits = per_series(
        joined,
        solve,
        f"{key} string, t0 date, t1 date, coef array<double>, sigma double, n_obs bigint,"
        " drift double",
    )
    return cut_lineage(fits)


def additive_score(
    fit: DataFrame,
    dates: DataFrame,
    cfg: AdditiveConfig = AdditiveConfig(),
    key: str = "ticker",
    ts: str = "d",
) -> DataFrame:
    """``yhat, lower, upper`` for given dates, all in Spark expressions.

    Behind the training days the interval widens by the changes the trend may make there,
    and by those it may have made in the last part of training, where the model has no place
    for them. As a Poisson process they give a level u units on the variance
    drift * (u^3 / 3 + part * u^2).
    """
    rows = attach(dates, fit.select(key, "t0", "t1", "coef", "sigma", "drift"), [key], how="inner")
    cols = design(cfg, F.col(ts).cast("date"), F.col("t0"), F.col("t1"))
    yhat = F.lit(0.0)
    for i, c in enumerate(cols.values()):
        yhat = yhat + F.get("coef", F.lit(i)) * c
    span = F.nullif(F.datediff("t1", "t0"), F.lit(0))
    ahead = F.greatest(F.coalesce(F.try_divide(F.datediff(F.col(ts).cast("date"), "t1"), span), F.lit(0.0)), F.lit(0.0))
    spread = Z95 * F.sqrt(F.col("sigma") * F.col("sigma") + F.col("drift") * (ahead / 3 + F.lit(1 - cfg.changepoint_range)) * ahead * ahead)
    return rows.withColumns({"yhat": yhat, "__spread": spread}).select(
        *dates.columns,
        "yhat",
        (F.col("yhat") - F.col("__spread")).alias("lower"),
        (F.col("yhat") + F.col("__spread")).alias("upper"),
    )


def additive_forecast(
    fit: DataFrame,
    periods: int = 30,
    freq: str = "D",
    history: DataFrame | None = None,
    cfg: AdditiveConfig = AdditiveConfig(),
    key: str = "ticker",
    model: str = "additive",
) -> DataFrame:
    """Forecast the dates after each series' last day; ``history`` dates are scored as step 0."""
    ahead = future_calendar(fit.select(key, F.col("t1").alias("d")), periods, freq, key)
    if history is not None:
        past = history.select(key, F.lit(0).alias("step"), F.col("d").cast("date").alias("d"))
        ahead = past.unionByName(ahead)
    scored = additive_score(fit, ahead, cfg, key)
    return scored.select(
        key, F.lit(model).alias("model"), "step", "d", "yhat", "lower", "upper"
    )


def named_coefficients(fit: DataFrame, cfg: AdditiveConfig, key: str = "ticker") -> DataFrame:
    """One row per series and effect."""
    labels = F.array(*(F.lit(n) for n in cfg.names()))
    return fit.select(
        key, F.posexplode("coef").alias("i", "coef")
    ).select(key, F.get(labels, F.col("i")).alias("effect"), "coef")


def events_of(pairs: Sequence[Event]) -> tuple[Event, ...]:
    return tuple(p if isinstance(p, str) else tuple(p) for p in pairs)
