"""Autoregressive moving-average models with differencing, seasonal lags and regressors.

The first estimate is the two-stage regression of Hannan and Rissanen: a long
autoregression gives residuals, then the series is regressed on its own lags and
lagged residuals. Both stages are one pass of Gram sums, so a series of any
length is fitted by all tasks together, and every order of a grid is a sub-matrix
of the same sums. Models with moving averages or seasonal factors are then refined
to conditional least squares, with seasonal factors that multiply (see ``refine``).
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from seriesloom.operators.autocorr import Z95
from seriesloom.operators.calendars import future_calendar
from seriesloom.operators.joins import Event, event_flags
from seriesloom.operators.refine import TASK_ROWS, Shape, refine
from seriesloom.plans.gram import Fit, full_matrix, gram, per_series
from seriesloom.plans.groupstats import attach
from seriesloom.plans.layout import POS, Laid, Layout, bucket_rows, with_positions
from seriesloom.session import cut_lineage

Order = tuple[int, int, int]
Seasonal = tuple[int, int, int, int]
NO_SEASON: Seasonal = (0, 0, 0, 0)


@dataclass(frozen=True)
class Spec:
    """Orders of a model and what follows from them."""

    order: Order
    seasonal: Seasonal = NO_SEASON
    exog: tuple[str, ...] = ()

    @staticmethod
    def _lags(n: int, seasonal: int, s: int) -> list[int]:
        found = {i + s * j for i in range(n + 1) for j in range(seasonal + 1)}
        return sorted(found - {0})

    @property
    def ar(self) -> list[int]:
        return self._lags(self.order[0], self.seasonal[0], self.seasonal[3])

    @property
    def ma(self) -> list[int]:
        return self._lags(self.order[2], self.seasonal[2], self.seasonal[3])

    @property
    def differencing(self) -> np.ndarray:
        """Coefficients of (1-B)^d (1-B^s)^D, lag 0 first."""
        poly = np.array([1.0])
        for _ in range(self.order[1]):
            poly = np.convolve(poly, [1.0, -1.0])
        season = np.zeros(self.seasonal[3] + 1)
        season[0], season[-1] = 1.0, -1.0
        for _ in range(self.seasonal[1]):
            poly = np.convolve(poly, season)
        return poly

    @property
    def constant(self) -> bool:
        return self.order[1] == 0 and self.seasonal[1] == 0

    @property
    def long_lag(self) -> int:
        """Length of the first-stage autoregression."""
        return max([10, *(k + 8 for k in [*self.ar, *self.ma])])


def _dot(names: Sequence[str], coefs: str, start: int) -> Column:
    total = F.lit(0.0)
    for i, n in enumerate(names):
        total = total + F.get(coefs, F.lit(start + i)) * F.col(n)
    return total


def _scaled(df: DataFrame, value: str, exog: Sequence[str], layout: Layout) -> tuple[DataFrame, DataFrame]:
    """Rows with value and regressors, values standardised per series, plus the statistics."""
    x = df.select(
        layout.key,
        layout.ts,
        F.col(value).cast("double").alias("__x"),
        *(F.col(c).cast("double").alias(c) for c in exog),
    ).where(F.col("__x").isNotNull())
    stats = x.groupBy(layout.key).agg(
        F.avg("__x").alias("centre"),
        F.stddev_samp("__x").alias("__s"),
    )
    stats = stats.select(
        layout.key,
        "centre",
        F.when(F.col("__s") > 0, F.col("__s")).otherwise(F.lit(1.0)).alias("scale"),
    )
    rows = attach(x, stats, [layout.key]).withColumn(
        "__x", (F.col("__x") - F.col("centre")) / F.col("scale")
    )
    return rows.drop("centre", "scale"), stats


def _differenced(laid: Laid, cols: Sequence[str], poly: np.ndarray) -> Laid:
    """Replace each column by its differenced value."""
    out = {}
    for c in cols:
        total = F.col(c)
        for lag, w in enumerate(poly):
            if lag and w:
                total = total + F.lit(float(w)) * F.lag(c, lag).over(laid.w)
        out[f"__z_{c}"] = total
    return laid.with_columns(out)


@dataclass(frozen=True)
class Stage:
    """Second-stage rows and what they were made from, all but ``rows`` one row per series."""

    rows: DataFrame
    stats: DataFrame
    coefs: DataFrame
    spec: Spec
    design: DataFrame


def _residual_stage(
    df: DataFrame, spec: Spec, value: str, layout: Layout, keep: int, first_pos: int = 0
) -> Stage:
    """Rows with the differenced series, its lags, first-stage residuals and their lags.

    The first-stage coefficients (one short array per series) are computed and
    stored here, so later uses do not run the first stage again. Second-stage rows
    before position ``first_pos`` are left out.
    """
    key = layout.key
    m = spec.long_lag
    reach = max([0, *spec.ar, *spec.ma])
    d = len(spec.differencing) - 1
    scaled, stats = _scaled(df, value, spec.exog, layout)
    # Three passes read these few columns; what lies below them runs once.
    placed = cut_lineage(with_positions(scaled, layout))
    laid = bucket_rows(placed, layout, back=d + m + reach + 1)
    laid = _differenced(laid, ["__x", *spec.exog], spec.differencing)
    z = "__z___x"
    width = max(m, reach)
    laid = laid.with_columns(
        {f"__z{i}": F.lag(z, i).over(laid.w) for i in range(1, width + 1)}
    )
    exog = [f"__z_{c}" for c in spec.exog]
    first = ["__1", *exog, *(f"__z{i}" for i in range(1, m + 1))]
    design = laid.close().withColumn("__1", F.lit(1.0))

    def solve(row: dict) -> list[dict]:
        k = len(first) + 1
        mat = full_matrix(row["g"], k)
        use = range(0 if spec.constant else 1, k - 1)
        coef = np.zeros(k - 1)
        if mat[0, 0] > len(first) + 2:
            coef[list(use)] = Fit(mat, use, k - 1, mat[0, 0]).beta
        return [{key: row[key], "__coef": coef.tolist()}]

    sums = gram(design, key, [*first, z])
    coefs = cut_lineage(per_series(sums, solve, f"{key} string, __coef array<double>"))
    joined = attach(laid.df, coefs, [key])
    fitted = (
        F.get("__coef", F.lit(0))
        + _dot(exog, "__coef", 1)
        + _dot([f"__z{i}" for i in range(1, m + 1)], "__coef", 1 + len(exog))
    )
    again = Laid(joined.withColumn("__e", F.col(z) - fitted).drop("__coef"), layout)
    again = again.with_columns(
        {f"__e{j}": F.lag("__e", j).over(again.w) for j in range(1, keep + 1)}
    )
    rows = again.where(F.col(POS) >= first_pos).close().withColumn("__1", F.lit(1.0))
    lagged = [f"__z{i}" for i in spec.ar]
    positioned = laid.close(keep_pos=True).select(key, POS, *exog, *lagged, z)
    return Stage(rows, stats, coefs, spec, positioned)


def _tail_rows(df: DataFrame, spec: Spec, value: str, layout: Layout) -> DataFrame:
    """Last values and regressors of each series, oldest first, as arrays.

    The limit per series is applied before the shuffle.
    """
    n = 2 * (len(spec.differencing) + spec.long_lag) + max([1, *spec.ar, *spec.ma])
    w = Window.partitionBy(layout.key).orderBy(F.col(layout.ts).desc())
    near = (
        df.where(F.col(value).isNotNull())
        .withColumn("__rn", F.row_number().over(w))
        .where(F.col("__rn") <= n)
    )
    row = F.struct(
        (-F.col("__rn")).alias("p"),
        F.col(value).cast("double").alias("x"),
        F.array(*(F.col(c).cast("double") for c in spec.exog))
        .cast("array<double>")
        .alias("w"),
    )
    tail = near.groupBy(layout.key).agg(
        F.array_sort(F.collect_list(row)).alias("t"), F.max(layout.ts).alias("last_d")
    )
    return tail.select(
        layout.key,
        "last_d",
        F.transform("t", lambda r: r["x"]).alias("tail_x"),
        F.transform("t", lambda r: r["w"]).alias("tail_w"),
    )


def stable_lags(coefs: np.ndarray, sign: float) -> np.ndarray:
    """Coefficients of ``1 + sign * (c1 B + c2 B^2 + ...)`` with every root outside the unit circle.

    A root inside is reflected, which leaves the autocorrelations of a moving average as
    they are; a root on the circle is moved out by a thousandth.
    """
    poly = np.concatenate([[1.0], sign * np.asarray(coefs, dtype=float)])
    while len(poly) > 1 and abs(poly[-1]) < 1e-12:
        poly = poly[:-1]
    roots = np.roots(poly[::-1])
    if not len(roots) or np.abs(roots).min() > 1.0 + 1e-9:
        return np.asarray(coefs, dtype=float)
    inside = np.abs(roots) <= 1.0 + 1e-9
    moved = np.where(inside, 1 / np.conj(roots), roots)
    moved = np.where(np.abs(moved) < 1.001, moved / np.abs(moved) * 1.001, moved)
    out = np.zeros(len(coefs))
    full = np.real(np.poly(1 / moved))  # product of (1 - B / root)
    out[: len(full) - 1] = sign * full[1:]
    return out


def _apply_poly(v: np.ndarray, poly: np.ndarray) -> np.ndarray:
    """Differenced values; the first ones, which lack history, are NaN."""
    out = np.full(v.shape, np.nan)
    for t in range(len(poly) - 1, len(v)):
        out[t] = sum(c * v[t - lag] for lag, c in enumerate(poly))
    return out


def _tail_state(row: dict, spec: Spec) -> dict:
    """Scaled levels, first-stage residuals and regressors a forecast continues from."""
    x = (np.asarray(row["tail_x"], dtype=float) - row["centre"]) / row["scale"]
    n, ne, m = len(x), len(spec.exog), spec.long_lag
    w = np.array([list(map(float, r)) for r in row["tail_w"]]).reshape(n, ne)
    z, dw = _apply_poly(x, spec.differencing), _apply_poly(w, spec.differencing)
    coef = np.asarray(row["__coef"], dtype=float)
    e = np.zeros(n)
    for t in range(m, n):
        past = z[t - m : t][::-1]
        guess = coef[0] + dw[t] @ coef[1 : 1 + ne] + coef[1 + ne :] @ past
        if np.isfinite(z[t] - guess):
            e[t] = z[t] - guess
    return {"tail_x": x.tolist(), "tail_e": e.tolist(), "tail_w": w.tolist()}


FIT_SCHEMA = (
    "{key} string, p int, d int, q int, seasonal array<int>, const double,"
    " ar array<double>, ma array<double>, exog array<double>, se array<double>,"
    " sigma2 double, n_obs bigint, aic double, bic double, centre double, scale double,"
    " last_d {ts}, tail_x array<double>, tail_e array<double>,"
    " tail_w array<array<double>>, status string"
)


def arima_fit(
    df: DataFrame,
    order: Order = (1, 2, 5),
    value: str = "close",
    layout: Layout = Layout(),
    *,
    seasonal: Seasonal = NO_SEASON,
    exog: Sequence[str] = (),
    task_rows: int = TASK_ROWS,
) -> DataFrame:
    """One fitted model per series, with the state a forecast continues from.

    The fit is computed here and its (small) table stored.
    Coefficients are in the standardised scale of the series (``centre``,
    ``scale``); ``sigma2`` is in the series' own units. Roots of an autoregression that
    would make the model non-stationary are reflected and ``status`` is ``adjusted``.
    With moving averages or a season the estimate is the conditional least squares one
    among stable models. Series longer than ``task_rows`` are refined block by block.
    """
    spec = Spec(tuple(order), tuple(seasonal), tuple(exog))
    key = layout.key
    schema = FIT_SCHEMA.format(key=key, ts=df.schema[layout.ts].dataType.simpleString())
    stage = _residual_stage(df, spec, value, layout, max([0, *spec.ma]))
    cols = [
        "__1",
        *(f"__z_{c}" for c in spec.exog),
        *(f"__z{i}" for i in spec.ar),
        *(f"__e{j}" for j in spec.ma),
        "__z___x",
    ]
    k = len(cols)
    ne, na = len(spec.exog), len(spec.ar)

    def solve(row: dict) -> list[dict]:
        use = list(range(0 if spec.constant else 1, k - 1))
        beta, se = np.zeros(k - 1), np.zeros(k - 1)
        out = {
            key: row[key],
            "p": spec.order[0],
            "d": spec.order[1],
            "q": spec.order[2],
            "seasonal": list(spec.seasonal),
            "centre": row["centre"],
            "scale": row["scale"],
            "last_d": row["last_d"],
            "status": "failed",
        }
        if row["g"] is not None and row["__coef"] is not None:
            m = full_matrix(row["g"], k)
            n = m[0, 0]
            if n > k + 1:
                fit = Fit(m, use, k - 1, n)
                beta[use], se[use] = fit.beta, fit.errors
                # The likelihood refers to the series in its own units.
                jacobian = 2 * n * math.log(row["scale"])
                out |= _tail_state(row, spec) | {
                    "sigma2": fit.ssr / n * row["scale"] ** 2,
                    "n_obs": int(n),
                    "aic": fit.aic(1) + jacobian,
                    "bic": fit.bic(1) + jacobian,
                    "status": "success",
                }
        parts = np.split(beta, [1, 1 + ne, 1 + ne + na])
        if out["status"] == "success":
            for i, lags, sign in ((2, spec.ar, -1.0), (3, spec.ma, 1.0)):
                dense = np.zeros(max([0, *lags]))
                dense[[lag - 1 for lag in lags]] = parts[i]
                better = stable_lags(dense, sign)
                if not np.allclose(better, dense):
                    out["status"] = "unstable" if spec.seasonal[3] else "adjusted"
                    if not spec.seasonal[3]:
                        parts[i] = better
        out |= {
            "const": float(parts[0][0]),
            "exog": parts[1].tolist(),
            "ar": parts[2].tolist(),
            "ma": parts[3].tolist(),
            "se": se.tolist(),
        }
        return [out]

    sums = gram(stage.rows, key, cols)
    joined = (
        stage.stats.join(sums, key, "left")
        .join(stage.coefs, key, "left")
        .join(_tail_rows(df, spec, value, layout), key, "left")
    )
    fits = cut_lineage(per_series(joined, solve, schema))
    if not spec.ma and not spec.seasonal[0]:
        return fits
    shape = Shape(spec.constant, ne, tuple(spec.ar), tuple(spec.ma), spec.order, spec.seasonal)
    beta = fits.where(F.col("status") != "failed").select(
        F.col(key).alias(key), F.concat(F.array("const"), "exog", "ar", "ma").alias("beta")
    )
    better = refine(stage.design, beta, cols[1 : 1 + ne + na] + cols[-1:], shape, key, layout.rows, task_rows)
    better = better.select(F.col(key).alias("__k"), *(F.col(c).alias(f"__{c}") for c in ("free", "params", "ssr", "n", "g", "e")))
    both = fits.join(better, F.col(key) == F.col("__k"), "left").drop("__k")
    return cut_lineage(per_series(both, _refined(shape, ne, na), schema))


def _refined(shape: Shape, ne: int, na: int):
    """A first estimate with what the refinement has found put in its place."""
    def run(row: dict) -> list[dict]:
        free = row.pop("__free")
        params, ssr, n, g, e = (row.pop(f"__{c}") for c in ("params", "ssr", "n", "g", "e"))
        if free is None:
            return [row]
        free, params, n = np.asarray(free, dtype=float), np.asarray(params, dtype=float), int(n)
        parts = np.split(free, [1, 1 + ne, 1 + ne + na])
        full = np.asarray(g, dtype=float).reshape(len(free) + 1, -1)
        d, k = shape.chain(params), len(params)
        cov = np.linalg.pinv(d.T @ full[:-1, :-1] @ d, hermitian=True) * ssr / max(n - k, 1)
        se = np.sqrt(np.maximum(np.diag(d @ cov @ d.T), 0.0))
        loglik = -0.5 * n * (math.log(2 * math.pi * max(ssr / n, 1e-300)) + 1) - n * math.log(row["scale"])
        tail = np.asarray(row["tail_e"], dtype=float).copy()
        if shape.history:
            e = np.asarray(e, dtype=float)[-len(tail):]
            tail[len(tail) - len(e):] = e
        return [row | {
            "const": float(parts[0][0]), "exog": parts[1].tolist(), "ar": parts[2].tolist(), "ma": parts[3].tolist(),
            "se": se.tolist(), "sigma2": ssr / n * row["scale"] ** 2, "n_obs": n, "tail_e": tail.tolist(),
            "aic": 2 * (k + 1) - 2 * loglik, "bic": math.log(n) * (k + 1) - 2 * loglik, "status": "success",
        }]

    return run


def arima_grid(
    df: DataFrame,
    max_p: int = 5,
    max_d: int = 2,
    max_q: int = 5,
    criterion: str = "aic",
    value: str = "close",
    layout: Layout = Layout(),
) -> DataFrame:
    """AIC and BIC of every order, one row per series and order, the best one flagged.

    For each d one superset matrix holds every (p, q), and all d use the rows that the
    largest d can use. So every order is scored on one sample, and the choice does not
    depend on the unit of the series.
    """
    if criterion not in ("aic", "bic"):
        raise ValueError(f"unknown criterion: {criterion}")
    key = layout.key
    tables = []
    for d in range(max_d + 1):
        spec = Spec((max_p, d, max_q))
        start = max_d + spec.long_lag + max(max_p, max_q)
        stage = _residual_stage(df, spec, value, layout, max_q, start)
        cols = [
            "__1",
            *(f"__z{i}" for i in range(1, max_p + 1)),
            *(f"__e{j}" for j in range(1, max_q + 1)),
            "__z___x",
        ]
        sums = gram(stage.rows, key, cols).join(stage.stats, key)
        tables.append(
            per_series(
                sums,
                _grid_solver(key, d, max_p, max_q, spec.constant),
                f"{key} string, p int, d int, q int, n_obs bigint, aic double, bic double,"
                " loglik double",
            )
        )
    scores = tables[0]
    for t in tables[1:]:
        scores = scores.unionByName(t)
    best = scores.groupBy(key).agg(
        F.min_by(F.struct("p", "d", "q"), F.struct(criterion, "p", "d", "q")).alias("__b")
    )
    flagged = scores.join(best, key)
    is_best = F.struct("p", "d", "q") == F.col("__b")
    return flagged.withColumn("best", is_best).drop("__b")


def _grid_solver(key: str, d: int, max_p: int, max_q: int, constant: bool):
    def solve(row: dict) -> list[dict]:
        k = max_p + max_q + 2
        m = full_matrix(row["g"], k)
        n = m[0, 0]
        out = []
        if n <= k + 1:
            return out
        jacobian = n * math.log(row["scale"])
        head = [0] if constant else []
        for p in range(max_p + 1):
            for q in range(max_q + 1):
                xs = [*head, *range(1, p + 1), *range(1 + max_p, 1 + max_p + q)]
                fit = Fit(m, xs, k - 1, n)
                out.append(
                    {
                        key: row[key],
                        "p": p,
                        "d": d,
                        "q": q,
                        "n_obs": int(n),
                        "aic": fit.aic(1) + 2 * jacobian,
                        "bic": fit.bic(1) + 2 * jacobian,
                        "loglik": fit.loglik() - jacobian,
                    }
                )
        return out

    return solve


def arimax_fit(
    df: DataFrame,
    exog: Sequence[str],
    order: Order = (1, 1, 1),
    seasonal: Seasonal = (1, 1, 1, 12),
    value: str = "close",
    layout: Layout = Layout(),
    fallback: Order = (1, 1, 1),
) -> DataFrame:
    """Model with regressors; a series whose regressors never vary, or whose fit fails,
    gets the plain fallback order, recorded in ``status``."""
    key = layout.key
    full = arima_fit(df, order, value, layout, seasonal=seasonal, exog=exog)
    varies = F.lit(False)
    for c in exog:
        varies = varies | (F.min(c) < F.max(c))
    marked = df.groupBy(key).agg(varies.alias("__varies"))
    good = cut_lineage(
        full.join(marked, key)
        .where(F.col("__varies") & (F.col("status") != "failed"))
        .drop("__varies")
    )
    rest = marked.select(key).join(good.select(key), key, "left_anti")
    if rest.isEmpty():
        return good
    plain = arima_fit(df.join(rest, key, "left_semi"), fallback, value, layout)
    return good.unionByName(
        plain.withColumn(
            "status", F.when(F.col("status") != "failed", "fallback").otherwise("failed")
        )
    )


def arimax_coefs(fit: DataFrame, exog: Sequence[str], key: str = "ticker") -> DataFrame:
    """Coefficient, standard error, normal p-value and 5% verdict of each regressor."""
    names = list(exog)

    def solve(row: dict) -> list[dict]:
        out = []
        for i, name in enumerate(names[: len(row["exog"])]):
            b, s = row["exog"][i], row["se"][1 + i]
            p = math.erfc(abs(b / s) / math.sqrt(2)) if s > 0 else None
            out.append(
                {
                    key: row[key],
                    "regressor": name,
                    "coef": b * row["scale"],
                    "std_err": s * row["scale"],
                    "p_value": p,
                    "significant": None if p is None else p < 0.05,
                }
            )
        return out

    return per_series(
        fit.select(key, "exog", "se", "scale"),
        solve,
        f"{key} string, regressor string, coef double, std_err double, p_value double,"
        " significant boolean",
    )


def _forecast_path(
    row: dict, steps: int, future: np.ndarray | None
) -> tuple[np.ndarray, np.ndarray]:
    """Point forecasts and standard errors in the series' own units."""
    s = [int(v) for v in row["seasonal"]]
    spec = Spec((int(row["p"]), int(row["d"]), int(row["q"])), tuple(s))
    ar = np.zeros(max([0, *spec.ar]) + 1)
    ar[0] = 1.0
    for lag, c in zip(spec.ar, row["ar"]):
        ar[lag] = -c
    ma = np.zeros(max([0, *spec.ma]) + 1)
    for lag, c in zip(spec.ma, row["ma"]):
        ma[lag] = c
    diff = spec.differencing
    full = -np.convolve(ar, diff)[1:]
    x = list(map(float, row["tail_x"]))
    e = list(map(float, row["tail_e"]))
    beta = np.asarray(row["exog"], dtype=float)
    push = np.zeros(steps)
    if len(beta):
        past = np.array([list(map(float, w)) for w in row["tail_w"]]).reshape(-1, len(beta))
        ahead = np.zeros((steps, len(beta))) if future is None else future
        w = np.vstack([past, ahead])
        for h in range(steps):
            at = len(past) + h
            dw = sum(
                c * w[at - lag] for lag, c in enumerate(diff) if at - lag >= 0
            )
            push[h] = dw @ beta
    for h in range(steps):
        value = float(row["const"]) + push[h]
        value += sum(c * x[-1 - i] for i, c in enumerate(full) if i < len(x))
        value += sum(c * e[-j] for j, c in enumerate(ma) if j and j <= len(e))
        x.append(value)
        e.append(0.0)
    psi = np.zeros(steps)
    for h in range(steps):
        psi[h] = 1.0 if h == 0 else (ma[h] if h < len(ma) else 0.0)
        psi[h] += sum(full[i] * psi[h - 1 - i] for i in range(min(len(full), h)))
    scale, centre = float(row["scale"]), float(row["centre"])
    mean = np.array(x[-steps:]) * scale + centre
    return mean, np.sqrt(float(row["sigma2"]) * np.cumsum(psi**2))


def future_events(
    fit: DataFrame,
    steps: int,
    events: Sequence[Event],
    key: str = "ticker",
    freq: str = "D",
) -> DataFrame:
    """``future`` rows for ``arima_forecast``: one flag per event at each date ahead."""
    ahead = future_calendar(fit.select(key, F.col("last_d").alias("d")), steps, freq, key)
    flags = [f"event_{i}" for i in range(1, len(events) + 1)]
    marked = event_flags(ahead, events, "d", per_event=True)
    row = F.struct("step", F.array(*(F.col(c).cast("double") for c in flags)).alias("w"))
    return marked.groupBy(key).agg(
        F.array_sort(F.collect_list(row)).alias("__rows")  # ``steps`` rows
    ).select(key, F.col("__rows.w").alias("future"))


def arima_forecast(
    fit: DataFrame,
    steps: int = 30,
    exog: DataFrame | None = None,
    key: str = "ticker",
    model: str = "arima",
    freq: str = "D",
) -> DataFrame:
    """``steps`` forecasts per series with a 95% interval, dated from the day after the fit.

    ``freq`` is one of ``future_calendar``; an interval keeps the time of day. ``exog`` holds one array of future regressor rows per series: ``ticker, future``.
    The recursion runs once per series on the stored tail, not on the history.
    """
    rows = fit.where(F.col("status") != "failed")
    rows = rows.join(exog, key, "left") if exog is not None else rows.withColumn(
        "future", F.lit(None).cast("array<array<double>>")
    )

    def solve(row: dict) -> list[dict]:
        future = None
        if row["future"] is not None and len(row["exog"]):
            future = np.zeros((steps, len(row["exog"])))
            given = [list(map(float, w)) for w in row["future"]][:steps]
            future[: len(given)] = given
        mean, err = _forecast_path(row, steps, future)
        return [
            {
                key: row[key],
                "step": h + 1,
                "yhat": mean[h],
                "lower": mean[h] - Z95 * err[h],
                "upper": mean[h] + Z95 * err[h],
            }
            for h in range(steps)
        ]

    path = per_series(
        rows, solve, f"{key} string, step int, yhat double, lower double, upper double"
    )
    dates = future_calendar(fit.select(key, F.col("last_d").alias("d")), steps, freq, key)
    return path.join(dates, [key, "step"]).select(
        key, F.lit(model).alias("model"), "step", "d", "yhat", "lower", "upper"
    )
