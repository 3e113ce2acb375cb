"""Sparse changes of the trend and the uncertainty they bring."""

import numpy as np

from seriesloom.operators import additive
from seriesloom.plans.layout import Layout

LAYOUT = Layout(rows=300)


def test_sparse_changes_meet_the_optimality_conditions():
    rng = np.random.default_rng(1)
    t = np.linspace(0, 1, 800)
    x = np.column_stack([np.ones(800), t, *(np.maximum(t - 0.8 * j / 26, 0) for j in range(1, 26)), np.sin(40 * t)])
    y = 1 + t - 2 * np.maximum(t - 0.3, 0) + 0.3 * np.sin(40 * t) + rng.normal(0, 0.05, 800)
    rows = np.column_stack([x, y])
    m, penalty, weight = rows.T @ rows, np.r_[np.zeros(27), 0.5] + 1e-8, 0.2
    b = additive.sparse_changes(m, penalty, slice(2, 27), weight)
    slope = m[:28, 28] - (m[:28, :28] + np.diag(penalty)) @ b
    hinge = np.arange(2, 27)
    on, off = hinge[b[hinge] != 0], hinge[b[hinge] == 0]
    np.testing.assert_allclose(slope[on], weight * np.sign(b[on]), atol=1e-6)
    assert (np.abs(slope[off]) <= weight + 1e-6).all() and len(off) > 15
    np.testing.assert_allclose(slope[[0, 1, 27]], 0, atol=1e-6)


def test_two_breaks_keep_few_hinges(make):
    t = np.arange(1300) / 1299
    cfg = additive.AdditiveConfig(weekly=1, yearly=0)
    at = [0.8 * j / 26 for j in (8, 17)]
    y = 50 + 10 * t - 60 * np.maximum(t - at[0], 0) + 90 * np.maximum(t - at[1], 0)
    y += np.random.default_rng(3).normal(0, 0.2, 1300)
    fit = additive.additive_fit(make({"A": y}), cfg, layout=LAYOUT)
    coef = {r.effect: r.coef for r in additive.named_coefficients(fit, cfg).collect()}
    hinges = {k: v for k, v in coef.items() if k.startswith("hinge") and abs(v) > 3}
    assert {"hinge_8", "hinge_17"} <= set(hinges) and len(hinges) <= 4
    assert hinges["hinge_8"] < -40 and hinges["hinge_17"] > 60
    assert sum(v == 0 for k, v in coef.items() if k.startswith("hinge")) >= 12


def test_intervals_widen_and_cover(make):
    """Trends that change at random times go on changing behind the training days."""
    rng, series, n, ahead = np.random.default_rng(7), {}, 800, 200
    for k in range(60):
        t, slope = np.arange(n + ahead) / n, np.full(n + ahead, rng.normal(0, 5))
        for at in np.flatnonzero(rng.random(n + ahead) < 25 / n):
            slope[at:] += rng.laplace(0, 8)
        series[f"s{k:02d}"] = 100 + np.cumsum(slope) / n + rng.normal(0, 0.3, n + ahead)
    cfg = additive.AdditiveConfig(weekly=0, yearly=0, changepoint_scale=0.5)
    fit = additive.additive_fit(make({k: v[:n] for k, v in series.items()}), cfg, layout=LAYOUT)
    got = additive.additive_forecast(fit, ahead, cfg=cfg).toPandas().sort_values(["ticker", "step"])
    width = (got.upper - got.lower).groupby(got.step).mean()
    assert width.is_monotonic_increasing and width.iloc[-1] > 2 * width.iloc[0]
    truth = np.concatenate([series[k][n:] for k in sorted(series)])
    assert 0.90 <= ((truth >= got.lower) & (truth <= got.upper)).mean() <= 0.98
