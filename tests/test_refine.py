"""Conditional least squares: recovery, derivatives, long series as short ones."""

import numpy as np
import pytest

from seriesloom.operators import arima, refine
from seriesloom.plans.layout import Layout

LAYOUT = Layout(rows=300)


def simulate(n, ar=(), ma=(), sar=0.0, sma=0.0, s=12, seed=0):
    rng = np.random.default_rng(seed)
    a = np.convolve([1.0, *(-x for x in ar)], [1.0, *[0.0] * (s - 1), -sar])
    b = np.convolve([1.0, *ma], [1.0, *[0.0] * (s - 1), sma])
    e, z = rng.normal(size=n + 500), np.zeros(n + 500)
    for t in range(60, n + 500):
        z[t] = b @ e[t - np.arange(len(b))] - a[1:] @ z[t - np.arange(1, len(a))]
    return z[500:]


def conditional_ssr(z, ar, ma, const):
    """Plain loop over the residuals of the standardised series."""
    e, total = np.zeros(len(z)), 0.0
    for t in range(len(ar), len(z)):
        back = sum(m * e[t - j] for j, m in enumerate(ma, 1) if t - j >= len(ar))
        e[t] = z[t] - const - sum(a * z[t - i] for i, a in enumerate(ar, 1)) - back
        total += e[t] ** 2
    return total


def test_derivatives_and_seams():
    z = simulate(1500, (0.5,), (0.3,), 0.4, -0.5, seed=1)
    lags = (1, 12, 13)
    shape = refine.Shape(False, 0, lags, lags, (1, 0, 1), (1, 0, 1, 12))
    x = np.column_stack([*(z[13 - k : len(z) - k] for k in lags), z[13:]])
    p = np.array([0.3, 0.2, 0.1, -0.4])
    cols, _ = refine.columns(x, p, shape, refine.blank(4, shape))
    slopes = cols[:, :-1] @ shape.chain(p)
    for i in range(4):
        near = [refine.columns(x, p + s * np.eye(4)[i] * 1e-5, shape, refine.blank(4, shape))[0][:, -1] for s in (1, -1)]
        np.testing.assert_allclose((near[0] - near[1]) / 2e-5, slopes[:, i], atol=1e-6)
    now, total = refine.blank(4, shape), 0
    for a in range(0, len(x), 333):
        part, last = refine.columns(x[a : a + 333], p, shape, now)
        _, zero = refine.columns(x[a : a + 333], p, shape, refine.blank(4, shape))
        np.testing.assert_allclose(refine.transition(p, shape, len(part), 4)(now) + zero, last, atol=1e-9)
        now, total = last, total + refine.products(part)
    np.testing.assert_allclose(total, refine.products(cols), rtol=1e-9)


@pytest.fixture(scope="module")
def fits(make):
    series = {"arma": simulate(6000, (0.6,), (0.4,), seed=2), "ma": simulate(6000, (0.3,), (-0.7,), seed=3), "short": simulate(40, (0.5,), (0.2,), seed=4)}
    df = make(series, "1990-01-01")
    whole = {r.ticker: r for r in arima.arima_fit(df, (1, 0, 1), layout=LAYOUT).collect()}
    cut = {r.ticker: r for r in arima.arima_fit(df, (1, 0, 1), layout=LAYOUT, task_rows=1000).collect()}
    return series, whole, cut


def test_parameters_of_simulated_series(fits):
    series, whole, _ = fits
    for name, ar, ma in (("arma", 0.6, 0.4), ("ma", 0.3, -0.7)):
        r, z = whole[name], series[name]
        assert r.status == "success"
        assert r.ar[0] == pytest.approx(ar, abs=0.03) and r.ma[0] == pytest.approx(ma, abs=0.03)
        unit = (z - z.mean()) / z.std(ddof=1)
        own = conditional_ssr(unit, r.ar, r.ma, r.const)
        assert r.sigma2 == pytest.approx(own / r.n_obs * z.var(ddof=1), rel=1e-6)
        for d in (-0.02, 0.02):  # a minimum of the conditional sum of squares
            assert conditional_ssr(unit, [r.ar[0] + d], r.ma, r.const) > own
            assert conditional_ssr(unit, r.ar, [r.ma[0] + d], r.const) > own


def test_long_series_equal_short_ones(fits):
    _, whole, cut = fits
    assert set(whole) == set(cut) == {"arma", "ma", "short"}
    for name, a in whole.items():
        b = cut[name]
        np.testing.assert_allclose([*a.ar, *a.ma, a.const, a.sigma2, *a.se], [*b.ar, *b.ma, b.const, b.sigma2, *b.se], rtol=1e-5, atol=1e-6)
        np.testing.assert_allclose(a.tail_e[-1:], b.tail_e[-1:], atol=1e-5)
        assert a.n_obs == b.n_obs


def test_seasonal_factors_multiply(make):
    z = simulate(5000, (0.4,), (0.3,), 0.6, -0.2, seed=5)
    r = arima.arima_fit(make({"A": z}, "1990-01-01"), (1, 0, 1), layout=LAYOUT, seasonal=(1, 0, 1, 12)).first()
    assert r.status == "success" and len(r.ar) == 3 and len(r.ma) == 3
    assert r.ar[0] == pytest.approx(0.4, abs=0.06) and r.ar[1] == pytest.approx(0.6, abs=0.06)
    assert r.ar[2] == pytest.approx(-r.ar[0] * r.ar[1], abs=1e-9)
    assert r.ma[2] == pytest.approx(r.ma[0] * r.ma[1], abs=1e-9)
