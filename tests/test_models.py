"""Statistics and forecasters against direct computation and by recovery on simulated series."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from seriesloom import Layout
from seriesloom.operators import additive, arima, autocorr, forecasting, ledger, metrics, trees
from seriesloom.operators.decomposition import decompose
from seriesloom.operators.sequences import flat_sequences, sequences
from seriesloom.operators.stationarity import adf_pvalue, adf_test, default_max_lag, stationarize

LAYOUT = Layout(rows=700, slice_days=500)
START = "1990-01-01"


def arma(n, ar=(), ma=(), seed=0, const=0.0):
    rng = np.random.default_rng(seed)
    e = rng.normal(0, 1, n + 100)
    x = np.zeros(n + 100)
    for t in range(max(len(ar), len(ma), 1), n + 100):
        x[t] = const + e[t] + sum(a * x[t - 1 - i] for i, a in enumerate(ar)) + sum(b * e[t - 1 - j] for j, b in enumerate(ma))
    return x[100:]


@pytest.fixture(scope="module")
def simulated(make):
    return make(
        {
            "noise": arma(3000, seed=1) + 10,
            "walk": arma(3000, seed=2).cumsum() + 500,
            "ar2": arma(3000, (0.5, -0.3), seed=3) * 4 + 20,
            "arma11": arma(3000, (0.6,), (0.4,), seed=4),
        },
        START,
    ).persist()


# ---- decomposition ----------------------------------------------------------------


@pytest.mark.parametrize("period", [7, 12])
@pytest.mark.parametrize("model", ["additive", "multiplicative"])
def test_decomposition(make, pdf, period, model):
    t = np.arange(150)
    wave = np.sin(2 * np.pi * t / period)
    v = 50 + 0.1 * t + 3 * wave if model == "additive" else (50 + 0.1 * t) * (1 + 0.05 * wave)
    got = pdf(decompose(make({"A": v}), period, model, layout=Layout(rows=40, slice_days=30)))
    weights = np.ones(period) / period if period % 2 else np.r_[0.5, np.ones(period - 1), 0.5] / period
    half = period // 2
    trend = np.full(150, np.nan)
    trend[half:-half] = np.convolve(v, weights, "valid")
    np.testing.assert_allclose(got.trend, trend, rtol=1e-10)
    rest = v - trend if model == "additive" else v / trend
    seasonal = np.array([np.nanmean(rest[i::period]) for i in range(period)])
    seasonal = seasonal - seasonal.mean() if model == "additive" else seasonal / seasonal.mean()
    np.testing.assert_allclose(got.seasonal, seasonal[t % period], rtol=1e-9, atol=1e-12)
    whole = got.trend + got.seasonal + got.resid if model == "additive" else got.trend * got.seasonal * got.resid
    np.testing.assert_allclose(whole[half:-half], v[half:-half], rtol=1e-10)


def test_short_series_cannot_be_decomposed(make):
    df = make({"A": np.arange(20.0)})
    assert decompose(df, 12).where("seasonal is not null").count() == 0
    with pytest.raises(ValueError):
        decompose(df, 12, strict=True)
    with pytest.raises(ValueError):
        decompose(df, 12, "geometric")


# ---- autocorrelation ----------------------------------------------------------------


def test_acf_and_pacf(simulated, pdf):
    x = arma(3000, (0.5, -0.3), seed=3) * 4 + 20
    c = x - x.mean()
    r = np.array([c[k:] @ c[: len(c) - k] for k in range(6)]) / (c @ c)
    one = simulated.where("ticker = 'ar2'")
    np.testing.assert_allclose(pdf(autocorr.acf(one, 5, layout=LAYOUT), ("lag",)).acf, r, rtol=1e-9)
    got = pdf(autocorr.pacf(one, 5, layout=LAYOUT), ("lag",)).pacf
    for k in range(1, 6):
        toeplitz = r[np.abs(np.subtract.outer(np.arange(k), np.arange(k)))]
        assert got[k] == pytest.approx(np.linalg.solve(toeplitz, r[1 : k + 1])[-1], rel=1e-8)
    order = autocorr.suggest_ar_order(one, 2, layout=LAYOUT).first()
    assert order.ar_order == 2 and list(order.significant_lags) == [1, 2]


# ---- unit root test -------------------------------------------------------------------


def direct_adf(x):
    """The same test by least squares on explicit matrices."""
    top = default_max_lag(len(x))
    d = np.diff(x)

    def design(p, first):
        t = np.arange(first, len(x))
        cols = [np.ones(len(t)), x[t - 1]] + [d[t - 1 - j] for j in range(1, p + 1)]
        return np.column_stack(cols), d[t - 1]

    scores = []
    for p in range(top + 1):
        a, y = design(p, top + 1)
        ssr = np.linalg.lstsq(a, y, rcond=None)[1][0]
        scores.append((len(y) * math.log(ssr / len(y)) + 2 * (p + 2), p))
    p = min(scores)[1]
    a, y = design(p, p + 1)
    beta, ssr = np.linalg.lstsq(a, y, rcond=None)[:2]
    cov = np.linalg.inv(a.T @ a) * ssr[0] / (len(y) - a.shape[1])
    return beta[1] / math.sqrt(cov[1, 1]), p, len(y)


def test_adf(simulated, make):
    got = {r.ticker: r for r in adf_test(simulated, layout=LAYOUT).collect()}
    for t, x in (("noise", arma(3000, seed=1) + 10), ("walk", arma(3000, seed=2).cumsum() + 500)):
        stat, lag, n = direct_adf(x)
        assert (got[t].used_lag, got[t].n_obs) == (lag, n)
        assert got[t].statistic == pytest.approx(stat, rel=1e-6)
    assert got["noise"].stationary and got["ar2"].stationary and not got["walk"].stationary
    short = make({"a": arma(60, seed=8), "b": arma(300, seed=9).cumsum(), "tiny": [1.0, 2.0], "flat": [3.0] * 50})
    got = {r.ticker: r for r in adf_test(short, layout=LAYOUT).collect()}
    for t, x in (("a", arma(60, seed=8)), ("b", arma(300, seed=9).cumsum())):
        stat, lag, n = direct_adf(x)
        assert (got[t].used_lag, got[t].n_obs) == (lag, n)
        assert got[t].statistic == pytest.approx(stat, rel=1e-6)
    assert got["tiny"].statistic is None and got["flat"].statistic is None


def test_adf_pvalues():
    for stat, p in ((-3.43, 0.01), (-2.86, 0.05), (-2.57, 0.099)):
        assert adf_pvalue(stat) == pytest.approx(p, abs=0.002)
    assert adf_pvalue(5) == 1.0 and adf_pvalue(-30) == 0.0


def test_stationarize(simulated):
    got = {(r.ticker, r.differenced): r["count"] for r in stationarize(simulated, layout=LAYOUT).groupBy("ticker", "differenced").count().collect()}
    assert got == {("noise", False): 3000, ("walk", True): 2999, ("ar2", False): 3000, ("arma11", False): 3000}


# ---- autoregressive models --------------------------------------------------------------


def test_recovers_ar_and_ma(simulated):
    fit = {r.ticker: r for r in arima.arima_fit(simulated, (2, 0, 0), layout=LAYOUT).collect()}
    np.testing.assert_allclose(fit["ar2"].ar, [0.5, -0.3], atol=0.05)
    assert fit["ar2"].sigma2 == pytest.approx(16, rel=0.1)
    both = {r.ticker: r for r in arima.arima_fit(simulated, (1, 0, 1), layout=LAYOUT).collect()}
    assert both["arma11"].ar[0] == pytest.approx(0.6, abs=0.06) and both["arma11"].ma[0] == pytest.approx(0.4, abs=0.06)


def test_grid_picks_the_simulated_order(simulated):
    grid = arima.arima_grid(simulated, 3, 0, 2, "bic", layout=LAYOUT)
    assert grid.count() == 4 * 12
    best = {r.ticker: (r.p, r.q) for r in grid.where("best").collect()}
    assert best["noise"] == (0, 0) and best["ar2"] == (2, 0) and best["arma11"] == (1, 1)


def test_forecasts(make, simulated):
    line = make({"line": 5 + 2.0 * np.arange(300) + np.random.default_rng(0).normal(0, 0.01, 300)})
    fit = arima.arima_fit(line, (1, 2, 1), layout=LAYOUT)
    fc = sorted(arima.arima_forecast(fit, 5).collect(), key=lambda r: r.step)
    for r in fc:
        assert r.yhat == pytest.approx(5 + 2.0 * (299 + r.step), abs=0.5) and r.lower < r.yhat < r.upper
    assert (fc[0].d - fit.first().last_d).days == 1
    ar = arima.arima_fit(simulated.where("ticker = 'ar2'"), (2, 0, 0), layout=LAYOUT)
    row, x = ar.first(), arma(3000, (0.5, -0.3), seed=3) * 4 + 20
    z = (x - row.centre) / row.scale
    one = (row.const + row.ar[0] * z[-1] + row.ar[1] * z[-2]) * row.scale + row.centre
    path = sorted(arima.arima_forecast(ar, 200).collect(), key=lambda r: r.step)
    assert path[0].yhat == pytest.approx(one, rel=1e-9)
    assert path[-1].yhat == pytest.approx(x.mean(), abs=0.5)
    assert (path[-1].upper - path[-1].lower) / 2 / 1.96 == pytest.approx(x.std(), rel=0.1)


def test_residual_state_matches_the_moving_average(make):
    """One step ahead of an MA(1) needs the last residual."""
    x = arma(2500, (), (0.7,), seed=12)
    fit = arima.arima_fit(make({"A": x}, START), (0, 0, 1), layout=LAYOUT)
    e = np.zeros(2500)
    for t in range(1, 2500):
        e[t] = x[t] - 0.7 * e[t - 1]
    fc = arima.arima_forecast(fit, 2).orderBy("step").collect()
    assert fc[0].yhat == pytest.approx(0.7 * e[-1], abs=0.15)


def test_regressors(make):
    rng = np.random.default_rng(6)
    flag = (np.arange(3000) % 97 < 20).astype(float)
    base = make({"A": arma(3000, (0.4,), seed=7) + 3 * flag, "never": arma(3000, (0.4,), seed=8)}, START)
    day = F.datediff("d", F.lit(START).cast("date"))
    hit = F.when(F.col("ticker") == "never", 0).otherwise((day % 97 < 20).cast("int"))
    df = base.withColumns({"hit": hit, "other": F.lit(0) + (F.xxhash64("d") % 2 == 0).cast("int")})
    fit = arima.arima_fit(df.where("ticker = 'A'"), (1, 0, 0), layout=LAYOUT, exog=["hit", "other"])
    coefs = {r.regressor: r for r in arima.arimax_coefs(fit, ["hit", "other"]).collect()}
    assert coefs["hit"].significant and not coefs["other"].p_value < 0.001
    future = df.sparkSession.createDataFrame([("A", [[1.0, 0.0]] * 3)], "ticker string, future array<array<double>>")
    with_event = arima.arima_forecast(fit, 3, future).orderBy("step").first().yhat
    without = arima.arima_forecast(fit, 3).orderBy("step").first().yhat
    assert with_event - without == pytest.approx(coefs["hit"].coef, rel=1e-6)
    mixed = {r.ticker: r for r in arima.arimax_fit(df, ["hit"], (1, 0, 0), (0, 0, 0, 0), layout=LAYOUT).collect()}
    assert mixed["A"].status == "success" and mixed["never"].status == "fallback"
    assert (mixed["never"].p, mixed["never"].d, mixed["never"].q) == (1, 1, 1)


def test_seasonal_lags():
    spec = arima.Spec((1, 1, 1), (1, 1, 1, 12))
    assert spec.ar == [1, 12, 13] and spec.ma == [1, 12, 13]
    np.testing.assert_array_equal(np.flatnonzero(spec.differencing), [0, 1, 12, 13])


# ---- additive model -------------------------------------------------------------------------


def test_additive_recovery(make, pdf):
    t = np.arange(1500)
    y = 100 + 0.05 * t + 4 * np.sin(2 * np.pi * t / 7) + np.random.default_rng(2).normal(0, 0.5, 1500)
    y[300:360] += 8
    days = ("1990-10-28", "1990-12-26")
    cfg = additive.AdditiveConfig(yearly=3, events=(days,))
    df = make({"A": y, "B": 2 * y}, START)
    fit = additive.additive_fit(df, cfg, layout=LAYOUT)
    effects = {(r.ticker, r.effect): r.coef for r in additive.named_coefficients(fit, cfg).collect()}
    assert effects["A", "event_1"] == pytest.approx(8, abs=1.0)
    assert effects["B", "event_1"] == pytest.approx(2 * effects["A", "event_1"], rel=1e-6)
    fc = pdf(additive.additive_forecast(fit, 14, cfg=cfg))
    a = fc[fc.ticker == "A"]
    ahead = np.arange(1500, 1514)
    np.testing.assert_allclose(a.yhat, 100 + 0.05 * ahead + 4 * np.sin(2 * np.pi * ahead / 7), atol=2.0)
    past = additive.additive_forecast(fit, 3, history=df.where("ticker = 'A'"), cfg=cfg)
    assert past.where("ticker = 'A' and step = 0").count() == 1500


# ---- trees, recursion, ensembles, ledger --------------------------------------------------------


def test_trees_and_recursion(make):
    v = np.tile([1.0, 2.0, 3.0, 4.0], 40)
    df = make({"A": v})
    flat = flat_sequences(sequences(df, ["close"], "close", 3, LAYOUT), 3)
    model = trees.gbt_fit(flat, ["x1", "x2", "x3"], "y", rounds=5, depth=3)
    state = trees.last_windows(df, 3, "close", LAYOUT)
    path = [r.yhat for r in trees.recursive_forecast(model, state, 3, 10, checkpoint_every=4).orderBy("step").collect()]
    np.testing.assert_allclose(path, [1, 2, 3, 4, 1, 2, 3, 4, 1, 2], atol=0.05)
    assert trees.next_step(model, state, 3).first().yhat == pytest.approx(path[0])
    top = trees.feature_importance(model, ["x1", "x2", "x3"], 2).collect()
    assert len(top) == 2 and top[0].importance >= top[1].importance


def test_ensembles(spark):
    rows = [("A", "m1", i, float(i)) for i in range(1, 6)] + [("A", "m2", i, 10.0) for i in range(1, 4)]
    fc = spark.createDataFrame(rows, "ticker string, model string, step int, yhat double")

    def run(*a):
        return [r.yhat for r in metrics.ensemble(fc, *a).orderBy("step").collect()]

    assert run("mean") == [5.5, 6.0, 6.5] == run("median") == run("unknown") == run("weighted")
    assert run("weighted", {"m1": 3.0}) == [(3 * i + 10) / 4 for i in (1, 2, 3)]


def test_forecast_all_survives_a_failing_model(make):
    def broken(df, steps, layout):
        raise RuntimeError("no luck")

    df = make({"A": 50 + arma(400, (0.5,), seed=1)})
    models = {"bad": broken, "arima": forecasting.arima_model((1, 0, 0))}
    fc, runs = forecasting.forecast_all(df, 4, models, LAYOUT, start="2020-02-01", end="2020-12-31")
    assert fc.count() == 4 and str(fc.agg(F.min("d")).first()[0]) == "2021-01-01"
    assert {r.model: r.status for r in runs.collect()} == {"bad": "failed", "arima": "success"}
    summary = ledger.run_summary(runs).first()
    assert (summary.total, summary.successful, summary.failed, summary.status) == (2, 1, 1, "completed")
    with pytest.raises(ValueError):
        forecasting.forecast_all(df, 4, models, LAYOUT, start="1990-01-01", end="1991-01-01")


def test_metrics(spark):
    df = spark.createDataFrame([("A", "m", 2.0, 1.0), ("A", "m", 4.0, 6.0), ("A", "m", 0.0, 1.0)], "ticker string, model string, y double, f double")
    r = metrics.forecast_metrics(df, "y", "f").first()
    assert (r.mae, r.mse) == (pytest.approx(4 / 3), pytest.approx(2.0)) and r.mape == pytest.approx(50.0)


def test_grid_choice_does_not_depend_on_the_unit(make, pdf):
    walk = 1 + np.random.default_rng(4).normal(0, 1, 900).cumsum() / 100
    got = [
        pdf(arima.arima_grid(make({"A": walk * unit}, start="2000-01-01"), 1, 2, 1, layout=Layout(rows=400)), ["p", "d", "q"])
        for unit in (5e4, 1e-4)
    ]
    assert got[0].n_obs.nunique() == 1
    assert list(got[0].best) == list(got[1].best)


@pytest.mark.parametrize("kind", ["noise", "walk", "smooth"])
def test_default_order_gives_usable_models(make, pdf, kind):
    rng = np.random.default_rng(6)
    e = rng.normal(0, 1, 1501)
    x = {"noise": e[1:], "walk": e[1:].cumsum(), "smooth": (e[1:] - 0.6 * e[:-1]).cumsum()}[kind]
    df = make({"A": 200 + x}, start="2000-01-01")
    fit = arima.arima_fit(df, layout=Layout(rows=500)).collect()[0]
    assert fit.status in ("success", "adjusted")
    for poly in ([1.0, *(-a for a in fit.ar)], [1.0, *fit.ma]):
        assert all(abs(r) > 1 for r in np.roots(poly[::-1]))


def test_reflected_roots():
    np.testing.assert_allclose(arima.stable_lags(np.array([0.5]), 1.0), [0.5])
    np.testing.assert_allclose(arima.stable_lags(np.array([2.0]), 1.0), [0.5])
    np.testing.assert_allclose(arima.stable_lags(np.array([1.25]), -1.0), [0.8])
    assert len(arima.stable_lags(np.zeros(0), 1.0)) == 0


class Stop(Exception):
    pass


@pytest.mark.parametrize("query,call,expected", [
    ("gbt_fit_score", "gbt_fit", {"rounds": 50, "depth": 5, "features": True}),
    ("feature_importance", "gbt_fit", {"rounds": 50, "depth": 5, "features": True}),
    ("next_step", "gbt_fit", {"rounds": 50, "depth": 5}),
    ("recursive_forecast", "recursive_forecast", {"steps": 30}),
    ("training_summary", "arima_grid", {"max_p": 5, "max_d": 2, "max_q": 5}),
    ("forecast_all", "forecast_all", {"steps": 30}),
])
def test_registered_queries_do_the_whole_job(spark, monkeypatch, query, call, expected):
    import inspect

    from seriesloom.catalog import QUERIES
    from seriesloom.operators.features import FeatureConfig, feature_names

    module = {"arima_grid": arima, "forecast_all": forecasting}.get(call, trees)
    signature, seen = inspect.signature(getattr(module, call)), {}

    def record(*args, **kw):
        bound = signature.bind(*args, **kw)
        bound.apply_defaults()
        seen.update(bound.arguments)
        raise Stop

    if call == "recursive_forecast":
        monkeypatch.setattr(trees, "gbt_fit", lambda *a, **k: None)
    monkeypatch.setattr(module, call, record)
    with pytest.raises(Stop):
        QUERIES[query](spark, "/root/testdata/sf0.001")
    if expected.pop("features", False):
        assert list(seen["cols"]) == feature_names(FeatureConfig.library())
    assert {k: seen[k] for k in expected} == expected


def test_tree_model_boosts_with_the_default_rounds():
    import inspect

    own, whole = (inspect.signature(f).parameters for f in (forecasting.tree_model, trees.gbt_fit))
    assert (own["rounds"].default, own["depth"].default) == (whole["rounds"].default, whole["depth"].default)
