"""Held-out evaluation, forecasts with future events, times of day, tests after differencing."""

from datetime import datetime, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from seriesloom.operators import arima, forecasting
from seriesloom.operators.stationarity import adf_test, stationarity_report, stationarize
from seriesloom.plans.layout import Layout

LAYOUT = Layout(rows=300)


def walk(n, seed):
    return np.random.default_rng(seed).normal(0, 1, n).cumsum() + 50


def test_rolling_origin_scores_against_brute_force(make):
    series = {"A": walk(400, 1), "B": walk(200, 2)}
    df = make(series)
    cuts = ["2020-05-01", "2020-07-01", "2021-01-20"]
    got = forecasting.rolling_origin(df, cuts, 5, {"naive": forecasting.naive_model()}, LAYOUT).collect()
    want = {}
    for name, x in series.items():
        for cut in cuts:
            at = (datetime.fromisoformat(cut) - datetime(2020, 1, 1)).days
            if at < len(x):
                for i, y in enumerate(x[at : at + 5], 1):
                    want[name, cut, i] = (y, x[at - 1])
    assert {(r.ticker, r.cut, r.step): (r.y, r.yhat) for r in got} == want
    scores = forecasting.backtest(df, cuts, 5, {"naive": forecasting.naive_model()}, LAYOUT).collect()
    for r in scores:
        errors = [abs(y - f) for (name, *_), (y, f) in want.items() if name == r.ticker]
        assert r.mae == pytest.approx(np.mean(errors))


def test_rolling_origin_equals_one_fit_per_cut(make):
    df = make({"A": walk(300, 3)})
    models = {"arima": forecasting.arima_model((1, 0, 0))}
    got = forecasting.rolling_origin(df, ["2020-06-01", "2020-08-01"], 4, models, LAYOUT).collect()
    for cut in ("2020-06-01", "2020-08-01"):
        fit = arima.arima_fit(df.where(F.col("d") < cut), (1, 0, 0), layout=LAYOUT)
        alone = [r.yhat for r in arima.arima_forecast(fit, 4).orderBy("step").collect()]
        assert [r.yhat for r in sorted(got, key=lambda r: r.step) if r.cut == cut] == pytest.approx(alone)


def test_ledger_has_scores_where_they_exist(make):
    df = make({"A": walk(200, 4)})
    models = {"naive": forecasting.naive_model(), "arima": forecasting.arima_model((1, 0, 0))}
    path, runs = forecasting.forecast_all(df, 3, models, LAYOUT)
    assert path.count() == 6 and "aic" not in path.columns
    got = {r.model: r for r in runs.collect()}
    fit = arima.arima_fit(df, (1, 0, 0), layout=LAYOUT).first()
    assert (got["arima"].aic, got["arima"].bic) == (pytest.approx(fit.aic), pytest.approx(fit.bic))
    assert got["naive"].aic is None and got["naive"].status == "success"


def test_future_events_move_the_forecast(make):
    rng = np.random.default_rng(5)
    flag = (np.arange(400) % 20 < 5).astype(float)
    df = make({"A": 10 + 8 * flag + rng.normal(0, 0.5, 400)})
    first = F.to_date(F.lit("2020-01-01"))
    df = df.withColumn("event_1", (F.datediff("d", first) % 20 < 5).cast("int"))
    fit = arima.arima_fit(df, (1, 0, 0), layout=LAYOUT, exog=["event_1"])
    # The last day is 2021-02-03; the event covers steps 3 to 5.
    ahead = arima.future_events(fit, 8, [("2021-02-06", "2021-02-08")])
    got = [r.yhat for r in arima.arima_forecast(fit, 8, ahead).orderBy("step").collect()]
    plain = [r.yhat for r in arima.arima_forecast(fit, 8).orderBy("step").collect()]
    lift = np.array(got) - np.array(plain)
    assert lift[[2, 3, 4]].min() > 6 and abs(lift[[0, 1]]).max() < 1e-9


@pytest.mark.parametrize("kind", ["timestamp_ntz", "timestamp"])
def test_hourly_series_are_forecast_by_hours(spark, kind):
    rng = np.random.default_rng(6)
    start = datetime(2024, 1, 1)
    rows = [("A", start + timedelta(hours=i), float(v)) for i, v in enumerate(rng.normal(5, 1, 300))]
    df = spark.createDataFrame(rows, f"ticker string, d {kind}, close double")
    fit = arima.arima_fit(df, (1, 0, 0), layout=LAYOUT)
    got = arima.arima_forecast(fit, 3, freq="1 hour").orderBy("step")
    want = [str(start + timedelta(hours=299 + i)) for i in (1, 2, 3)]
    assert [r.d for r in got.select(F.col("d").cast("string").alias("d")).collect()] == want


def test_report_tests_the_differences(make):
    rng = np.random.default_rng(7)
    df = make({"noise": rng.normal(0, 1, 400), "walk": walk(400, 8), "twice": walk(400, 9).cumsum(), "flat": [2.0] * 60})
    got = {r.ticker: r for r in stationarity_report(df, layout=LAYOUT).collect()}
    rows = stationarize(df, layout=LAYOUT)
    again = adf_test(rows.where("differenced").select("ticker", "d", F.col("x").alias("close")), layout=LAYOUT)
    for r in again.collect():
        assert got[r.ticker].statistic_diff == (
            None if r.statistic is None else pytest.approx(r.statistic, rel=1e-9)
        )
    assert got["noise"].statistic_diff is None
    assert [got[t].differenced for t in ("noise", "walk", "twice", "flat")] == [False, True, True, True]
    assert [got[t].ready for t in ("noise", "walk", "twice", "flat")] == [True, True, False, False]
