import datetime as dt

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from seriesloom import Layout
from seriesloom.operators import calendars, datasets, filters, joins, profiling, quality, returns
from seriesloom.sources import bars, readers, sinks, snapshots

LAYOUT = Layout(rows=40, slice_days=20)


# ---- monthly returns: the three fixed cases, gaps and zeros --------------------


def monthly(make, pdf, values, start="2023-01-01"):
    return pdf(returns.monthly_returns(make({"A": values}, start)), ("ticker", "month_end"))


def test_three_months(make, pdf):
    got = monthly(make, pdf, [100, 101, 102, 105, 104, 106, 108, 107, 110, 112] * 9)
    assert len(got) == 3 and list(got.columns) == ["ticker", "month_end", "monthly_return"]
    assert list(got.month_end) == [dt.date(2023, 1, 31), dt.date(2023, 2, 28), dt.date(2023, 3, 31)]


def test_rising_and_falling_month(make, pdf):
    up = monthly(make, pdf, [100 + i for i in range(31)])
    down = monthly(make, pdf, [100 - i for i in range(30)])
    assert len(up) == 1 and up.monthly_return[0] == pytest.approx(0.30)
    assert len(down) == 1 and down.monthly_return[0] < 0


def test_two_month_gap_gives_zeros(spark, pdf):
    rows = [("A", dt.date(2020, 1, 10), 10.0), ("A", dt.date(2020, 3, 5), 15.0)]
    got = pdf(returns.monthly_returns(spark.createDataFrame(rows, "ticker string, d date, close double")), ("ticker", "month_end"))
    assert list(got.monthly_return) == [0.0, 0.0, pytest.approx(0.5)]


@pytest.mark.parametrize(
    "values",
    [
        [5, 4, 0, 0] + [0] * 40, [5, 0, 4] + [3] * 40, [0, 0, 4] + [4] * 40, [0] * 45,
        [5] * 31 + [0] * 20, [5] * 30 + [0] + [0] * 5 + [7] * 20, [np.nan, 5, np.nan] + [6] * 40, [np.nan] * 40,
        [-5, 4, -3] + [2] * 40,
    ],
)
def test_zeros_and_nulls_follow_the_daily_product(make, pdf, values):
    got = monthly(make, pdf, values)
    s = pd.Series(np.array(values, dtype=float), index=pd.date_range("2023-01-01", periods=len(values)))
    daily = s.ffill() / s.ffill().shift(1) - 1
    with np.errstate(all="ignore"):
        want = (1 + daily).resample("ME").prod() - 1
    want = want.where(np.isfinite(want))
    np.testing.assert_allclose(got.monthly_return.astype(float), want, rtol=1e-12, atol=1e-15)


# ---- filters and splits ----------------------------------------------------------


def stamps(spark, texts):
    return spark.createDataFrame([(t,) for t in texts], "t string").select(F.to_timestamp("t").alias("d"))


def test_instant_bounds_and_day_slices(spark):
    df = stamps(spark, ["2023-12-31 00:00:00", "2023-12-31 15:00:00", "2024-01-01 00:00:00"])
    assert filters.between_ts(df, None, "2023-12-31").count() == 1
    assert filters.day_slice(df, None, "2023-12-31").count() == 2
    assert filters.day_slice(df, "2024-01-01").count() == 1
    assert filters.between_ts(df, "2023-12-31 10:00:00", None, zone="America/New_York").count() == 2


def test_split_overlap_and_missing_test(make):
    df = make({"A": np.arange(10.0)})
    both = filters.split_dates(df, "2020-01-01", "2020-01-05", "2020-01-05")
    assert both.where("d = date'2020-01-05'").count() == 2 and both.count() == 11
    assert filters.split_dates(df, "2020-01-01", "2020-01-05").where("split = 'test'").count() == 0


def test_ratio_split_and_warmup(make, pdf):
    df = make({"A": np.arange(101.0), "B": np.arange(3.0)})
    got = pdf(filters.split_ratio(df, 0.8, LAYOUT))
    assert (got[got.ticker == "A"].split == "train").sum() == 80
    assert (got[got.ticker == "B"].split == "train").sum() == 2
    holes = make({"A": [np.nan, 1, 2, 3], "B": [1, 2, 3, 4]})
    got = pdf(filters.warmup_trim(holes, 3, ["close"], LAYOUT))
    assert list(got.ticker) == ["A", "B", "B", "B", "B"]


def test_duplicate_columns_compare_by_value(spark):
    df = spark.createDataFrame(
        [(1, True, 1, 1.0, 2, None), (2, False, 0, 0.0, 0, 5.0), (3, None, None, None, 1, None)],
        "k int, a boolean, b int, c double, e int, f double",
    )
    assert filters.drop_duplicate_columns(df, ["k"]).columns == ["k", "a", "e", "f"]
    assert filters.drop_duplicate_columns(df.select("k", "a"), ["k"]).columns == ["k", "a"]


def test_complete_cases_drop_nan_and_null(spark):
    df = spark.createDataFrame([(1.0, 2.0), (None, 1.0), (float("nan"), 1.0)], "a double, b double")
    assert filters.complete_cases(df, ["a", "b"]).count() == 1
    assert readers.null_for_nan(df, ["a"]).where("a is null").count() == 2


def test_window_predictions_are_capped(make):
    df = make({"A": np.arange(50.0), "B": np.arange(5.0)})
    got = filters.window_predictions(df, "2020-01-03", "2020-01-31", 10, LAYOUT)
    assert got.where("ticker = 'A'").count() == 10 and got.where("ticker = 'B'").count() == 3


# ---- joins ------------------------------------------------------------------------


def test_event_periods():
    assert joins.period_days("2023-02") == ("2023-02-01", "2023-02-28")
    assert joins.period_days("2024") == ("2024-01-01", "2024-12-31")
    assert joins.period_days(("2023-01", "2023-03-05")) == ("2023-01-01", "2023-03-05")


def test_missing_event_days_add_no_rows(make, pdf):
    df = make({"A": np.arange(10.0)})
    got = pdf(joins.event_flags(df, ["2020-01-03", "1999-05-05", ("2020-01-02", "2020-01-04")]))
    assert list(got.event) == [0, 1, 1, 1, 0, 0, 0, 0, 0, 0]


def test_long_event_lists_join_by_day(make, pdf):
    df = make({"A": np.arange(400.0)})
    events = [str(d.date()) for d in pd.date_range("2020-01-01", periods=100, freq="3D")]
    got = pdf(joins.event_flags(df, events))
    assert list(got.event) == [int(i % 3 == 0 and i < 300) for i in range(400)]


def test_event_coverage_keeps_empty_events(make, pdf):
    got = pdf(joins.event_coverage(make({"A": np.arange(10.0)}), [("2020-01-09", "2020-02-01"), ("2021-01-01", "2021-02-01")]), ("event_no",))
    assert list(got.marked) == [2, 0] and list(got.in_range) == [True, False]


def test_strict_alignment(make):
    df = make({"A": np.arange(5.0)})
    exog = df.where("close < 4").select("ticker", "d", F.lit(1).alias("x"))
    assert joins.align(df, exog).count() == 4
    with pytest.raises(ValueError):
        joins.align(df, exog, strict=True)


# ---- calendars -----------------------------------------------------------------------


def test_business_days(spark):
    got = calendars.business_days(spark, "2024-01-05", "2024-01-09").toPandas()
    assert list(got.d) == [dt.date(2024, 1, 5), dt.date(2024, 1, 8), dt.date(2024, 1, 9)]
    with pytest.raises(ValueError):
        calendars.business_days(spark, "2024-01-06", "2024-01-07")


@pytest.mark.parametrize("freq,alias", [("D", "D"), ("W", "W"), ("M", "ME")])
@pytest.mark.parametrize("last", ["2024-01-30", "2024-01-31", "2024-02-03", "2024-02-04"])
def test_future_calendar(make, freq, alias, last):
    df = make({"A": [1.0]}, start=last)
    got = sorted(r.d for r in calendars.future_calendar(df, 4, freq).collect())
    want = pd.date_range(pd.Timestamp(last) + pd.Timedelta(days=1), periods=4, freq=alias)
    assert got == [d.date() for d in want]


def test_calendar_align_truncates(spark):
    fc = spark.createDataFrame([("A", i, float(i)) for i in range(1, 9)], "ticker string, step int, yhat double")
    assert calendars.calendar_align(fc, "2024-01-01", "2024-01-05").count() == 5


# ---- sources and sinks -----------------------------------------------------------------


def test_load_series(spark, tmp_path):
    csv = tmp_path / "s.csv"
    csv.write_text("Date,Close\n2024-01-02,2.5\n2024-01-01,1.5\n")
    df = readers.load_series(spark, str(csv))
    assert dict(df.dtypes)["Date"] == "timestamp" and df.count() == 2
    pd.DataFrame({"Close": [1.0]}, index=pd.DatetimeIndex(["2024-01-01"])).to_parquet(tmp_path / "i.parquet")
    assert "Date" in readers.load_series(spark, str(tmp_path / "i.parquet")).columns
    pd.DataFrame({"Close": [1.0]}).to_parquet(tmp_path / "n.parquet", index=False)
    with pytest.raises(ValueError):
        readers.load_series(spark, str(tmp_path / "n.parquet"))
    with pytest.raises(ValueError):
        readers.load_series(spark, "s3://bucket/file.json")


def test_latest_file(spark, tmp_path):
    import os

    for i, name in enumerate(["spy_1.csv", "gld_9.csv", "spy_2.csv", "new_0.csv"]):
        (tmp_path / name).write_text("x")
        os.utime(tmp_path / name, (1_700_000_000 + i * 10,) * 2)
    assert snapshots.resolve_latest(spark, str(tmp_path), "SPY").endswith("spy_2.csv")
    assert snapshots.resolve_latest(spark, str(tmp_path), "none").endswith("new_0.csv")
    assert snapshots.resolve_latest(spark, str(tmp_path), suffix="_9.csv").endswith("gld_9.csv")
    with pytest.raises(FileNotFoundError):
        snapshots.resolve_latest(spark, str(tmp_path), suffix=".pkl")


def test_newest_ties_keep_the_first_key(spark):
    files = spark.createDataFrame([("b", "2024-01-01"), ("a", "2024-01-01"), ("c", "2023-01-01")], "key string, t string").select("key", F.to_timestamp("t").alias("modified"))
    assert snapshots.latest_snapshot(files).first()["key"] == "a"


def test_trailing_period(make):
    df = make({"A": np.arange(800.0), "B": np.arange(3.0)})
    assert bars.trailing_period(df, "10d").where("ticker = 'A'").count() == 11
    assert bars.trailing_period(df, "1y").where("ticker = 'B'").count() == 3
    assert bars.trailing_period(df, "max").count() == 803
    with pytest.raises(ValueError):
        bars.trailing_period(df, "soon")


def test_guards_and_names(spark, make):
    empty = make({"A": [1.0]}).where("close > 5")
    assert not sinks.has_rows(empty)
    with pytest.raises(ValueError):
        sinks.require_rows(empty, "prices")
    assert sinks.snapshot_path("stock_data/", "SPY", dt.datetime(2024, 1, 2, 3, 4, 5)) == "stock_data/spy_20240102T030405Z.csv"


def test_dispatch(make):
    df = make({"A": np.random.default_rng(0).normal(100, 5, 400)})
    assert datasets.prepare(df, "prophet", events=["2020-02"]).columns == ["ticker", "ds", "y", "event_1"]
    assert "event_1" in datasets.prepare(df, "sarimax", events=[("2020-01-01", "2020-01-05")]).columns
    ml = datasets.prepare(df, "ml", layout=LAYOUT, train_start="2020-01-01", train_end="2020-06-30", test_start="2020-07-01")
    assert {r.split for r in ml.select("split").distinct().collect()} == {"train", "test"}
    assert datasets.prepare(df.withColumn("n", F.col("close")), "lstm", layout=LAYOUT, length=5).count() == 395
    assert datasets.prepare(df, "arima", layout=LAYOUT, start="2020-01-01").count() >= 399
    with pytest.raises(ValueError):
        datasets.prepare(df, "svm")


def test_training_checks(spark, make):
    df = make({"ok": [1.0, 2.0], "flat": [3.0, 3.0], "void": [np.nan, np.nan]})
    got = {r.ticker: r.status for r in quality.training_checks(df, "close").collect()}
    assert got == {"ok": "ok", "flat": "fewer than two values", "void": "all targets null"}
    with pytest.raises(ValueError):
        quality.require_trainable(df, "close")
    text = df.withColumn("close", F.lit("x"))
    assert quality.training_checks(text, "close").first().status == "target not numeric"


def test_recheck_finds_a_leak(make):
    from seriesloom.operators.features import FeatureConfig, build_features

    cfg = FeatureConfig(lags=(1, 3), means=(5,), stds=None, rolls=None, with_dates=False, with_momentum=False, with_technical=False)
    f = build_features(make({"A": np.random.default_rng(1).normal(0, 1, 100)}), cfg, layout=LAYOUT)
    bad = f.withColumn("lag_3", F.when(F.col("d") == F.lit("2020-02-20").cast("date"), F.col("target")).otherwise(F.col("lag_3")))
    got = {r.feature: r.violations for r in quality.leakage_recheck(bad, (1, 3), (5,), layout=LAYOUT).collect()}
    assert got == {"lag_1": 0, "lag_3": 1, "ma_5": 0}


def test_dedupe_and_report(spark):
    df = spark.createDataFrame([(1, 5, "x"), (1, 4, "y"), (2, 1, None)], "k int, o int, v string")
    assert {(r.k, r.v) for r in profiling.dedupe_key(df, ["k"], ["o"]).collect()} == {(1, "y"), (2, None)}
    empty_class = spark.createDataFrame([(1, 1), (1, 1)], "y int, p int")
    rows = {r["class"]: r for r in profiling.classification_report(empty_class, "y", "p", [0, 1]).collect()}
    assert rows[0].precision == 0.0 and rows[1].f1 == 1.0


@pytest.mark.parametrize("n", [1, 90])
@pytest.mark.parametrize("day_granular", [True, False])
def test_event_flags_do_not_depend_on_their_number(spark, n, day_granular):
    from datetime import datetime

    times = [None, datetime(2024, 1, 5, 12), datetime(2024, 1, 5), datetime(2024, 1, 2, 23), datetime(2024, 1, 9)]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(times)], "i int, ts timestamp")
    events = [("2024-01-03", "2024-01-05"), ("2024-01-08", "2024-01-07")][:n]
    events += [(f"1990-01-{1 + k % 28:02d}", f"1990-01-{1 + k % 28:02d}") for k in range(n - 1)]
    got = {r.i: r.event for r in joins.event_flags(df, events, "ts", day_granular=day_granular).collect()}
    assert got == {0: None, 1: int(day_granular), 2: 1, 3: 0, 4: 0}
    assert [r.event for r in joins.event_flags(df, [], "ts").collect()] == [0] * 5


def test_csv_types_are_inferred(spark, tmp_path):
    path = tmp_path / "x.csv"
    path.write_text("Date,Close,Volume\n2024-01-02,1.5,3\n2024-01-03,,4\n")
    df = readers.load_series(spark, str(path))
    assert df.dtypes == [("Date", "timestamp"), ("Close", "double"), ("Volume", "int")]


def test_gram_passes_on_no_more_than_it_reads(spark):
    from seriesloom.plans.gram import _partials, full_matrix, gram

    rng = np.random.default_rng(1)
    k, n = 12, 4000
    x = rng.normal(0, 1, (n, k))
    keys = rng.integers(0, 700, n)
    df = spark.createDataFrame(
        [(f"s{a}", *map(float, r)) for a, r in zip(keys, x)], ["ticker", *(f"c{i}" for i in range(k))]
    )
    got = {r.ticker: full_matrix(r.g, k) for r in gram(df, "ticker", [f"c{i}" for i in range(k)]).collect()}
    assert len(got) == len(set(keys))
    for a in set(keys.tolist()):
        np.testing.assert_allclose(got[f"s{a}"], x[keys == a].T @ x[keys == a], atol=1e-9)
    import pyarrow as pa

    batch = pa.record_batch({"ticker": [f"s{a}" for a in keys], "x": list(x)})
    out = list(_partials("ticker", k, np.triu_indices(k))([batch]))
    assert sum(len(b.column(2).flatten()) for b in out) <= n * k
