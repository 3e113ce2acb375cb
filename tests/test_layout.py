import numpy as np
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from seriesloom import Layout, lay_out
from seriesloom.functions import rolling
from seriesloom.operators.features import FeatureConfig, build_features
from seriesloom.plans.layout import POS, SLICE, sliced, with_positions
from seriesloom.plans.quantiles import exact_quantiles

RNG = np.random.default_rng(5)
SERIES = {
    "A": np.where(np.arange(230) % 9 == 4, np.nan, RNG.normal(100, 5, 230)),
    "B": RNG.normal(50, 2, 61),
    "C": np.array([7.0]),
}


def test_positions_running_and_padding(make, pdf):
    df = make(SERIES)
    layout = Layout(slice_days=17)
    got = pdf(with_positions(df, layout, pad=["close"], running={"total": F.col("close")}))
    for t, v in SERIES.items():
        mine = got[got.ticker == t]
        assert list(mine[POS]) == list(range(len(v)))
        s = __import__("pandas").Series(v)
        np.testing.assert_allclose(mine.close, s.ffill())
        np.testing.assert_allclose(mine.total, s.fillna(0).cumsum())


@pytest.mark.parametrize("rows,slice_days", [(20, 7), (33, 1000), (64, 50)])
def test_buckets_equal_uncut_windows(make, pdf, rows, slice_days):
    df = make(SERIES)
    w = Window.partitionBy("ticker").orderBy("d")

    def cols(spec):
        return {
            "back": F.avg("close").over(spec.rowsBetween(-20, -1)),
            "lag": F.lag("close", 20).over(spec),
            "ahead": F.lead("close", 7).over(spec),
            "both": F.sum("close").over(spec.rowsBetween(-3, 6)),
        }

    want = pdf(df.withColumns(cols(w)))
    laid = lay_out(df, Layout(rows=rows, slice_days=slice_days), back=20, ahead=7)
    got = pdf(laid.with_columns(cols(laid.w)).close())
    assert list(got.columns) == list(want.columns)
    __import__("pandas").testing.assert_frame_equal(got, want, rtol=1e-12)


def test_rows_with_null_key_or_time_are_kept(spark):
    df = spark.createDataFrame(
        [("A", 1, 1.0), (None, 2, 2.0), ("A", None, 3.0)], "ticker string, n int, close double"
    ).select("ticker", F.date_add(F.lit("2020-01-01").cast("date"), "n").alias("d"), "close")
    assert lay_out(df, Layout(rows=5), back=2).close().count() == 3


def test_features_ignore_the_current_and_later_rows(make, pdf):
    """No shifted feature may move when the current or a later value changes."""
    cfg = FeatureConfig(lags=(1, 5), means=(5, 10), stds=(5,), rolls=(5,), with_dates=False, with_momentum=False)
    a = RNG.normal(100, 5, 80)
    b = a.copy()
    b[60:] = 1e6
    layout = Layout(rows=50, slice_days=20)
    x = pdf(build_features(make({"A": a}), cfg, layout=layout, target_diff=False)).iloc[:61]
    y = pdf(build_features(make({"A": b}), cfg, layout=layout, target_diff=False)).iloc[:61]
    __import__("pandas").testing.assert_frame_equal(x.drop(columns="target"), y.drop(columns="target"))


def test_notebook_features_ignore_the_current_row(make, pdf):
    a = RNG.normal(100, 5, 120)
    b = a.copy()
    b[100:] = 1e6
    cfg, layout = FeatureConfig.notebook(), Layout(rows=40, slice_days=20)
    x = pdf(build_features(make({"A": a}), cfg, layout=layout, target_diff=False)).iloc[:51]
    y = pdf(build_features(make({"A": b}), cfg, layout=layout, target_diff=False)).iloc[:51]
    __import__("pandas").testing.assert_frame_equal(x.drop(columns="target"), y.drop(columns="target"))


def test_exact_quantiles_by_bracketing(spark):
    v = np.concatenate([RNG.lognormal(3, 2, 4000), np.full(3000, 12.5), RNG.integers(0, 9, 1000)])
    df = spark.createDataFrame([(float(x), None if i % 5 == 0 else float(-x)) for i, x in enumerate(v)], "a double, b double")
    qs = (0.0, 0.25, 0.5, 0.731, 0.75, 1.0)
    got = exact_quantiles(df, ["a", "b"], qs, small=50, accuracy=100)
    b = np.array([-x for i, x in enumerate(v) if i % 5])
    for q in qs:
        assert got["a"][q] == pytest.approx(np.quantile(v, q), rel=1e-12)
        assert got["b"][q] == pytest.approx(np.quantile(b, q), rel=1e-12)
    empty = exact_quantiles(df.where("a < -1"), ["a"], (0.5,))
    assert empty["a"][0.5] is None


def test_window_lists():
    assert rolling.as_windows(4, 2) == [2, 3, 4]
    assert rolling.as_windows((5, 9), 2) == [5, 9]


def test_busy_slices_are_split(make, pdf):
    df = make(SERIES)
    layout = Layout(slice_days=100_000, slice_rows=3)
    sizes = sliced(df, layout).groupBy("ticker", SLICE).count()
    assert sizes.agg(F.max("count")).first()[0] <= 3
    got = pdf(with_positions(df, layout, running={"total": F.col("close")}))
    for t, v in SERIES.items():
        mine = got[got.ticker == t]
        assert list(mine[POS]) == list(range(len(v)))
        np.testing.assert_allclose(mine.total, __import__("pandas").Series(v).fillna(0).cumsum())


def test_busy_slices_with_ties_and_nulls(spark):
    rows = [("A", 5, i) for i in range(40)] + [("A", 1, 50), ("A", 9, 51), (None, 2, 52), ("A", None, 53)]
    df = spark.createDataFrame(rows, "ticker string, n int, id int").select(
        "ticker", F.date_add(F.lit("2020-01-01").cast("date"), "n").alias("d"), "id"
    )
    layout = Layout(slice_rows=4, tie=("id",))
    got = with_positions(df, layout).where("d IS NOT NULL AND ticker IS NOT NULL").orderBy(POS)
    assert [r.id for r in got.collect()] == [50, *range(40), 51]
    assert with_positions(df, layout).count() == len(rows)
    assert with_positions(df.limit(0), layout).count() == 0
