"""Boosted trees per series: splits against a direct search, both ways of fitting, scoring."""

import numpy as np
import pytest

from seriesloom.operators import boosting, trees

COLS = ["x1", "x2", "x3"]


def sample(rng, n, steps=12):
    x = rng.integers(0, steps, (n, 3)).astype(float)
    y = 3 * (x[:, 0] > 4) + x[:, 1] * (x[:, 2] > 7) + rng.normal(0, 0.1, n)
    return x, y


@pytest.fixture(scope="module")
def table(spark):
    rng = np.random.default_rng(2)
    rows = []
    for ticker, n in (("A", 400), ("B", 90), ("C", 1)):
        x, y = sample(rng, n)
        x[rng.random(x.shape) < 0.05] = np.nan
        rows += [(ticker, int(k), *(None if np.isnan(v) else float(v) for v in x[k]), float(y[k])) for k in range(n)]
    rows += [(None, 0, 1.0, 1.0, 1.0, 5.0), ("A", 900, 1.0, 1.0, 1.0, None)]
    return spark.createDataFrame(rows, "ticker string, k long, x1 double, x2 double, x3 double, label double").cache()


def direct(x, y):
    """The largest fall of squared error over all cuts between values, NaN on the right."""
    best = (0.0, None, None)
    for j in range(x.shape[1]):
        for c in np.unique(x[~np.isnan(x[:, j]), j]):
            left = x[:, j] <= c
            if 0 < left.sum() < len(y):
                parts = sum(((p - p.mean()) ** 2).sum() for p in (y[left], y[~left]))
                gain = ((y - y.mean()) ** 2).sum() - parts
                if gain > best[0] + 1e-9:
                    best = (gain, j, c)
    return best


def test_splits_equal_a_direct_search(table):
    model = trees.gbt_fit(table, COLS, rounds=1, depth=3)
    data = table.where("ticker = 'A' and label is not null").toPandas()
    x, y = data[COLS].to_numpy(float), data["label"].to_numpy()
    nodes = {r.node: r for r in model.nodes.where("ticker = 'A' and round = 0").collect()}
    todo, seen = [(1, np.ones(len(y), bool))], 0
    while todo:
        node, use = todo.pop()
        got = nodes[node]
        assert got.n == use.sum()
        gain, j, cut = direct(x[use], y[use])
        if node >= 8 or j is None:
            assert got.feature == -1
            assert got.value == pytest.approx((y[use] - y.mean()).mean(), abs=1e-4)
            continue
        assert got.gain == pytest.approx(gain, rel=1e-3, abs=1e-4) and (got.feature, got.cut) == (j, cut)
        seen += 1
        left = x[:, j] <= cut
        todo += [(2 * node, use & left), (2 * node + 1, use & ~left)]
    assert seen == 7


def test_long_series_get_the_same_trees(table):
    """Level by level over chunks, margins stored in between, against whole series in a task."""
    kw = {"rounds": 12, "depth": 2}
    whole = trees.gbt_fit(table, COLS, **kw)
    cut = boosting.boost_fit(table, COLS, task_rows=100, chunk_rows=150, **kw)
    a, b = (sorted(map(tuple, m.nodes.collect())) for m in (whole, cut))
    assert [r[:5] + r[-1:] for r in a] == [r[:5] + r[-1:] for r in b]
    np.testing.assert_allclose([r[5:8] for r in a], [r[5:8] for r in b], rtol=1e-9, atol=1e-12)


def test_scores_learn_and_keep_all_rows(spark, table, monkeypatch):
    model = trees.gbt_fit(table, COLS)
    monkeypatch.setattr(boosting, "SCORE_ROWS", 64)
    other = table.withColumn("d", trees.F.current_date()).unionByName(
        spark.createDataFrame([("Z", 1, 1.0, 1.0, 1.0, 0.0)], table.schema).withColumn("d", trees.F.current_date())
    )
    got = trees.gbt_score(model, other, COLS).toPandas()
    assert len(got) == other.count() and got.columns.tolist() == [*other.columns, "yhat"]
    assert got[got.ticker.isna() | (got.ticker == "Z")].yhat.isna().all()
    a = got[(got.ticker == "A") & got.label.notna()]
    assert ((a.label - a.yhat) ** 2).mean() < 0.05 * a.label.var()
    c = got[got.ticker == "C"]
    assert c.yhat.iloc[0] == pytest.approx(c.label.iloc[0])
    again = boosting.Boosted.load(model.nodes, COLS)
    assert again.transform(other).where("yhat is not null").count() == got.yhat.notna().sum()


def test_importances_are_shares_of_gain(table):
    got = trees.feature_importance(trees.gbt_fit(table, COLS, rounds=3), COLS).toPandas()
    assert got.groupby("ticker").size().to_dict() == {"A": 3, "B": 3, "C": 3}
    sums = got.groupby("ticker").importance.sum()
    assert sums["A"] == pytest.approx(1) and sums["C"] == 0
    assert got[got.ticker == "A"].importance.is_monotonic_decreasing


def test_filtered_features_plan_quickly(spark):
    import time

    from seriesloom.catalog.models import _ml

    began = time.monotonic()
    _ml(spark, "/root/testdata/sf0.001").where("split = 'train'")._jdf.queryExecution().optimizedPlan()
    assert time.monotonic() - began < 30
