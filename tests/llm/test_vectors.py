"""Linked vectors against all pairs by brute force."""

import numpy as np
import pandas as pd
import pytest

from seriesloom.llm import vectors
from seriesloom.llm.queries import QUERIES


def brute(ids, rows, cosine=0.9):
    """Pairs (positions) of equal length with at least this cosine."""
    units = []
    for v in rows:
        v = np.array([np.nan if x is None else x for x in v], np.float64) if v is not None else np.zeros(0)
        with np.errstate(invalid="ignore"):
            good = len(v) and np.isfinite(v).all() and v.any()
        units.append(v / abs(v).max() / np.linalg.norm(v / abs(v).max()) if good else None)
    by_size = {}
    for k, u in enumerate(units):
        if u is not None:
            by_size.setdefault(len(u), []).append(k)
    pairs = set()
    for own in by_size.values():
        own, m = np.array(own), np.stack([units[k] for k in own])
        for a in range(0, len(own), 1000):
            x, y = np.nonzero(m[a : a + 1000] @ m.T >= cosine)
            pairs |= {(p, q) for p, q in zip(own[x + a].tolist(), own[y].tolist()) if p < q}
    return pairs


def classes(n, pairs, names):
    parent = list(range(n))

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a, b in pairs:
        parent[find(a)] = find(b)
    least = {}
    for k in range(n):
        if names[k] is not None:
            r = find(k)
            least[r] = min(names[k], least.get(r, names[k]))
    return [least.get(find(k)) for k in range(n)]


@pytest.mark.parametrize("folder", ["sf0.01", "sf0.1"])
def test_query_finds_what_all_pairs_have(spark, folder):
    sf = f"/root/testdata/{folder}"
    got = QUERIES["op11_vectors"](spark, sf).toPandas().set_index("vec_id").sort_index()
    data = pd.read_parquet(f"{sf}/embeddings.parquet").sort_values("vec_id")
    pairs = brute(data.vec_id.tolist(), data.embedding.tolist())
    degree = np.bincount(np.array(sorted(pairs), int).reshape(-1), minlength=len(data))
    assert (got.n_links.to_numpy() <= degree).all() and got.n_links.sum() >= 0.9 * degree.sum()
    assert (got.kept == (got.index == got.component_id)).all() and len(got) == len(data)
    want = classes(len(data), pairs, data.vec_id.tolist())
    assert (got.component_id.to_numpy() == want).mean() >= 0.99


def test_recall_at_the_threshold(spark):
    """Groups around random directions, with cosines spread from 0.88 to 1."""
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(900, 64))
    rows = np.repeat(centres, 5, 0)
    noise = rng.normal(size=rows.shape)
    rows = rows + noise * rng.uniform(0.05, 0.36, (len(rows), 1))
    df = spark.createDataFrame([(k, r) for k, r in enumerate(rows.tolist())], "vec_id long, embedding array<double>")
    got = vectors.near_vectors(df).toPandas().set_index("vec_id").sort_index()
    pairs = brute(range(len(rows)), rows.tolist())
    degree = np.bincount(np.array(sorted(pairs), int).reshape(-1), minlength=len(rows))
    assert (got.n_links.to_numpy() <= degree).all()
    assert got.n_links.sum() >= 0.95 * degree.sum()


def test_hot_group_and_copies(spark, monkeypatch):
    """A third of the vectors nearly alike and a third equal: counts are exact, blocks are cut."""
    monkeypatch.setattr(vectors, "BLOCK", 64)
    monkeypatch.setattr(vectors, "LEAF", 50)
    rng = np.random.default_rng(4)
    near = rng.normal(size=16) + 0.01 * rng.normal(size=(300, 16))
    rows = np.concatenate([near, np.tile(rng.normal(size=16), (300, 1)), rng.normal(size=(300, 16))])
    df = spark.createDataFrame([(k, r) for k, r in enumerate(rows.tolist())], "vec_id long, embedding array<double>")
    got = vectors.near_vectors(df).toPandas().set_index("vec_id").sort_index()
    pairs = brute(range(900), rows.tolist())
    degree = np.bincount(np.array(sorted(pairs), int).reshape(-1), minlength=900)
    assert (got.n_links.to_numpy()[:600] == degree[:600]).all()
    assert set(got.component_id[:300]) == {0} and set(got.component_id[300:600]) == {300}


def test_edge_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (1, None), (2, []), (3, [0.0, -0.0]), (4, [1.0, nan]), (5, [1.0, None]), (6, [inf, 1.0]),
        (7, [1.0, 0.0]), (8, [2.0, 0.1]), (9, [1.0, 0.0, 0.0]), (10, [1.0, -0.0]), (10, [0.0, 1.0]),
        (None, [0.0, 5.0]), (12, [1e200, 1e199]), (13, [-1.0, 0.0]),
    ]
    df = spark.createDataFrame([(*r, "x", 5) for r in rows], "vec_id long, embedding array<double>, label string, row int")
    got = [tuple(r) for r in vectors.near_vectors(df).collect()]
    pairs = brute([r[0] for r in rows], [r[1] for r in rows])
    degree = np.bincount(np.array(sorted(pairs), int).reshape(-1), minlength=len(rows)).tolist()
    component = classes(len(rows), pairs, [r[0] for r in rows])
    want = [(r[0], d, c, r[0] is not None and r[0] == c) for r, d, c in zip(rows, degree, component)]
    assert sorted(map(str, got)) == sorted(map(str, want))
    assert vectors.near_vectors(df.limit(0)).columns == ["vec_id", "n_links", "component_id", "kept"]
    assert vectors.near_vectors(df.limit(0)).count() == 0
    assert vectors.near_vectors(df.where("vec_id < 4")).count() == 3
