import random
import re

import numpy as np
import pytest

from seriesloom.llm import jaccard as J
from seriesloom.llm.base import QUERIES

SF = "/root/testdata/sf0.001"


def shingles(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    return tuple(w), frozenset(tuple(w[i : i + 5]) for i in range(max(len(w) - 4, min(len(w), 1))))


def brute(docs):
    """{row: (class row, links, copies)}"""
    info = {r: shingles(t) for r, t in docs}
    texts = {}
    for r, (w, _) in sorted(info.items()):
        texts.setdefault(w, []).append(r)
    reps = [(rows[0], info[rows[0]][1]) for rows in texts.values()]
    parent = {r: r for r, _ in reps}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    links = dict.fromkeys(parent, 0)
    for i, (a, x) in enumerate(reps):
        for b, y in reps[:i]:
            if x and y and 5 * len(x & y) >= 4 * len(x | y):
                links[a] += 1
                links[b] += 1
                p, q = sorted((find(a), find(b)))
                parent[q] = p
    return {
        r: (find(rows[0]), links[rows[0]], len(rows) - 1) for rows in texts.values() for r in rows
    }


def got(df):
    return {r.row: (r.class_row, r.n_links, r.n_copies) for r in df.collect()}


def test_given_documents(spark):
    want = brute([(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()])
    rows = QUERIES["op6_jaccard"](spark, SF).collect()
    assert {r.doc_id: (r.class_id, r.n_links, r.n_copies) for r in rows} == want
    assert any(n for _, n, _ in want.values())


def edited(rng, words, k):
    own = list(words)
    for _ in range(k):
        own[rng.randrange(len(own))] = f"n{rng.randrange(10**6)}"
    return " ".join(own)


def test_groups_and_blocks(spark):
    rng = random.Random(1)
    docs = []
    for g in range(12):
        base = [f"w{rng.randrange(4000)}" for _ in range(rng.randrange(60, 200))]
        docs += [edited(rng, base, rng.randrange(5)) for _ in range(rng.choice([1, 2, 5, 90]))]
    docs += [docs[3], docs[3], "a b", "a b", "a  b", "", None, " ", "c"]
    rng.shuffle(docs)
    rows = list(enumerate(docs))
    df = spark.createDataFrame([(i, t, 0) for i, t in rows], "row long, text string, n_links int")
    want = brute(rows)
    assert got(J.link(df)) == want
    assert got(J.link(df, block=16)) == want
    assert J.link(df.limit(0)).count() == 0


def test_repeated_and_null_ids(spark):
    rows = [(1, "a b c d e f"), (1, "a b c d e f"), (None, "x"), (None, None), (2, "z " * 100000)]
    df = J.numbered(spark.createDataFrame(rows, "doc_id long, text string"))
    assert df.select("row").distinct().count() == 5
    assert sorted(v[1:] for v in got(J.link(df)).values()) == [(0, 0), (0, 0), (0, 0), (0, 1), (0, 1)]


def test_pruning_keeps_pairs_at_the_threshold():
    rng = np.random.default_rng(2)
    lost = met = 0
    for _ in range(400):
        pool = rng.integers(0, 1 << 63, 200, np.uint64)
        a, b = np.sort(pool[:180]), np.sort(pool[20:])  # 160 shared of 200
        v = np.stack([J.minhash(a), J.minhash(b)])
        met += bool((J.band_keys(v)[0] == J.band_keys(v)[1]).any())
        lost += not len(J.survivors(v, np.array([0]), np.array([1])))
    assert lost <= 2 and met >= 399
    assert list(J.least_matches()) == sorted(J.least_matches())
    far = np.stack([J.minhash(rng.integers(0, 1 << 63, 200, np.uint64)) for _ in range(2)])
    assert not len(J.survivors(far, np.array([0]), np.array([1])))


def test_components(spark):
    rng = random.Random(3)
    edges = [(i, i + 1) for i in range(100, 160)] + [(rng.randrange(60), rng.randrange(60)) for _ in range(40)]
    df = spark.createDataFrame([(a, b) for a, b in edges], "a long, b long")
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in edges:
        p, q = sorted((find(a), find(b)))
        parent[q] = p
    want = {x: find(x) for a, b in edges for x in (a, b) if a != b}
    assert {r.node: r.root for r in J.components(df).collect()} == want


def test_keep_first_leaves_own_columns_alone(spark):
    text = " ".join(f"w{k}" for k in range(40))
    df = spark.createDataFrame([(1, text, 1000, "a"), (2, text, 2000, "b"), (3, "other text", 3000, "c")], "doc_id long, text string, row int, id string")
    assert sorted(map(tuple, J.keep_first(df).collect())) == [(1, text, 1000, "a"), (3, "other text", 3000, "c")]
