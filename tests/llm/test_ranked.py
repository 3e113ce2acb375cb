"""NRA against full sums, and the search against a plain rank of all documents."""

import math
import re
from collections import Counter

import numpy as np
import pytest
from check_oracles import compare, duck

from seriesloom.llm import ranked
from seriesloom.llm.queries import ORACLES, QUERIES


@pytest.mark.parametrize("seed", range(5))
def test_first_k_equals_full_sums(seed):
    rng = np.random.default_rng(seed)
    early = 0
    for _ in range(60):
        n, k = int(rng.integers(1, 3000)), int(rng.integers(1, 12))
        lists, total = [], np.zeros(n, np.int64)
        for _ in range(int(rng.integers(1, 9))):
            docs = rng.permutation(n)[: int(rng.integers(1, n + 1))]
            impacts = -np.sort(-(rng.pareto(0.6, len(docs)) * 10 + 1).astype(np.int64))
            if rng.random() < 0.3:
                impacts = np.minimum(impacts, 3)  # many ties
            lists.append((docs, impacts))
            total[docs] += impacts
        docs, scores, read = ranked.first_k(lists, n, k)
        want = [x for x in np.lexsort((np.arange(n), -total))[:k] if total[x] > 0]
        assert docs.tolist() == want and scores.tolist() == total[want].tolist()
        early += read < sum(len(d) for d, _ in lists)
    assert early  # some searches stop before the lists' ends


TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def terms(text):
    return TERM.findall((text or "").translate(LOWER))


def brute(docs, items):
    counts = [Counter(terms(t)) for _, t in docs]
    n_docs, total = sum(map(bool, counts)), sum(c.total() for c in counts)
    df = Counter(t for c in counts for t in c)
    out = []
    for item, text in items:
        scored = []
        for (doc, _), c in zip(docs, counts):
            m = 25 + 75 * c.total() * n_docs // max(total, 1)
            s = sum(
                math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 8 * m))
                for t in terms(text) if t in c
            )
            if s > 0:
                scored.append((-s, doc is None, doc))
        out += [(item, r, d, -s) for r, (s, _, d) in enumerate(sorted(scored)[:10], 1)]
    return sorted(map(str, out))


def test_edge_rows(spark):
    docs = [
        (5, "Ärger ärger x"), (4, "x X x, y"), (4, "x X x, y"), (None, "y y y"), (3, None), (2, ""), (1, " \t!?"),
        (9, "y " * 30000 + "Zz9"), (8, " a "), (7, "zz9\x00zz9 É"),
    ]
    items = [(1, "x y x"), (1, "x y x"), (None, "zz9 É"), (3, None), (4, "?"), (6, "ÄRGER ärger"), (7, "y x zz9  a ")]
    d = spark.createDataFrame([(*r, "clash") for r in docs], "doc_id long, text string, score string")
    q = spark.createDataFrame([(*r, 1) for r in items], "item_id long, text string, rank int")
    for postings in (3, 10**6):
        got = ranked.search(d, q, postings=postings).collect()
        assert sorted(str(tuple(r)) for r in got) == brute(docs, items)
    assert ranked.search(d.limit(0), q).count() == 0
    assert ranked.search(d, q.limit(0)).columns == ["item_id", "rank", "doc_id", "score"]


def test_small_pieces_and_blocks(spark, monkeypatch):
    monkeypatch.setattr(ranked, "BLOCK_ITEMS", 7)
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text")
    items = spark.read.parquet(f"{sf}/benchmark.parquet").select("item_id", "text").limit(15)
    got = ranked.search(docs.repartition(5), items, postings=2000).collect()
    assert sorted(str(tuple(r)) for r in got) == brute([tuple(r) for r in docs.collect()], [tuple(r) for r in items.collect()])


def test_query_equals_sql(spark):
    sf = "/root/testdata/sf0.001"
    verdict, *_ = compare(spark, duck(sf), QUERIES["op13_ranked"], ORACLES["op13_ranked"], sf)
    assert verdict == "ok", verdict
