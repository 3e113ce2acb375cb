"""Runs against a direct search over all periods, and the query's digests against plain Python."""

import hashlib
import random
import zlib

import numpy as np
import pytest

from seriesloom.llm.periodic import QUERY_COLUMNS, find_runs, runs, text_runs, _hashes
from seriesloom.llm.queries import QUERIES


def brute(words, least=12):
    """Every (start, length, period): the smallest period first claims a stretch."""
    n, out = len(words), {}
    for p in range(1, n // 2 + 1):
        i = 0
        while i + p < n:
            j = i
            while j + p < n and words[j] == words[j + p]:
                j += 1
            if j > i and j - i + p >= max(2 * p, least):
                out.setdefault((i, j - i + p), p)
            i = j + 1 if j == i else j
    return sorted(((s, n_, p) for (s, n_), p in out.items()), key=lambda r: (r[0], r[2]))


@pytest.mark.parametrize("seed", range(4))
def test_runs_equal_a_direct_search(seed):
    rng = random.Random(seed)
    for _ in range(300):
        n, k = rng.randint(0, 70), rng.randint(1, 4)
        word = [rng.randrange(k) for _ in range(n)]
        if n and rng.random() < 0.5:
            word = (word[: rng.randint(1, n)] * n)[:n]
        for least in (2, 12):
            assert [tuple(r) for r in runs(np.array(word, np.int64), least).tolist()] == brute(word, least)
        as_bytes = [b"%d" % x for x in word]
        assert [tuple(r) for r in text_runs(_hashes(as_bytes), as_bytes).tolist()] == brute(word)


def expected(doc_id, text):
    words = (text or "").encode().split()
    h = 1 if doc_id is None else zlib.crc32(str(doc_id).encode())
    if h % 10 == 0 and words:
        g, n = h // 10, len(words)
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = words[:a] + [words[a + (i - a) % p] for i in range(a, n)]
    found = brute(words)
    gone = {k for s, n, p in found for k in range(s + p, s + n)}
    best = max(found, key=lambda r: (r[1], -r[0], -r[2]), default=None)
    kept = b" ".join(w for k, w in enumerate(words) if k not in gone)
    listed = "".join("%d,%d,%d\n" % r for r in found)
    top = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
    return (doc_id, len(found), *top, hashlib.sha256(listed.encode()).hexdigest(), hashlib.sha256(kept).hexdigest())


def test_query_on_all_documents(spark):
    sf = "/root/testdata/sf0.001"
    got = {tuple(r) for r in QUERIES["op12_periodic"](spark, sf).select(*QUERY_COLUMNS).collect()}
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    assert got == {expected(*r) for r in docs}
    assert sum(r[1] > 0 for r in got) >= 10


def test_edge_rows(spark, tmp_path):
    cycle = " ".join(["ein", "zwei", "drei"] * 9)
    rows = [
        (None, cycle, "x"), (7, None, None), (8, "", "y"), (9, " \t\n", "y"), (9, " \t\n", "y"),
        (11, cycle, "z"), (12, "ä " * 30, "z"), (13, " ".join(map(str, range(500))) + " " + "lang " * 700, "z"),
        (14, "a\x0bb\x0cc\rd " * 6, "z"), (15, "a b " * 12, "z"),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string, runs string")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    got = QUERIES["op12_periodic"](spark, str(tmp_path)).select(*QUERY_COLUMNS).collect()
    assert sorted(map(str, map(tuple, got))) == sorted(str(expected(*r[:2])) for r in rows)
    own = find_runs(docs.withColumnRenamed("doc_id", "row")).where("row = 11").first()
    assert own.collapsed == "ein zwei drei" and [tuple(r) for r in own.runs] == [(0, 27, 3)]
    empty = find_runs(docs.withColumnRenamed("doc_id", "row").limit(0))
    assert empty.columns == ["row", "n_words", "runs", "collapsed"] and empty.count() == 0
