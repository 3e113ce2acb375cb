import random
import re
from collections import Counter

import numpy as np
import pytest

from seriesloom.llm import decontam as D

SF = "/root/testdata/sf0.001"


def words(text):
    return [w for w in re.split(r"[\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+", (text or "").lower()) if w]


def brute(docs, items):
    """Best similarity of each pair over all windows of the item's size."""
    out = {}
    for j, item in items:
        own = words(item)
        if not own:
            continue
        k = min(5, len(own))
        want = Counter(tuple(own[i : i + k]) for i in range(len(own) - k + 1))
        for d, text in docs:
            w = words(text)
            if len(w) < k:
                continue
            sh = [tuple(w[i : i + k]) for i in range(len(w) - k + 1)]
            if not want.keys() & set(sh):
                continue
            best = 0
            for a in range(max(len(sh) - sum(want.values()), 0) + 1):
                got = Counter(sh[a : a + sum(want.values())])
                best = max(best, (got & want).total() / (got | want).total())
            if best >= 0.8:
                out[d, j] = best
    return out


def test_given_tables(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    bench = spark.read.parquet(f"{SF}/benchmark.parquet")
    want = brute(
        [(r.doc_id, r.text) for r in docs.collect()], [(r.item_id, r.text) for r in bench.collect()]
    )
    got = {(r.doc_id, r.item_id): r.similarity for r in D.find_matches(docs, bench).collect()}
    assert got == pytest.approx(want) and want


def test_edited_passages_are_found():
    rng = random.Random(5)
    vocab = [f"w{i}" for i in range(3000)]
    items = [(j, " ".join(rng.choices(vocab, k=rng.randrange(12, 70)))) for j in range(60)]
    docs = []
    for d in range(240):
        own = items[d % 60][1].split()
        for _ in range(rng.randrange(3)):
            edge = rng.choice([0, len(own) - 1, rng.randrange(len(own))])
            own[edge] = rng.choice(vocab)
        if rng.random() < 0.3:
            own.pop(0)
        docs.append((d, " ".join(rng.choices(vocab, k=30)) + ", " + " ".join(own).upper() + "\n" + " ".join(rng.choices(vocab, k=9))))
    want = brute(docs, items)
    block = D.Items([i for i, _ in items], [t for _, t in items])
    got = {(docs[x[0]][0], x[1]): x[5] for x in block.matches([t for _, t in docs])}
    assert len(want) > 100 and got == pytest.approx(want)


def test_multi_index_is_complete():
    rng = np.random.default_rng(1)
    base = rng.integers(0, 1 << 63, 50, np.uint64)
    index = D.MultiIndex(base)
    probes = base.copy()
    for i in range(50):
        for b in rng.choice(64, 20, False):
            probes[i] ^= np.uint64(1) << np.uint64(b)
    q, i, far = index.within(probes)
    assert {(k, k) for k in range(50)} <= set(zip(q.tolist(), i.tolist())) and far.max() <= 20


def test_cases(spark):
    item = "the quick brown fox jumps over the lazy dog again"
    rows = [(1, None), (2, ""), (3, item), (3, item), (4, "x " * 200000 + item), (None, item), (5, "fox")]
    docs = spark.createDataFrame([(a, b, 0, "k") for a, b in rows], "doc_id long, text string, similarity int, item_id string")
    bench = spark.createDataFrame(
        [(7, item), (8, item), (9, None), (10, ""), (11, "Fox!")], "item_id long, text string"
    )
    got = Counter((r.doc_id, r.item_id) for r in D.find_matches(docs, bench).collect())
    full = {(d, j): (2 if d == 3 else 1) for d in (3, 4, None) for j in (7, 8, 11)}
    assert got == full | {(5, 11): 1}
    assert sorted(r.doc_id for r in D.drop_contaminated(docs, bench).collect()) == [1, 2]
    assert D.find_matches(docs.limit(0), bench).count() == 0
    assert D.find_matches(docs, bench.limit(0)).count() == 0
    assert D.drop_contaminated(docs, bench.limit(0)).count() == len(rows)
