import collections
import math
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from seriesloom.llm import classlm as L

SF = "/root/testdata/sf0.001"


def tokens(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x20\x09-\x0D]+", low) + [None]


@pytest.fixture(scope="module")
def scored(spark):
    from seriesloom.llm.base import QUERIES

    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    return docs, QUERIES["op9_classlm"](spark, SF).collect()


def test_base_against_brute_force(scored):
    docs, rows = scored
    held = lambda i: zlib.crc32(str(i).encode()) % 7 == 2
    c = collections.Counter(t for i, x in docs.items() if not held(i) for t in tokens(x))
    n, v = sum(c.values()), len(c)
    assert sorted(r.doc_id for r in rows) == sorted(docs)
    for r in rows:
        own = tokens(docs[r.doc_id])
        assert (r.held_out, r.n_tokens, r.train_tokens) == (held(r.doc_id), len(own), n)
        assert r.n_known == sum(c[t] > 0 for t in own)
        assert r.base_score == pytest.approx(sum(math.log10((c[t] + 1) / (n + v + 1)) for t in own))


def test_held_out_texts_are_likelier_than_by_the_base(scored):
    _, rows = scored
    own = [r for r in rows if r.held_out]
    assert sum(r.score for r in own) > sum(r.base_score for r in own)
    assert all(r.score < 0 for r in rows)


def test_probabilities_sum_to_one(spark):
    texts = ["a b a c", "b a b", "c c a b d"] * 5
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    tails = ["a", "b", "c", "d", ""]
    probe = [(100 + i, t) for i, t in enumerate(tails)]
    got = {
        r.doc_id: r.score
        for r in L.score(
            docs.union(spark.createDataFrame(probe, docs.schema)), F.col("doc_id") >= 100
        ).collect()
    }
    assert all(got[i] < 0 for i in got)
    # The empty text is as likely as an end after an end; never certain, never impossible.
    assert 0 < 10 ** got[104] < 1


def test_exchange_finds_two_kinds(spark):
    rng = np.random.default_rng(1)
    text = " ".join(f"n{rng.integers(8)} v{rng.integers(8)}" for _ in range(4000))
    docs = spark.createDataFrame([(0, text)], "doc_id long, text string")
    counts = L.word_counts(docs).orderBy(F.desc("c"), "h").toPandas()
    words = counts.h[counts.h != L.END].to_numpy()
    model, _ = L.cluster(docs, words, sweeps=4)
    import pyarrow as pa

    def classes(names):
        h, _ = L.token_stream(pa.record_batch({"text": pa.array(names)}))
        h = h[h != L.END]
        return set(model.of(h, model.rank(h)).tolist())

    nouns, verbs = classes([f"n{i}" for i in range(8)]), classes([f"v{i}" for i in range(8)])
    assert not nouns & verbs


def test_cases(spark):
    rows = [(1, None, "x"), (2, "", "x"), (3, "A b", "x"), (3, "A b", "x"), (None, "a " * 300000, "y")]
    df = spark.createDataFrame(rows, "doc_id long, text string, score string")
    got = L.score(df, F.col("doc_id") == 2).collect()
    assert sorted(r.n_tokens for r in got) == [1, 1, 3, 3, 300001]
    assert L.score(df.limit(0), F.lit(False)).count() == 0
    unseen = L.score(df, F.lit(True)).collect()
    assert all(r.train_tokens == 0 and r.n_known == 0 and math.isfinite(r.score) for r in unseen)


def _corpus(spark):
    rng = np.random.default_rng(5)
    nouns, verbs = [f"n{i}" for i in range(60)], [f"v{i}" for i in range(60)]
    weights = 1 / np.arange(1, 61)
    pick = lambda x: x[rng.choice(60, p=weights / weights.sum())]
    rows = []
    for i in range(120):
        words = [pick(nouns) if j % 2 else pick(verbs) for j in range(rng.integers(0, 60))]
        if i % 5 == 0:
            words += [f"rare{i}", f"odd{i}", pick(nouns)]
        rows.append((i, " ".join(words)))
    return spark.createDataFrame(rows, "doc_id long, text string"), dict(rows)


def test_what_goes_to_the_tasks_changes_no_score(spark):
    docs, _ = _corpus(spark)
    got = []
    for head in (0, 20, 1 << 18):
        rows = L.score(docs, F.col("doc_id") % 7 == 2, seeded=8, head=head, min_count=3).collect()
        got.append({r.doc_id: (r.n_known, r.base_score, r.score) for r in rows})
    for other in got[1:]:
        for i, x in got[0].items():
            assert other[i] == pytest.approx(x, rel=1e-9)


def test_score_against_brute_force(spark, monkeypatch):
    """Transitions and emissions counted word by word from the classes the model chose."""
    docs, texts = _corpus(spark)
    found = {}
    look_up = L.transitions

    def spy(train, head, words):
        found.update({r.h: r.k for r in words.collect()})
        return look_up(train, head, words)

    monkeypatch.setattr(L, "transitions", spy)
    rows = L.score(docs, F.col("doc_id") % 7 == 2, seeded=8, head=20, min_count=3).collect()
    import pyarrow as pa

    stream = lambda x: L.token_stream(pa.record_batch({"text": pa.array([x])}))[0].tolist()
    kind = lambda h: L.END_CLASS if h == L.END else found.get(h, L.CLASSES + (h & 15))
    steps, words = collections.Counter(), collections.Counter()
    for i, x in texts.items():
        if i % 7 != 2:
            h = stream(x)
            words.update(h)
            steps.update(zip([L.END_CLASS, *map(kind, h)], map(kind, h)))
    outgoing, room = collections.Counter(), collections.Counter()
    for (a, _), c in steps.items():
        outgoing[a] += c
    for h, c in words.items():
        room[kind(h)] += c + L.ADD_WORD
    # Every word counted often enough has an exchanged class.
    assert all((kind(h) < L.CLASSES) == (c >= 3) for h, c in words.items() if h != L.END)
    for r in rows:
        h, want = stream(texts[r.doc_id]), 0.0
        for a, b in zip([L.END, *h], h):
            a_, b_ = kind(a), kind(b)
            want += math.log10((steps[a_, b_] + L.ADD_CLASS) / (outgoing[a_] + L.ADD_CLASS * L.K))
            if b != L.END:
                want += math.log10((words[b] + L.ADD_WORD) / (room[b_] + L.ADD_WORD))
        assert r.score == pytest.approx(want)


def test_further_words_join_their_kind(spark):
    docs, _ = _corpus(spark)
    h, c = (L.word_counts(docs).toArrow().column(x).to_numpy() for x in ("h", "c"))
    words = h[np.lexsort((h, -c))]
    words = words[words != L.END]
    seeded, sums = L.cluster(docs, words[:8], sweeps=4)
    profiles = L.word_profiles(docs, seeded, 5)
    got = {r.h: r.k for r in L.exchange_all(profiles, sums, 4).collect()}
    assert len(got) == sum(c[h != L.END] >= 5) - 8
    import pyarrow as pa

    stream = lambda x: L.token_stream(pa.record_batch({"text": pa.array([x])}))[0].tolist()
    of = lambda p: {got[h] for h in stream(" ".join(f"{p}{i}" for i in range(60))) if h in got}
    assert not of("n") & of("v")
