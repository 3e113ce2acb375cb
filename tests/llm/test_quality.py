import math
import re
from collections import Counter

import pytest
import xxhash

from seriesloom.llm import quality as Q

SF = "/root/testdata/sf0.01"


def base(text):
    text = text or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    count = Counter(tuple(w[i : i + 5]) for i in range(len(w) - 4))
    at = {i + k for i in range(len(w) - 4) if count[tuple(w[i : i + 5])] > 1 for k in range(5)}
    failed = len(w) < 10 or 100 * len(at) > 20 * len(w)
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(at), failed


def signed(h):
    return h - (1 << 64) if h >> 63 else h


def grams(text):
    """Buckets by the hash that Spark documents: xxHash64 with seed 42, chained over columns."""
    h = [xxhash.xxh64_intdigest(w.encode(), 42) for w in re.findall(r"[^\x20\x09-\x0D]+", text or "")]
    one = [xxhash.xxh64_intdigest(x.to_bytes(8, "little"), 42) for x in h]
    two = [xxhash.xxh64_intdigest(y.to_bytes(8, "little"), x) for x, y in zip(one, h[1:])]
    return [signed(x) % Q.BUCKETS for x in one + two]


def test_given_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    rows = {r.doc_id: r for r in Q.judge(docs, labels).collect()}
    texts = {r.doc_id: r.text for r in docs.collect()}
    fit = Q.fit_labels(labels).collect()
    target = {r.doc_id for r in fit if r.model and r.trusted}
    raw, good = Counter(), Counter()
    for i, t in texts.items():
        g = grams(t)
        raw.update(g)
        if i in target:
            good.update(g)
    a, b = sum(good.values()) + Q.BUCKETS, sum(raw.values()) + Q.BUCKETS
    ratio = [math.log((good[k] + 1) / a) - math.log((raw[k] + 1) / b) for k in range(Q.BUCKETS)]
    for i, t in texts.items():
        r, g = rows[i], grams(t)
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == base(t)
        assert r.score == pytest.approx(sum(ratio[k] for k in g) / len(g) if g else 0, abs=1e-9)
    # One cut for all: no kept document scores a whole step below a rejected sound one.
    sound = [r for r in rows.values() if not r.base_failed]
    kept = [math.floor(r.score / Q.STEP) for r in sound if r.kept]
    gone = [math.floor(r.score / Q.STEP) for r in sound if not r.kept]
    assert not gone or max(gone) < min(kept)
    clean = [r for r in fit if r.trusted and not rows[r.doc_id].base_failed]
    assert sum(rows[r.doc_id].kept for r in clean) >= 0.98 * len(clean)


CASES = [
    None, "", " \n\t ", "a", "a b c d e a b c d e", "x\nx\n \nx y\n", "a\x0bb\x0cc", "é ñ # <b> 漢字",
    "p q r s t " * 30, "one two three four five six seven eight nine ten",
]


def test_cases(spark):
    rows = [(i, t) for i, t in enumerate(CASES)] + [(4, CASES[4]), (None, "null id"), (77, "long " * 60000)]
    df = spark.createDataFrame([(*r, "k") for r in rows], "doc_id long, text string, kept string")
    labels = spark.createDataFrame([(9, 1, 0), (9, 0, 0), (None, 1, 0), (5, None, 0)], "doc_id long, quality int, toxic int")
    for use in (labels, labels.limit(0)):
        got = Q.judge(df, use).collect()
        assert len(got) == len(rows)
        for r in got:
            assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == base(r.text)
            assert r.kept is False or not r.base_failed
    assert Q.judge(df.limit(0), labels).count() == 0
    assert Q.keep_good(df, labels.limit(0)).columns == df.columns
    plain = df.select("doc_id", "text").withColumns({"score": Q.F.lit(0.5), "n_words": Q.F.lit(7), "kept": Q.F.lit("mine")})
    own = Q.keep_good(plain, labels.limit(0)).collect()
    assert own and all((r.score, r.n_words, r.kept) == (0.5, 7, "mine") for r in own)


def test_every_label_counts(spark):
    n = 24_000  # more than the 20,000 that were once drawn
    texts = [f"w{i % 13} v{i % 7} u{i} t{i % 5}" for i in range(n)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    labels = docs.select("doc_id", (Q.F.col("doc_id") % 3 > 0).cast("int").alias("quality"), Q.F.lit(0).alias("toxic"))
    fit = Q.fit_labels(labels).collect()
    assert len(fit) == n
    target = {r.doc_id for r in fit if r.model and r.trusted}
    raw, good = Counter(), Counter()
    found = [grams(t) for t in texts]
    for i, g in enumerate(found):
        raw.update(g)
        if i in target:
            good.update(g)
    a, b = sum(good.values()) + Q.BUCKETS, sum(raw.values()) + Q.BUCKETS
    ratio = [math.log((good[k] + 1) / a) - math.log((raw[k] + 1) / b) for k in range(Q.BUCKETS)]
    want = [sum(ratio[k] for k in g) / len(g) for g in found]
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)  # labels beyond a broadcast
    try:
        got = Q.judge(docs, labels).collect()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert len(got) == n
    assert all(r.score == pytest.approx(want[r.doc_id], abs=1e-9) for r in got)
