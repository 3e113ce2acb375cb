import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from seriesloom.llm import packing as P
from seriesloom.llm.tokens import Encoder

PATH = public_tokenizers.path("byte_bpe_50k.json")
TEXTS = [
    "", " ", "a", " a", "a ", "a  b", "a\n b", "a \nb c", "don't stop they're", "x  y", "x  y",
    "<|endoftext|> is special", "a <|endoftext|>", "a b<|endoftext|>c d", "<|endoftext|", "tab\there  there", "é ñ 漢字 ok", "one two one two", "a\x1c b", "\n\nz z",
    "1234 5 67!!! (x) [y]", "end\n", "word " * 3000 + "x",
]


@pytest.fixture(scope="module")
def reference():
    t = Tokenizer.from_file(PATH)
    return lambda s: t.encode(s, add_special_tokens=False).ids


def test_cached_ids_equal_the_tokenizer(reference):
    rng = random.Random(3)
    alphabet = "ab é'.,1\n\t  ñs"
    texts = TEXTS + ["".join(rng.choice(alphabet) for _ in range(rng.randrange(40))) for _ in range(400)]
    e = Encoder(PATH)
    for _ in range(2):
        for text, got in zip(texts, e.ids(texts), strict=True):
            assert got.tolist() == reference(text), repr(text)


def test_bounds_and_best_fit():
    rng = np.random.default_rng(4)
    for top in (20, 300, 1023):
        x = rng.integers(1, top + 1, 500)
        bins, offsets, n = P.best_fit_decreasing(x, 1024)
        fill = np.bincount(bins, x, n)
        assert fill.max() <= 1024 and P.lower_bound(x, 1024) <= n <= 11 * P.lower_bound(x, 1024) / 9 + 1
        for b in range(n):
            own = np.argsort(offsets[bins == b])
            o, l = offsets[bins == b][own], x[bins == b][own]
            assert o[0] == 0 and (o[1:] == np.cumsum(l)[:-1]).all()
    assert P.lower_bound(np.full(9, 600), 1024) == 9  # the sum alone says 6
    assert P.lower_bound(np.full(9, 342), 1024) == 5  # two fit
    assert P.lower_bound(np.array([], np.int64), 1024) == 0


def check(rows, capacity):
    seqs = {}
    for r in rows:
        seqs.setdefault(r.sequence_id, []).append(r)
    for own in seqs.values():
        at = 0
        for r in sorted(own, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= capacity
    return len(seqs)


def test_documents(spark, reference):
    rows = [(i, t) for i, t in enumerate(TEXTS)] + [(50, None), (50, None), (None, "null id")]
    docs = spark.createDataFrame([(a, b, 7) for a, b in rows], "doc_id long, text string, length int")
    got = P.pack(P.token_pieces(docs, PATH)).collect()
    check(got, 1024)
    by = {}
    for r in got:
        by.setdefault(r.doc_id, []).append(r)
    assert len(by[50]) == 2 and all(r.length == 1 for r in by[50])
    for i, text in rows:
        if i in (50,):
            continue
        ids = np.array(reference(text) + [2], "<u4")
        own = sorted(by[i], key=lambda r: r.piece)
        assert [r.piece for r in own] == list(range(len(own)))
        assert sum(r.length for r in own) == len(ids) and all(r.length == 1024 for r in own[1:])
        for r in own:
            assert r.ids_crc32 == zlib.crc32(ids[r.start : r.start + r.length].tobytes())
    assert P.pack(P.token_pieces(docs.limit(0), PATH)).count() == 0


def test_exchange_closes_the_gaps(spark):
    rng = np.random.default_rng(5)
    x = rng.integers(1, 1025, 6000)
    df = spark.createDataFrame([(int(i), int(v)) for i, v in enumerate(x)], "id long, length long")
    got = P.pack(df, part_rows=500).collect()
    assert sorted(r.id for r in got) == list(range(6000))
    n, best = check(got, 1024), P.best_fit_decreasing(x, 1024)[2]
    assert n <= best * 1.01 + 1
