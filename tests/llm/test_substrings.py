import hashlib
import random

import pytest

from seriesloom.llm import substrings as S
from seriesloom.llm.base import QUERIES

SF = "/root/testdata/sf0.001"


def brute(texts, n):
    seen = {}
    raw = {r: (t or "").encode() for r, t in texts}
    for r, b in raw.items():
        for i in range(len(b) - n + 1):
            seen.setdefault(b[i : i + n], []).append((r, i))
    gone = {r: bytearray(len(b)) for r, b in raw.items()}
    for v in seen.values():
        if len(v) > 1:
            for r, i in v:
                gone[r][i : i + n] = b"\1" * n
    out = {}
    for r, b in raw.items():
        kept = bytes(x for x, g in zip(b, gone[r]) if not g)
        runs = sum(1 for x in bytes(gone[r]).split(b"\0") if x)
        out[r] = (len(b), sum(gone[r]), runs, hashlib.sha256(kept).hexdigest())
    return out


def got(df):
    return {
        r.row: (r.n_bytes, r.n_removed, r.n_spans, hashlib.sha256(r.kept).hexdigest())
        for r in df.collect()
    }


def test_given_documents(spark):
    texts = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    rows = QUERIES["op3_substrings"](spark, SF).collect()
    want = brute(texts, 400)
    assert {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in rows} == want
    assert any(0 < v[1] < v[0] for v in want.values())


@pytest.mark.parametrize("seed,group", [(0, S.GROUP_BYTES), (1, S.GROUP_BYTES), (0, 0), (1, 300)])
def test_shared_passages(spark, seed, group, monkeypatch):
    rng = random.Random(seed)
    word = lambda: rng.choice(["é", "ab", "c d", "xyz", "q\n"])
    passages = ["".join(word() for _ in range(rng.randrange(10, 90))) for _ in range(6)]
    passages += ["a" * 150, "ab" * 60]
    texts = [None, "", "short", "z" * 3000]
    for _ in range(60):
        parts = [rng.choice([rng.choice(passages), "".join(word() for _ in range(30))]) for _ in range(rng.randrange(1, 6))]
        texts.append("".join(parts)[rng.randrange(5):])
    texts += [texts[10], texts[10]]
    df = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "row long, text string, kept string")
    monkeypatch.setattr(S, "SPAN", 40)
    monkeypatch.setattr(S, "GROUP_BYTES", group)
    assert got(S.remove_repeats(df, 50, 16)) == brute(list(enumerate(texts)), 50)
    assert S.remove_repeats(df.limit(0)).count() == 0
