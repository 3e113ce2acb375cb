import pytest
from test_decontam import brute as contaminated
from test_jaccard import brute as classes
from test_packing import check as sequences

import corpus_pipeline as P
from seriesloom.llm import quality, secrets

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def steps(spark, tmp_path_factory):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = [docs]
    for k, (_, stage) in enumerate(P.STAGES):
        path = str(tmp_path_factory.mktemp("stage") / str(k))
        stage(spark, docs, SF).write.parquet(path)
        docs = spark.read.parquet(path)
        out.append(docs)
    return out


def rows(df):
    return {r.doc_id: r for r in df.collect()}


def test_columns_stay(steps):
    assert all(s.dtypes == steps[0].dtypes for s in steps[:-1])
    assert all(set(rows(b)) <= set(rows(a)) for a, b in zip(steps, steps[1:-1]))


def test_quality(spark, steps):
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    want = {r.doc_id for r in quality.judge(steps[0], labels).collect() if r.kept}
    assert set(rows(steps[1])) == want and len(want) > 100


def test_near_duplicates(steps):
    found = classes([(r.doc_id, r.text) for r in steps[1].collect()])
    assert set(rows(steps[2])) == {first for first, _, _ in found.values()}


def test_decontamination(spark, steps):
    bench = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    before = rows(steps[2])
    bad = {d for d, _ in contaminated([(i, r.text) for i, r in before.items()], bench)}
    assert set(rows(steps[3])) == set(before) - bad


def test_secrets(steps):
    before, after = rows(steps[3]), rows(steps[4])
    assert set(before) == set(after)
    for i, r in after.items():
        assert secrets.base_spans(r.text) == [] and r.n_chars == len(r.text)
        if not secrets.base_spans(before[i].text):
            assert r.text == before[i].text


def test_packing(steps):
    got = steps[5].collect()
    assert {r.doc_id for r in got} == set(rows(steps[4]))
    n = sequences(got, 1024)
    assert n <= sum(r.length for r in got) / 1024 * 1.02 + 1


def test_run(spark, steps):
    key = lambda r: (r.doc_id, r.piece, r.start, r.length, r.ids_crc32)
    assert sorted(map(key, P.run(spark, SF).collect())) == sorted(map(key, steps[5].collect()))


@pytest.mark.parametrize("rows", ["edge", "empty"])
def test_stages_on_edge_rows(spark, rows):
    """Nulls, empty and long texts, repeated rows and own columns named like the operators'."""
    text = " ".join(f"word{k % 7}x{k}" for k in range(60))
    data = [
        (1, text, "en", "a", 7, 5, "mine"), (1, text, "en", "a", 7, 5, "mine"), (None, None, None, None, None, None, None),
        (2, "", "en", "a", 0, 6, "mine"), (3, "plain " * 40_000, "en", "b", 1, 7, "mine"), (4, text + " more", "en", "b", 2, 8, "other"),
    ]
    docs = spark.createDataFrame(
        data if rows == "edge" else [],
        "doc_id long, text string, lang string, source string, n_chars long, row int, score string",
    )
    for name, stage in P.STAGES[:-1]:
        out = stage(spark, docs, "/root/testdata/sf0.001")
        assert out.columns == docs.columns, name
        got = {tuple(r) for r in out.collect()}
        if name != "secret_scans":
            assert got <= {tuple(r) for r in data}, name
        if name == "near_duplicates" and rows == "edge":
            assert len([r for r in got if r[0] in (1, 4)]) == 1
    packed = P.STAGES[-1][1](spark, docs, "/root/testdata/sf0.001").collect()
    assert len({(r.doc_id, r.piece) for r in packed}) >= (5 if rows == "edge" else 0)
