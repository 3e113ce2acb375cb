import math
import re
from collections import Counter

import pytest

from seriesloom.llm import licenses as L
from seriesloom.llm.base import QUERIES

SF = "/root/testdata/sf0.01"


def brute(files):
    """{id: (license, origin, directory)} by dense loops."""
    terms = lambda s: Counter(re.findall("[a-z0-9]+", s.lower()))
    sentences = lambda t: [s for s in re.split(L.SENTENCE, t or "") if re.search(L.SIGNS, s)]
    every = [s for _, _, t in files for s in sentences(t)]
    df = Counter(x for s in every for x in terms(s))
    known = {x for _, t in L.TEMPLATES for x in terms(t)}
    w = lambda x: math.log((len(every) + 1) / ((df[x] if x in known else 0) + 1)) + 1

    def cosine(a, b):
        a, b = terms(a), terms(b)
        dot = sum(a[x] * b[x] * w(x) ** 2 for x in a)
        size = lambda c: math.sqrt(sum((n * w(x)) ** 2 for x, n in c.items()))
        return dot / (size(a) * size(b)) if a and b else 0

    best = lambda s: max(((round(cosine(s, t), 9), -k) for k, (_, t) in enumerate(L.TEMPLATES)))
    own, stated = {}, {}
    for i, (_, path, text) in enumerate(files):
        c, k = max((best(s) for s in sentences(text)), default=(0, 0), key=lambda x: x[0])
        if c >= L.SIMILAR:
            whole = best(text)
            own[i] = (L.TEMPLATES[-k][0], "file" if whole[0] >= L.SIMILAR_FILE else "header", None)
            if whole[0] >= L.SIMILAR_FILE:
                d = (path or "").rpartition("/")[0]
                stated.setdefault(d, Counter())[L.TEMPLATES[-whole[1]][0]] += 1
    out = []
    for i, (id_, path, _) in enumerate(files):
        if i not in own:
            d, own[i] = (path or "").rpartition("/")[0], (None, "none", None)
            while True:
                if d in stated:
                    own[i] = (min(stated[d], key=lambda x: (-stated[d][x], x)), "inherited", d)
                    break
                if not d:
                    break
                d = d.rpartition("/")[0]
        out.append((id_, *own[i]))
    return sorted(out, key=str)


def got(df, id_="id"):
    return sorted(((r[id_], r.license, r.origin, r.from_directory) for r in df.collect()), key=str)


def test_given_documents(spark):
    rows = spark.read.parquet(f"{SF}/documents.parquet").collect()
    files = [(r.doc_id, f"{r.source}/{r.lang}/{r.doc_id}", r.text) for r in rows]
    assert got(QUERIES["op2_licenses"](spark, SF), "doc_id") == brute(files)


MIT, GPL = "Released under the MIT License.", "This work is licensed under the GNU General Public License, version 3."


def test_inheritance_and_cases(spark):
    files = [
        (1, "a/LICENSE", MIT), (2, "a/b/c/x", "words"), (3, "a/b/COPYING", GPL), (4, "a/b/c/d/y", "words"),
        (5, "a/z", None), (6, "q/r", ""), (7, None, "words"), (8, "a/k", "some words.\n" + GPL + " more words"),
        (9, "top", "no licence is given here at all"), (9, "top", "no licence is given here at all"),
        (10, "w/LICENSE", MIT), (11, "w/COPYING", GPL), (12, "w/x", "x"), (None, "a/long", "word " * 100000),
    ]
    df = spark.createDataFrame([(*f, "k") for f in files], "id long, path string, text string, license string")
    out = got(L.scan(df))
    assert out == brute(files)
    by = {r[0]: r[1:] for r in out}
    assert by[2] == ("GPL-3.0", "inherited", "a/b") and by[4] == by[2] and by[5] == ("MIT", "inherited", "a")
    assert by[8] == ("GPL-3.0", "header", None) and by[6] == (None, "none", None) and by[1][1] == "file"
    assert L.scan(df.limit(0)).count() == 0


@pytest.mark.parametrize("name,text", L.TEMPLATES)
def test_templates_find_themselves(name, text):
    assert L.Matcher(100, {}).scan(text) == (name, pytest.approx(1), name)


@pytest.mark.parametrize("head", [L.HEAD, 3, 0])
def test_every_term_has_its_document_frequency(spark, head):
    line = "Released under the MIT License, see this file"
    texts = [line if i % 3 else f"Copyright holder{i}\n{line} and word{i} of the GNU project" for i in range(600)]
    rows = spark.createDataFrame(list(enumerate([*texts, "x", None])), "id long, text string")
    every = [s for t in texts for s in re.split(L.SENTENCE, t) if re.search(L.SIGNS, s)]
    terms = lambda s: Counter(re.findall("[a-z0-9]+", s.lower()))
    df = Counter(x for s in every for x in terms(s))
    vector = lambda s: {x: n * (math.log((len(every) + 1) / (df[x] + 1)) + 1) for x, n in terms(s).items()}

    def cosine(a, b):
        a, b = vector(a), vector(b)
        return sum(a[x] * b.get(x, 0) for x in a) / math.hypot(*a.values()) / math.hypot(*b.values())

    best = {s: max((round(cosine(s, t), 9), name) for name, t in L.TEMPLATES) for s in set(every)}
    got = {r.id: r for r in L.own_licenses(rows, head=head).collect()}
    assert len(got) == 600
    for i, t in enumerate(texts):
        c, name = max(best[s] for s in re.split(L.SENTENCE, t) if s in best)
        assert (got[i].own, got[i].cosine) == ((name, pytest.approx(c)) if c >= L.SIMILAR else (None, None))
    assert all(got[i].own == "MIT" for i in range(600) if i % 3)  # by template terms alone: none


HOLDER = "MIT License\n\nCopyright (c) 2019 Jo Doe\n\n"


def commented(text, mark):
    return "\n".join(mark + text[i : i + 60] for i in range(0, len(text), 60)) + "\n\ncode = 1\n" * 50


@pytest.mark.parametrize("name,text", L.full_texts())
def test_full_texts_are_license_files(name, text):
    body = text.partition("\n\n")[2] if name == "MIT" else text
    own, cosine, file = L.Matcher(328, {}).scan(HOLDER + body if name == "MIT" else text)
    assert (own, file) == (name, name) and cosine > 0.9


def test_titles_part_licenses_with_like_texts():
    by = dict(L.full_texts())
    affero = by["GPL-3.0"].replace("GNU GENERAL", "GNU AFFERO GENERAL", 1)
    plain = by["CC-BY-SA-4.0"].replace("Attribution-ShareAlike 4.0", "Attribution 4.0")
    other = by["CC-BY-SA-4.0"].replace("Attribution-ShareAlike 4.0", "Attribution-NoDerivatives 4.0")
    scan = L.Matcher(328, {}).scan
    assert scan(affero)[2] == "AGPL-3.0" and scan(plain)[2] == "CC-BY-4.0" and scan(other)[2] is None


@pytest.mark.parametrize("mark", ["", "# ", " * ", "// "])
@pytest.mark.parametrize("name,text", L.NOTICES)
def test_wrapped_notices(name, text, mark):
    body = "Copyright 2020 Jo Doe. All rights reserved.\n\n"
    assert L.Matcher(328, {}).scan(body + commented(text, mark))[0] == name


def test_spdx_tags_and_inheritance(spark):
    by = dict(L.full_texts())
    files = [
        (1, "a/LICENSE", HOLDER + by["MIT"].partition("\n\n")[2]), (2, "a/b/x", "words"),
        (3, "q/x.py", "# SPDX-License-Identifier: MIT\ncode\n" * 2),
        (4, "q/y.c", "/* SPDX-License-Identifier: (GPL-2.0-only OR MIT) */"),
        (5, "q/z", "// SPDX-License-Identifier: Zlib"), (6, "g/COPYING", by["GPL-3.0"]), (7, "g/s/t/u", ""),
    ]
    out = {r[0]: r[1:] for r in got(L.scan(spark.createDataFrame(files, "id long, path string, text string")))}
    assert out[1] == ("MIT", "file", None) and out[2] == ("MIT", "inherited", "a")
    assert out[3][0] == "MIT" and out[4][0] == "GPL-2.0" and out[5] == (None, "none", None)
    assert out[6][:2] == ("GPL-3.0", "file") and out[7] == ("GPL-3.0", "inherited", "g")
