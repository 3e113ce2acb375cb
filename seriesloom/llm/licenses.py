"""License scans: TF-IDF cosine to templates, then inheritance from the nearest directory.

A *header* is a sentence or line that holds a license word; a paragraph with one, its lines
joined without comment marks, and the sentences of that are compared as well. Terms are weighted by
tf * (ln((N + 1) / (df + 1)) + 1), where N and df count the headers of all texts, for every
term. The `HEAD` most frequent terms' counts go to every task. No other term has a larger
count than the least of these, which bounds a cosine from above; headers and texts whose
bound reaches the threshold meet the counts of their rarer terms in a join. A header has the
license of the most similar statement or notice from `SIMILAR` on, or of its SPDX tag; 'all
rights reserved' counts only beside no other license. A text that as a whole is similar to a
statement that it holds, to a notice or to a full license text is a license file: its license holds for its directory and all below it that have
none of their own nearer. A text without a header of its own takes the license of the nearest
such ancestor directory.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from functools import cache
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seriesloom.llm.base import cut_lineage, pieces, register, table

#: Short statements of common licenses under their public identifiers.
TEMPLATES = (
    ("AGPL-3.0", "Licensed under the GNU Affero General Public License, version 3."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("BSD-2-Clause", "Released under the BSD 2-Clause License."),
    ("BSD-3-Clause", "Released under the BSD 3-Clause License."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC0-1.0", "Dedicated to the public domain under CC0 1.0."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("ISC", "Released under the ISC License."),
    ("LGPL-3.0", "Licensed under the GNU Lesser General Public License, version 3."),
    ("MIT", "Released under the MIT License."),
    ("MPL-2.0", "Subject to the terms of the Mozilla Public License, version 2.0."),
    ("Proprietary", "All rights reserved."),
    ("Unlicense", "Released into the public domain under the Unlicense."),
)
_FREE = (
    "This program is free software: you can redistribute it and/or modify it under the terms of the {}"
    " as published by the Free Software Foundation, {}. This program is distributed in the hope that it"
    " will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or"
    " FITNESS FOR A PARTICULAR PURPOSE. See the {} for more details."
)
_LATER = "either version {} of the License, or (at your option) any later version"
_GNU = (
    ("AGPL-3.0", "GNU Affero General Public License", "3"), ("GPL-2.0", "GNU General Public License", "2"),
    ("GPL-3.0", "GNU General Public License", "3"), ("LGPL-2.1", "GNU Lesser General Public License", "2.1"),
    ("LGPL-3.0", "GNU Lesser General Public License", "3"),
)
_APACHE = (
    'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in'
    " compliance with the License. You may obtain a copy of the License at"
    " http://www.apache.org/licenses/LICENSE-2.0"
)
#: The headers that the licenses tell files to carry, whole and by paragraph.
NOTICES = (
    ("Apache-2.0", _APACHE),
    ("Apache-2.0", _APACHE + " Unless required by applicable law or agreed to in writing, software distributed"
     ' under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either'
     " express or implied. See the License for the specific language governing permissions and limitations"
     " under the License."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of"
     " the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."),
    *((name, text) for name, title, v in _GNU for how in (_LATER.format(v), f"version {v} of the License")
      for whole in [_FREE.format(title, how, title)] for text in (whole, whole.split(". This program")[0])),
)
#: The licenses' full texts, by file name.
TEXTS = Path(__file__).parent / "license_texts"
#: Texts that differ little but in their first lines, which name the license.
TITLES = {
    "GPL-3.0": (("affero general public license", "AGPL-3.0"), ("gnu general public license", "GPL-3.0")),
    "CC-BY-SA-4.0": (("attribution-sharealike 4.0", "CC-BY-SA-4.0"), ("attribution 4.0", "CC-BY-4.0"),
                     ("attribution-noncommercial 4.0", "CC-BY-NC-4.0")),
}
TITLE_CHARS = 400
SPDX = re.compile(r"SPDX-License-Identifier:[ \t(]*([A-Za-z0-9.+-]+)", re.IGNORECASE)
#: Comment marks at both ends of a line.
MARKS = re.compile(r"^[ \t]*(?:/\*+|\*+/?|//+!?|#+|--+|;+|%+|<!--|\"{3}|'{3})?[ \t]*|[ \t]*(?:\*+/|-->)?[ \t\r]*$")
#: A header holds one of these.
SIGNS = r"(?i)licen[sc]|spdx|copyright|public domain|all rights reserved"
#: A license that holds only beside no other.
LAST = "Proprietary"
SENTENCE = r"\n|(?<=[.!?])\s+"
TERM = r"[a-z0-9]+"
SIMILAR, SIMILAR_FILE = 0.7, 0.6
#: Of whole texts to notices and full texts, where common words alone are alike.
SIMILAR_TEXT = 0.8
#: Terms whose counts go to every task, besides those of the templates.
HEAD = 65_536
#: Distinct terms that a task gathers before it hands them on.
FLUSH = 1 << 16


@cache
def full_texts() -> tuple[tuple[str, str], ...]:
    """(name, text) of the full licenses; read where the model is built, not by its tasks."""
    return tuple((f.stem, f.read_text("utf-8")) for f in sorted(TEXTS.glob("*.txt")))


def headers(text: str) -> list[str]:
    """The sentences of a text that hold a license word."""
    return [s for s in re.split(SENTENCE, text) if re.search(SIGNS, s)]


def blocks(text: str) -> list[str]:
    """Paragraphs with a license word, their lines joined, and the sentences of each with one.

    Comment lines without a word part paragraphs as blank lines do; the whole comment, or run
    of lines between truly blank ones, is one more block.
    """
    out = []
    for run in re.split(r"\n[ \t\r]*\n", text):
        if not re.search(SIGNS, run) or "\n" not in run:
            continue
        lines = [MARKS.sub("", x) for x in run.split("\n")]
        joined = [" ".join(x.split("\n")) for x in re.split(r"\n\n+", "\n".join(lines).strip("\n"))]
        out += [" ".join(joined)] if len(joined) > 1 else []
        for x in joined:
            if re.search(SIGNS, x):
                out += [x, *(y for y in headers(x) if y != x)]
    return out


def tagged(text: str) -> list[str]:
    """Known licenses of the SPDX tags, in order; the first of an expression counts."""
    names = {name.lower(): name for name, _ in (*TEMPLATES, *NOTICES)}
    ids = (re.sub(r"-(only|or-later)$|\+$", "", m[1].lower()) for m in SPDX.finditer(text))
    return [names[i] for i in ids if i in names and i != "proprietary"]


def terms(text: str) -> list[str]:
    return re.findall(TERM, text.lower())


def header_counts(docs: DataFrame, text: str = "text") -> DataFrame:
    """term, n: in how many headers of all rows each term stands; '' has the number of headers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter = Counter()

        def out() -> pa.RecordBatch:
            columns = [pa.array(held.keys(), pa.string()), pa.array(held.values(), pa.int64())]
            return pa.RecordBatch.from_arrays(columns, ["term", "n"])

        for batch in pieces(batches, text):
            for t in batch.column(text).to_pylist():
                for header in headers(t):
                    held.update({"", *terms(header)})
                if len(held) > FLUSH:
                    yield out()
                    held.clear()
        yield out()

    signed = docs.where(F.rlike(F.col(text), F.lit(SIGNS))).select(text)
    return signed.mapInArrow(run, "term string, n long").groupBy("term").agg(F.sum("n").alias("n"))


class Matcher:
    """`counts` are of the templates' terms and a head; no other term has more than `floor`."""

    def __init__(self, n: int, counts: dict[str, int], floor: int = 0):
        self.n, self.counts, self.floor = n, counts, floor
        groups = (TEMPLATES, NOTICES, full_texts())
        self.names = [name for group in groups for name, _ in group]
        texts = [text for group in groups for _, text in group]
        self.short, self.notice = len(TEMPLATES), len(TEMPLATES) + len(NOTICES)
        self.place = {t: k for k, t in enumerate(sorted({t for text in texts for t in terms(text)}))}
        self.vectors = np.stack([self.vector(text)[0] for text in texts])
        self.vectors /= np.linalg.norm(self.vectors, axis=1, keepdims=True)

    def weight(self, count: int) -> float:
        return math.log((self.n + 1) / (count + 1)) + 1

    def vector(self, text: str) -> tuple[np.ndarray, float, dict[str, int]]:
        """The part on template terms, the square of all known terms, and the rest with tf."""
        out, square, rest = np.zeros(len(self.place)), 0.0, {}
        for term, n in Counter(terms(text)).items():
            if term not in self.counts and term not in self.place and self.floor:
                rest[term] = n
                continue
            value = n * self.weight(self.counts.get(term, 0))
            square += value**2
            if term in self.place:
                out[self.place[term]] = value
        return out, square, rest

    def best(self, text: str, least: float, start: int = 0, stop: int | None = None) -> tuple | None:
        """(name, dot product, square, rest) of the most similar of some templates; ties go to the first.

        None where the cosine is below `least` even if the rest is as frequent as can be.
        """
        part, square, rest = self.vector(text)
        if not part.any():
            return None
        light = self.weight(self.floor)
        dots = self.vectors[start:stop] @ part
        most = dots / math.sqrt(square + sum((n * light) ** 2 for n in rest.values()))
        k = int(np.argmax(np.round(most, 9)))
        return (self.names[start + k], float(dots[k]), square, rest) if most[k] >= least - 1e-9 else None

    def candidates(self, text: str) -> list[tuple]:
        """(place, *best) of each header that can have a license.

        Places -1 and -2 are the whole text by statements, and by notices and full texts.
        """
        spots = list(dict.fromkeys([*headers(text), *blocks(text)]))
        found = [(i, *x) for i, h in enumerate(spots) if (x := self.best(h, SIMILAR, 0, self.notice))]
        found += [(len(spots) + i, name, 1.0, 1.0, {}) for i, name in enumerate(tagged(text))]
        if found and (x := self.best(text, SIMILAR_FILE, 0, self.short)):
            found.append((-1, *x))
        if x := self.best(text, SIMILAR_TEXT, self.short):
            name, start = x[0], " ".join(text[:TITLE_CHARS].lower().split())
            if name in TITLES:
                name = next((other for title, other in TITLES[name] if title in start), None)
            if name:
                found.append((-2, name, *x[1:]))
        return found

    def scan(self, text: str) -> tuple[str | None, float, str | None]:
        """Own license, its cosine, and the license that the text states as a file.

        Terms without a count have none.
        """
        own, file, full = (None, 0.0), None, None
        for at, name, dot, square, rest in self.candidates(text):
            cosine = dot / math.sqrt(square + sum((n * self.weight(0)) ** 2 for n in rest.values()))
            if at == -1 and cosine >= SIMILAR_FILE:
                file = name
            elif at == -2 and cosine >= SIMILAR_TEXT:
                full = (name, cosine, name)
            elif at >= 0 and cosine >= SIMILAR:
                rank = lambda x: (x[0] not in (None, LAST), x[1])
                own = max(own, (name, cosine), key=rank)
        return full or (*own, file if own[0] else None)


_OPEN = pa.list_(pa.struct([
    ("at", pa.int32()), ("name", pa.string()), ("dot", pa.float64()), ("square", pa.float64()),
    ("rest", pa.list_(pa.string())), ("times", pa.list_(pa.int64())),
]))


def own_licenses(docs: DataFrame, text: str = "text", head: int = HEAD) -> DataFrame:
    """`docs` without the text, with own, cosine, file: only rows with a license word."""
    counts = cut_lineage(header_counts(docs, text))
    top = {r.term: r.n for r in counts.orderBy(F.desc("n"), "term").limit(head + 1).collect()}
    number = top.pop("", 0)  # no term has more, and '' is the first of those with as many
    floor = min(top.values(), default=number) if counts.count() > len(top) + 1 else 0
    own_terms = {t for _, text in (*TEMPLATES, *NOTICES, *full_texts()) for t in terms(text)}
    top |= {r.term: r.n for r in counts.where(F.col("term").isin(own_terms)).collect()}
    held = docs.sparkSession.sparkContext.broadcast(Matcher(number, top, floor))
    names = [c for c in docs.columns if c != text]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, text):
            found = [
                [(at, name, dot, square, list(rest), list(rest.values())) for at, name, dot, square, rest in x]
                for x in map(held.value.candidates, batch.column(text).to_pylist())
            ]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in names), pa.array(found, _OPEN)], [*names, "open"]
            )

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema if f.name != text)
    part = cut_lineage(
        docs.where(F.rlike(F.col(text), F.lit(SIGNS))).mapInArrow(
            run,
            f"{schema}, open array<struct<at: int, name: string, dot: double, square: double,"
            " rest: array<string>, times: array<bigint>>>",
        ).withColumn("row", F.monotonically_increasing_id())
    )
    found = part.select("row", F.explode("open").alias("x")).select("row", "x.*")
    weight = F.log((F.lit(number) + 1) / (F.coalesce("n", F.lit(0)) + 1)) + 1
    more = (
        found.select("row", "at", F.explode(F.arrays_zip("rest", "times")).alias("x"))
        .select("row", "at", F.col("x.rest").alias("term"), F.col("x.times").alias("times"))
        .join(counts, "term", "left")
        .groupBy("row", "at").agg(F.sum(F.pow(F.col("times") * weight, F.lit(2))).alias("more"))
    )
    cosine = F.col("dot") / F.sqrt(F.col("square") + F.coalesce("more", F.lit(0.0)))
    judged = found.drop("rest", "times").join(more, ["row", "at"], "left").withColumn("cosine", cosine)
    own = F.when((F.col("at") >= 0) & (F.col("cosine") >= SIMILAR), F.struct("name", "cosine"))
    rank = F.struct(F.col("name") != LAST, F.round("cosine", 9), -F.col("at"))
    file = F.when((F.col("at") == -1) & (F.col("cosine") >= SIMILAR_FILE), F.col("name"))
    full = F.when((F.col("at") == -2) & (F.col("cosine") >= SIMILAR_TEXT), F.struct("name", "cosine"))
    best = judged.groupBy("row").agg(
        F.max(full).alias("full"), F.max_by(own, F.when(own.isNotNull(), rank)).alias("own"),
        F.max(file).alias("file"),
    ).select(
        "row", F.coalesce("full", "own").alias("own"),
        F.coalesce("full.name", F.when(F.col("own").isNotNull(), F.col("file"))).alias("file"),
    )
    return part.drop("open").join(best, "row", "left").select(
        *names, F.col("own.name").alias("own"), F.col("own.cosine").alias("cosine"), "file"
    )


def parent(path):
    """The directory of a path; '' at the top."""
    return F.regexp_extract(path, r"^(.*)/[^/]*$", 1)


def ancestors(directory):
    """A directory and all above it, nearest first; the last is ''."""
    parts = F.split(directory, "/")
    up = F.transform(
        F.sequence(F.size(parts), F.lit(1), F.lit(-1)), lambda n: F.array_join(F.slice(parts, 1, n), "/")
    )
    return F.array_distinct(F.concat(up, F.array(F.lit(""))))


def scan(files: DataFrame, id_: str = "id") -> DataFrame:
    """id, path, license, origin, cosine, from_directory for each row of `files`.

    `files` has the id, path and text. origin is header, file, inherited or none. Of several
    license files in a directory the most frequent license holds, then the first by name. A
    null path lies in the top directory, a null text is empty; repeated rows are scanned
    each; an empty table gives an empty result; other columns are ignored.
    """
    files = files.select(F.col(id_).alias("id"), F.coalesce("path", F.lit("")).alias("path"), "text")
    own = cut_lineage(own_licenses(files))
    stated = (
        own.where("file IS NOT NULL")
        .groupBy(parent(F.col("path")).alias("from_directory"), "file").agg(F.count(F.lit(1)).alias("n"))
        .groupBy("from_directory").agg(F.min_by("file", F.struct(-F.col("n"), "file")).alias("inherited"))
    )
    # Directories, not files, look for their ancestors: a crowded one does so once.
    places = files.select(parent(F.col("path")).alias("directory")).distinct()
    near = (
        places.select("directory", F.posexplode(ancestors(F.col("directory"))).alias("up", "from_directory"))
        .join(stated, "from_directory")
        .groupBy("directory").agg(F.min(F.struct("up", "from_directory", "inherited")).alias("x"))
        .select("directory", "x.from_directory", "x.inherited")
    )
    found = own.where("own IS NOT NULL").select("id", "path", "own", "cosine", "file")
    rest = files.select("id", "path", F.rlike(F.col("text"), F.lit(SIGNS)).alias("sign"))
    plain = rest.where(~F.coalesce("sign", F.lit(False))).select("id", "path").unionByName(
        own.where("own IS NULL").select("id", "path")
    )
    taken = plain.withColumn("directory", parent(F.col("path"))).join(near, "directory", "left").select(
        "id", "path", F.col("inherited").alias("license"),
        F.when(F.col("inherited").isNull(), "none").otherwise("inherited").alias("origin"),
        F.lit(None).cast("double").alias("cosine"), "from_directory",
    )
    return found.select(
        "id", "path", F.col("own").alias("license"),
        F.when(F.col("file").isNull(), "header").otherwise("file").alias("origin"),
        F.round("cosine", 6).alias("cosine"), F.lit(None).cast("string").alias("from_directory"),
    ).unionByName(taken)


@register("op2_licenses")
def op2_licenses(spark, sf_dir):
    """License of every document; its path is source, language and id."""
    docs = table(spark, sf_dir, "documents").select(
        "doc_id", F.concat_ws("/", "source", "lang", "doc_id").alias("path"), "text"
    )
    return scan(docs, "doc_id").withColumnRenamed("id", "doc_id")
