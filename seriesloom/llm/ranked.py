"""Ranked lexical search by NRA: sequential reads of impact-sorted lists, no random access.

1. Queries come in blocks. One pass over the documents keeps of each the number of its terms
   and its counts of the block's terms (a *forward row*), written to the shared folder.
2. Document frequencies and the collection's counts are sums over these rows; only one number
   for each term of the block reaches the driver.
3. A task reads forward rows until it holds about `POSTINGS` postings, sorts each term's list
   by impact and runs NRA for each query: all lists are read forwards in steps, each document
   seen has a lower bound (what was read) and an upper one (plus, for each list it was not
   seen in, that list's next impact). Reading stops when no other document can reach the k-th
   place, ties included, and the intervals of the first k have closed.
4. The first k of each piece meet in one window per query.

Lists are cut by documents, so a common term's list is dealt over all tasks.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from seriesloom.llm.base import Packed, cut_lineage, pieces, register, table, word_spans

TOP = 10
BLOCK_ITEMS, BLOCK_TERMS = 1_000, 100_000
#: Postings that a task sorts and searches at a time.
POSTINGS = 2_000_000
#: Entries of each list that the first step reads; each further step reads this many times more.
FIRST_STEP, STEP_GROWTH = 64, 4

#: Bytes outside terms: ASCII except digits and letters.
SEPARATORS = np.zeros(256, bool)
SEPARATORS[[b for b in range(128) if not chr(b).isalnum()]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32


def terms_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each term of each text in order, and the texts' first terms (one more at the end)."""
    packed = Packed(texts)
    packed.bytes = _LOWER[packed.bytes]
    starts, ends, text = word_spans(packed, SEPARATORS)
    return packed.hasher()(starts, ends), np.searchsorted(text, np.arange(len(texts) + 1))


class Block:
    """Some queries: their ids, and for each its terms (numbers in `known`) with repeats."""

    def __init__(self, ids: list, texts: list[str | None]):
        self.ids = ids
        hashes, cuts = terms_of(pa.array(texts, pa.string()))
        self.known, numbers = np.unique(hashes, return_inverse=True)
        self.queries = [
            np.unique(numbers[a:b], return_counts=True) for a, b in zip(cuts[:-1], cuts[1:])
        ]


def query_blocks(queries: DataFrame) -> Iterator[Block]:
    ids, texts, size = [], [], 0
    for row in queries.select("item_id", "text").toLocalIterator():
        ids.append(row.item_id)
        texts.append(row.text)
        size += len(row.text or "") // 6
        if len(ids) >= BLOCK_ITEMS or size >= BLOCK_TERMS:
            yield Block(ids, texts)
            ids, texts, size = [], [], 0
    if ids:
        yield Block(ids, texts)


def forward_rows(docs: DataFrame, known: np.ndarray) -> DataFrame:
    """doc_id, n (terms of the text), terms and counts (int32 bytes) of the terms in `known`."""
    held = docs.sparkSession.sparkContext.broadcast(known)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = held.value
        for batch in pieces(batches, "text"):
            hashes, cuts = terms_of(batch.column("text"))
            place = np.searchsorted(known, hashes)
            place[place == len(known)] = 0
            hit = known[place] == hashes if len(known) else np.zeros(len(hashes), bool)
            doc = np.repeat(np.arange(batch.num_rows), np.diff(cuts))[hit]
            pair, count = np.unique(doc * max(len(known), 1) + place[hit], return_counts=True)
            doc, term = np.divmod(pair, max(len(known), 1))
            ends = np.searchsorted(doc, np.arange(batch.num_rows + 1))
            term, count = term.astype(np.int32), count.astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(np.diff(cuts)),
                 *(pa.array([x[a:b].tobytes() for a, b in zip(ends[:-1], ends[1:])]) for x in (term, count))],
                ["doc_id", "n", "terms", "counts"],
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, n long, terms binary, counts binary")


def frequencies(rows: DataFrame, size: int) -> np.ndarray:
    """Documents that hold each term of the block."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size, np.int64)
        for batch in batches:
            raw = b"".join(batch.column("terms").to_pylist())
            total += np.bincount(np.frombuffer(raw, np.int32), minlength=size)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], ["term", "df"])

    out = np.zeros(size, np.int64)
    summed = rows.select("terms").mapInArrow(run, "term long, df long").groupBy("term").agg(F.sum("df").alias("df"))
    for term, df in summed.collect():  # as many rows as the block has terms
        out[term] = df
    return out


def first_k(
    lists: list[tuple[np.ndarray, np.ndarray]], n_docs: int, k: int
) -> tuple[np.ndarray, np.ndarray, int]:
    """NRA over `lists` of (documents, falling impacts): the best k documents and their scores.

    Documents are numbered by rank among equals, so ties go to the least number. Also the
    number of entries read.
    """
    lower = np.zeros(n_docs, np.int64)
    seen = np.zeros((len(lists), n_docs), bool)
    at, step, read = np.zeros(len(lists), np.int64), FIRST_STEP, 0
    while True:
        ahead = np.zeros(len(lists), np.int64)  # the next impact of each list: no unread one is larger
        for i, (docs, impacts) in enumerate(lists):
            part = slice(at[i], at[i] + step)
            lower[docs[part]] += impacts[part]
            seen[i, docs[part]] = True
            read += len(docs[part])
            at[i] = min(at[i] + step, len(docs))
            ahead[i] = impacts[at[i]] if at[i] < len(docs) else 0
        step *= STEP_GROWTH
        some = np.flatnonzero(lower > 0)
        least = np.partition(lower[some], len(some) - k)[len(some) - k] if len(some) >= k else 0
        unseen = ahead.sum()  # the most that a document not met yet can score
        if not unseen:
            break
        if unseen < least:
            can = some[lower[some] + unseen >= least]
            upper = lower[can] + unseen - ahead @ seen[:, can]
            if (upper == lower[can])[upper >= least].all():
                break  # all that reach the k-th place, ties included, have their final score
    some = some[lower[some] >= least]
    order = np.lexsort((some, -lower[some]))[:k]
    return some[order], lower[some[order]], read


def search(docs: DataFrame, queries: DataFrame, k: int = TOP, postings: int = POSTINGS) -> DataFrame:
    """item_id, rank, doc_id, score: the k best documents (score above 0) of each query.

    `docs` has doc_id and text, `queries` item_id and text. Equal scores go by ascending
    doc_id (null last). Null or empty texts hold no term: such documents are never found and
    such queries find nothing. Repeated rows are documents or queries of their own; empty
    tables give an empty result; other columns are ignored.
    """
    spark = docs.sparkSession
    kinds = [queries.schema["item_id"].dataType.simpleString(), docs.schema["doc_id"].dataType.simpleString()]
    empty = spark.createDataFrame([], f"item_id {kinds[0]}, rank int, doc_id {kinds[1]}, score long")
    out = empty
    for block in query_blocks(queries):
        rows = cut_lineage(forward_rows(docs, block.known))
        counts = rows.where("n > 0").agg(F.count(F.lit(1)), F.sum("n")).first()
        n_docs, n_terms = counts[0], counts[1] or 0
        if not n_docs:
            continue
        df = frequencies(rows, len(block.known))
        weights = np.array(
            [math.floor(1000 * math.log((2 * n_docs + 2) / (2 * x + 1))) for x in df.tolist()], np.int64
        )
        held = spark.sparkContext.broadcast((block.queries, weights))

        def run(batches: Iterator[pa.RecordBatch], held=held, n_docs=n_docs, n_terms=n_terms):
            queries, weights = held.value
            for batch in _gathered(batches, postings):
                ids = batch.column("doc_id")
                order = pc.sort_indices(ids, null_placement="at_end")
                batch = batch.take(order)
                found = _search(batch, queries, weights, n_docs, n_terms, k)
                if len(found[0]):
                    query, doc, score = found
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(query), batch.column("doc_id").take(pa.array(doc)), pa.array(score)],
                        ["query", "doc_id", "score"],
                    )

        best = rows.where("n > 0").mapInArrow(run, f"query long, doc_id {kinds[1]}, score long")
        place = Window.partitionBy("query").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
        best = best.withColumn("rank", F.row_number().over(place)).where(F.col("rank") <= k)
        names = spark.createDataFrame(list(enumerate(block.ids)), f"query long, item_id {kinds[0]}")
        out = out.unionByName(best.join(names, "query").select(empty.columns))
    return out


def _gathered(batches: Iterator[pa.RecordBatch], postings: int) -> Iterator[pa.RecordBatch]:
    """Batches with about so many postings, at least one row each."""
    held, size = [], 0
    for batch in batches:
        ends = np.cumsum(pc.binary_length(batch.column("terms")).to_numpy(False).astype(np.int64) // 4)
        first = 0
        while first < batch.num_rows:
            done = int(ends[first - 1]) if first else 0
            last = max(int(np.searchsorted(ends, done + postings - size, "right")), first + 1)
            held.append(batch.slice(first, last - first))
            size += int(ends[min(last, batch.num_rows) - 1]) - done
            first = last
            if size >= postings or first < batch.num_rows:
                yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]
                held, size = [], 0
    if held:
        yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]


def _search(batch, queries, weights, n_docs: int, n_terms: int, k: int):
    """Query, row of the batch and score of the first k of each query."""
    terms, tf = (np.frombuffer(b"".join(batch.column(c).to_pylist()), np.int32) for c in ("terms", "counts"))
    sizes = pc.binary_length(batch.column("terms")).to_numpy(False) // 4
    n = batch.column("n").to_numpy(False)
    m = 100 - 75 + (75 * n * n_docs) // n_terms
    doc = np.repeat(np.arange(len(n)), sizes)
    tf = tf.astype(np.int64)
    impact = (1_000_000_000 * tf) // (1000 * tf + 8 * m[doc])
    order = np.lexsort((-impact, terms))
    terms, doc, impact = terms[order], doc[order], impact[order]
    cuts = np.searchsorted(terms, np.arange(len(weights) + 1))
    found: tuple[list, list, list] = ([], [], [])
    for q, (own, times) in enumerate(queries):
        lists = []
        for term, count in zip(own.tolist(), times.tolist()):
            a, b = cuts[term], cuts[term + 1]
            if b > a and weights[term] > 0:
                lists.append((doc[a:b], impact[a:b] * (weights[term] * count)))
        if lists:
            docs, scores, _ = first_k(lists, len(n), k)
            found[0].append(np.full(len(docs), q))
            found[1].append(docs)
            found[2].append(scores)
    return tuple(np.concatenate(x) if x else np.zeros(0, np.int64) for x in found)


SQL = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, text FROM documents),
t AS (SELECT r, doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM d),
tf AS (SELECT r, doc_id, term, count(*) AS tf FROM t GROUP BY ALL),
n AS (SELECT r, count(*) AS n FROM t GROUP BY 1),
c AS (SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS terms FROM n),
w AS (SELECT term, CAST(floor(1000 * ln((2 * docs + 2) / (2 * df + 1))) AS BIGINT) AS w FROM (SELECT term, count(*) AS df FROM tf GROUP BY 1), c),
q AS (SELECT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark),
s AS (SELECT item_id, r, doc_id, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (25 + (75 * n * docs) // terms)))) AS BIGINT) AS score
      FROM q JOIN tf USING (term) JOIN w USING (term) JOIN n USING (r), c GROUP BY 1, 2, 3)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM s WHERE score > 0) WHERE rank <= 10
"""


@register("op13_ranked", SQL)
def op13_ranked(spark, sf_dir):
    """The ten best documents of every benchmark item."""
    return search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
