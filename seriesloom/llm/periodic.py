"""Maximal periodic runs of words, by suffix trees and Lyndon roots.

A run of 12 or more words and two or more periods repeats six words one period on. So a
text's words are cut to *stretches*, the words inside windows of six that stand elsewhere in
the text too: every run lies within one stretch, and most texts have none. In a stretch

1. Ukkonen's algorithm builds the suffix trees of the words and of their reversal. An Euler
   tour with range minima then gives the longest common extension (LCE) of any two places,
   to the right and to the left, in constant time.
2. For both orders of the alphabet the longest Lyndon word at each place follows from the
   next smaller suffix. By the runs theorem every run has such a word as its root, so
   extending all of them in both directions finds all runs and each period is the smallest.

All work on a text is done where the text is read; nothing is shuffled.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seriesloom.llm.base import pieces, register, table

LEAST, POWER = 12, 2
#: Words that a run of LEAST words and POWER periods has in common with itself, one period on.
WINDOW = LEAST // POWER


def suffix_tree(word: list[int]) -> tuple[list[int], list[int], list[dict[int, int] | None]]:
    """Ukkonen: start and end of each node's edge, and children by first symbol (leaf: None).

    The last symbol must occur once. Leaves come into being by the order of their suffixes.
    """
    n = len(word)
    start, end, link = [0], [0], [0]
    child: list[dict[int, int] | None] = [{}]
    node = length = waiting = at = 0  # the active point: `length` symbols from word[at] below node
    for i, symbol in enumerate(word):
        waiting += 1
        fresh = 0  # the inner node made last, which still lacks its suffix link
        while waiting:
            if not length:
                at = i
            below = child[node].get(word[at])
            if below is None:
                child[node][word[at]] = len(start)
                start.append(i)
                end.append(n)
                link.append(0)
                child.append(None)
                if fresh:
                    link[fresh] = node
                    fresh = 0
            else:
                first = start[below]
                span = (i + 1 if child[below] is None else end[below]) - first
                if length >= span:
                    at += span
                    length -= span
                    node = below
                    continue
                if word[first + length] == symbol:
                    length += 1
                    if fresh:
                        link[fresh] = node
                    break
                inner = len(start)
                start += [first, i]
                end += [first + length, n]
                link += [0, 0]
                child += [{word[first + length]: below, symbol: inner + 1}, None]
                start[below] = first + length
                child[node][word[at]] = inner
                if fresh:
                    link[fresh] = inner
                fresh = inner
            waiting -= 1
            if node:
                node = link[node]
            elif length:
                length -= 1
                at = i - waiting + 1
    return start, end, child


class Extensions:
    """Longest common extensions of the suffixes of a word, and the suffixes' rank.

    `rank` goes by the order of symbols, `turned` by the reverse order of all but the
    terminal, which is the least in both.
    """

    def __init__(self, symbols: np.ndarray):
        word = [*(symbols + 1).tolist(), 0]
        start, end, child = suffix_tree(word)
        leaf, number = [0] * len(start), 0
        for v, below in enumerate(child):
            if below is None:
                leaf[v] = number
                number += 1
        self.rank, valleys = self._tour(start, end, child, leaf, False)
        self.turned, _ = self._tour(start, end, child, leaf, True)
        # Least depths of the tour between neighbouring leaves, over spans of 2**k leaves.
        self.least = [valleys]
        while 2 << len(self.least) - 1 <= len(valleys):
            last, half = self.least[-1], 1 << len(self.least) - 1
            self.least.append(np.minimum(last[:-half], last[half:]))

    @staticmethod
    def _tour(start, end, child, leaf, turned) -> tuple[np.ndarray, np.ndarray]:
        """Leaves' rank, and the least depth that the Euler tour has before each leaf."""
        order, valleys = [], []
        stack, low = [(0, 0)], 0
        while stack:
            v, depth = stack.pop()
            below = child[v]
            if v < 0:  # back at a node between two of its children
                low = min(low, depth)
            elif below is None:
                order.append(leaf[v])
                valleys.append(low)
                low = depth  # no tour goes deeper than the leaf's parent without its own mark
            else:
                inner = depth + end[v] - start[v]
                keys = sorted(below)
                if not turned:
                    keys.reverse()
                elif not keys[0]:
                    keys = [*keys[1:], 0]
                for k in keys[:-1]:
                    stack.append((below[k], inner))
                    stack.append((-1, inner))
                stack.append((below[keys[-1]], inner))
        rank = np.empty(len(order), np.int64)
        rank[order] = np.arange(len(order))
        return rank, np.array(valleys, np.int32)

    def lce(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Common symbols of the suffixes at a and b (different places)."""
        x, y = self.rank[a], self.rank[b]
        x, y = np.minimum(x, y) + 1, np.maximum(x, y) + 1
        level = np.frexp((y - x).astype(np.float64))[1] - 1
        out = np.empty(len(x), np.int64)
        for k in np.unique(level):
            use, least = level == k, self.least[k]
            out[use] = np.minimum(least[x[use]], least[y[use] - (1 << int(k))])
        return out


def next_smaller(rank: list[int]) -> np.ndarray:
    """For each suffix the next one that is smaller; the last is the least of all."""
    n = len(rank)
    out = [n] * n
    for i in range(n - 2, -1, -1):
        j, r = i + 1, rank[i]
        while rank[j] > r:
            j = out[j]
        out[i] = j
    return np.array(out[:-1], np.int64)


def runs(symbols: np.ndarray, least: int = LEAST) -> np.ndarray:
    """Rows (start, length, period) by start, then period: all runs of at least `least` symbols."""
    n = len(symbols)
    if n < 2:
        return np.zeros((0, 3), np.int64)
    symbols = np.unique(symbols, return_inverse=True)[1]
    right = Extensions(symbols)
    left = Extensions(symbols[::-1]).lce
    found = []
    for rank in (right.rank, right.turned):
        j = next_smaller(rank.tolist())
        i = np.arange(n)
        period = j - i
        end = j + right.lce(i, j)
        begin = i - left(n - i, n - j)
        good = (end - begin >= POWER * period) & (end - begin >= least)
        found.append(np.stack([begin, period, end - begin], 1)[good])
    return np.unique(np.concatenate(found), axis=0)[:, [0, 2, 1]]


def text_runs(hashes: np.ndarray, words: list[bytes]) -> np.ndarray:
    """The runs of a text's words; equal words must have equal hashes."""
    n = len(words)
    count = n - WINDOW + 1
    if n < LEAST:
        return np.zeros((0, 3), np.int64)
    mixed = np.zeros(count, np.uint64)
    for k in range(WINDOW):
        mixed = mixed * np.uint64(0x9E3779B97F4A7C15) + hashes[k : k + count]
    order = np.argsort(mixed, kind="stable")
    same = mixed[order[1:]] == mixed[order[:-1]]
    if not same.any():
        return np.zeros((0, 3), np.int64)
    again = np.zeros(count, bool)
    again[order[1:][same]] = again[order[:-1][same]] = True
    edge = np.zeros(n + 2, np.int64)  # windows that begin, less those that ended
    edge[1 : count + 1] += again
    edge[1 + WINDOW : count + 1 + WINDOW] -= again
    inside = np.cumsum(edge) > 0
    cuts = np.flatnonzero(inside[1:] != inside[:-1])
    found = []
    for a, b in zip(cuts[::2].tolist(), cuts[1::2].tolist()):
        if b - a >= LEAST:
            ids: dict[bytes, int] = {}
            symbols = np.array([ids.setdefault(w, len(ids)) for w in words[a:b]])
            found.append(runs(symbols) + [a, 0, 0])
    return np.concatenate(found) if found else np.zeros((0, 3), np.int64)


def collapsed(words: list[bytes], found: np.ndarray) -> list[bytes]:
    """The words without what follows the first period of a run."""
    if not len(found):
        return words
    edge = np.zeros(len(words) + 1, np.int64)
    np.add.at(edge, found[:, 0] + found[:, 2], 1)
    np.add.at(edge, found[:, 0] + found[:, 1], -1)
    return [words[k] for k in np.flatnonzero(np.cumsum(edge[:-1]) == 0).tolist()]


def find_runs(docs: DataFrame, rewrite: Callable[..., list[bytes]] | None = None) -> DataFrame:
    """row, n_words, runs (array of start, length, period), collapsed text of each row of `docs`.

    `docs` has `text` and, in the column row, what names it; `rewrite(row, words)` may change
    a text's words first. Runs go by start, then period; the collapsed text has single spaces.
    Null and empty texts have no words, no runs and an empty collapsed text; repeated rows
    count each; an empty table gives an empty result; other columns are ignored.
    """
    schema = (
        f"row {docs.schema['row'].dataType.simpleString()}, n_words long,"
        " runs array<struct<start: long, length: long, period: long>>, collapsed string"
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["start", "length", "period"]
        for batch in pieces(batches, "text"):
            sizes, found, texts = [], [], []
            for row, text in zip(batch.column("row").to_pylist(), batch.column("text").to_pylist()):
                words = (text or "").encode().split()
                if rewrite is not None:
                    words = rewrite(row, words)
                own = text_runs(_hashes(words), words)
                sizes.append(len(words))
                found.append(own)
                texts.append(b" ".join(collapsed(words, own)).decode())
            offsets = np.cumsum([0, *map(len, found)]).astype(np.int32)
            columns = np.concatenate(found).T
            listed = pa.StructArray.from_arrays([pa.array(np.ascontiguousarray(c)) for c in columns], names)
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), pa.array(sizes, pa.int64()),
                 pa.ListArray.from_arrays(pa.array(offsets), listed), pa.array(texts, pa.string())],
                ["row", "n_words", "runs", "collapsed"],
            )

    return docs.select("row", "text").mapInArrow(run, schema)


def _hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(hash, words), np.int64, len(words)).view(np.uint64)


def planted(doc_id: int | None, words: list[bytes]) -> list[bytes]:
    """The query's rule: in every tenth document the words from the a-th on become periodic."""
    if doc_id is None:
        return words
    h, n = zlib.crc32(str(doc_id).encode()), len(words)
    if h % 10 or not n:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    cycle = words[a : a + p]
    return words[:a] + (cycle * ((n - a) // len(cycle) + 1))[: n - a]


QUERY_COLUMNS = [
    "doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256",
]


@register("op12_periodic")
def op12_periodic(spark, sf_dir):
    """Runs of every document, its longest run, and its words without repeated periods."""
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("row"), "text")
    longest = F.array_max(
        F.transform("runs", lambda r: F.struct(r["length"].alias("n"), (-r["start"]).alias("s"), (-r["period"]).alias("p")))
    )
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    return find_runs(docs, planted).withColumn("best", longest).select(
        F.col("row").alias("doc_id"),
        F.size("runs").cast("long").alias("n_runs"),
        (-F.col("best.s")).alias("start"),
        F.col("best.n").alias("length"),
        (-F.col("best.p")).alias("period"),
        F.expr("1000 * best.n div -best.p").alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
        "n_words",
    )
