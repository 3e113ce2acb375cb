"""Benchmark decontamination by SimHash windows of an item's size.

Words are lower-cased runs of letters, digits and bytes beyond ASCII; shingles are five words
(all words of a shorter item). A document's windows of as many words as an item has get a
64-bit SimHash of their shingles; a window that shares no shingle with any item of that size
has similarity 0 and is skipped. The items' fingerprints stand in a multi-index: of two of them
within `RADIUS` bits, some block b of `BLOCKS` differs in at most `NEAR`[b] bits, as the blocks'
NEAR[b] + 1 add up to RADIUS + 1; so looking up each block finds every fingerprint within the
radius. Windows are looked up `CELLS` pairs at a time, which bounds the memory of a step. What
is found is verified by the exact weighted similarity sum(min) / sum(max) of shingle counts.

Items come in blocks of bounded size, each held by every task; documents pass once a block.
"""

from __future__ import annotations

import itertools
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seriesloom.llm.base import Packed, mix, pieces, register, table, word_spans

SHINGLE, SIMILARITY = 5, 0.8
BITS, RADIUS, BLOCKS = 64, 20, 8
#: Bits in which a block may differ.
NEAR = [(RADIUS + 1 + b) // BLOCKS - 1 for b in range(BLOCKS)]
#: Pairs of window and item that one look-up marks.
CELLS = 1 << 22
#: Items, and words of items, that the tasks hold at a time.
BLOCK_ITEMS, BLOCK_WORDS = 20_000, 4_000_000

#: ASCII bytes that are neither letters nor digits.
BETWEEN = np.array([i < 128 and not chr(i).isalnum() for i in range(256)])
_STEP = np.uint64(0xD6E8FEB86659FD93)
_SIEVE = 1 << 22


def text_words(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Hash and text number of each word."""
    packed = Packed(pa.array([(t or "").lower() for t in texts], pa.large_string()))
    starts, ends, text = word_spans(packed, BETWEEN)
    return packed.hasher()(starts, ends), text


def shingles(words: np.ndarray, width: int) -> np.ndarray:
    """Hash of each run of `width` words of one sequence."""
    n = len(words) - width + 1
    out = np.zeros(max(n, 0), np.uint64)
    for k in range(width):
        out = out * _STEP + words[k : k + n] if n > 0 else out
    return mix(out)


def _signs(h: np.ndarray) -> np.ndarray:
    return np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1).astype(np.int32) * 2 - 1


def simhash(h: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Fingerprints of the runs h[start:end]; a bit is set where the signs sum above zero."""
    sums = np.zeros((len(h) + 1, BITS), np.int32)
    np.cumsum(_signs(h), axis=0, out=sums[1:])
    return np.packbits(sums[ends] - sums[starts] > 0, axis=1).view(np.uint64).ravel()


class MultiIndex:
    """Items of which some block of the fingerprint is within its `NEAR` bits."""

    def __init__(self, prints: np.ndarray):
        blocks = prints.view(np.uint8).reshape(-1, BLOCKS)
        self.prints = prints
        self.table = np.zeros((BLOCKS, 256, len(prints)), bool)
        for b in range(BLOCKS):
            for n in range(NEAR[b] + 1):
                for flips in itertools.combinations(range(BITS // BLOCKS), n):
                    flip = sum(1 << bit for bit in flips)
                    self.table[b, blocks[:, b] ^ flip, np.arange(len(prints))] = True

    def within(self, prints: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Query, item and distance of all pairs within RADIUS."""
        blocks = prints.view(np.uint8).reshape(-1, BLOCKS)
        step = max(CELLS // len(self.prints), 1)
        out = []
        for a in range(0, len(prints), step):
            part = blocks[a : a + step]
            found = np.zeros((len(part), len(self.prints)), bool)
            for b in range(BLOCKS):
                found |= self.table[b, part[:, b]]
            q, i = np.nonzero(found)
            far = np.bitwise_count(prints[a + q] ^ self.prints[i])
            good = far <= RADIUS
            out.append((a + q[good], i[good], far[good]))
        return tuple(np.concatenate(c) for c in zip(*out))


class Items:
    """A block of benchmark items, by shingle width and number of words."""

    def __init__(self, ids: list, texts: list[str | None]):
        words, text = text_words(texts)
        cuts = np.searchsorted(text, np.arange(len(ids) + 1))
        by_size: dict[tuple[int, int], list] = defaultdict(list)
        for k, item in enumerate(ids):
            own = words[cuts[k] : cuts[k + 1]]
            if len(own):
                width = min(SHINGLE, len(own))
                by_size[width, len(own)].append((item, shingles(own, width)))
        self.widths: dict[int, dict] = defaultdict(dict)
        for (width, size), items in sorted(by_size.items()):
            every = np.concatenate([h for _, h in items])
            prints = np.concatenate([simhash(h, np.array([0]), np.array([len(h)])) for _, h in items])
            self.widths[width][size] = (
                np.unique(every), [i for i, _ in items],
                [h for _, h in items], MultiIndex(prints),
            )
        self.sieves = {}
        for width, sizes in self.widths.items():
            sieve = np.zeros(_SIEVE, bool)
            for every, *_ in sizes.values():
                sieve[(every & np.uint64(_SIEVE - 1)).astype(np.int64)] = True
            self.sieves[width] = sieve

    def matches(self, texts: list[str | None]) -> list[tuple]:
        """(text number, item, first word, words, distance, similarity): best window of each pair."""
        words, text = text_words(texts)
        cuts = np.searchsorted(text, np.arange(len(texts) + 1))
        best: dict[tuple, tuple] = {}
        for width, sizes in self.widths.items():
            h = shingles(words, width)
            inside = text[: len(h)] == text[width - 1 :] if len(h) else np.zeros(0, bool)
            some = np.flatnonzero(
                inside & self.sieves[width][(h & np.uint64(_SIEVE - 1)).astype(np.int64)]
            )
            if not len(some):
                continue
            for size, (every, ids, own_shingles, index) in sizes.items():
                at = np.minimum(np.searchsorted(every, h[some]), len(every) - 1)
                hits = some[every[at] == h[some]]
                if not len(hits):
                    continue
                docs, first = np.unique(text[hits], return_index=True)
                for doc, own in zip(docs.tolist(), np.split(hits, first[1:])):
                    a, b = int(cuts[doc]), int(cuts[doc + 1]) - width + 1
                    self._windows(h[a:b], own - a, size - width + 1, (doc, width, size), ids, own_shingles, index, best)
        return [(k[0], ids_item, *v[1:]) for k, (ids_item, *v) in sorted(best.items(), key=lambda x: x[0])]

    @staticmethod
    def _windows(h, hits, span, key, ids, own_shingles, index, best) -> None:
        """Windows of `span` shingles of one document that hold a hit."""
        doc, width, _ = key
        last = max(len(h) - span, 0)
        mark = np.zeros(last + 2, np.int64)
        np.add.at(mark, np.clip(hits - span + 1, 0, last), 1)
        np.add.at(mark, np.minimum(hits, last) + 1, -1)
        starts = np.flatnonzero(np.cumsum(mark)[:-1] > 0)
        for part in np.split(starts, range(20_000, len(starts), 20_000)):
            low, high = int(part[0]), int(min(part[-1] + span, len(h)))
            if high - low > 4 * (span + len(part)):  # far apart: no sums over what lies between
                groups = np.split(part, np.flatnonzero(np.diff(part) > span) + 1)
            else:
                groups = [part]
            for group in groups:
                low, high = int(group[0]), int(min(group[-1] + span, len(h)))
                ends = np.minimum(group + span, len(h))
                prints = simhash(h[low:high], group - low, ends - low)
                for q, i, far in zip(*(x.tolist() for x in index.within(prints))):
                    start, end = int(group[q]), int(ends[q])
                    own = Counter(h[start:end].tolist())
                    other = Counter(own_shingles[i].tolist())
                    shared = (own & other).total()
                    similar = shared / (own.total() + other.total() - shared)
                    if similar >= SIMILARITY:
                        place = (doc, str(ids[i]), key[1], key[2], i)
                        value = (-similar, start)
                        if place not in best or value < best[place][1]:
                            best[place] = (ids[i], value, start, end - start + width - 1, far, similar)


def item_blocks(benchmark: DataFrame) -> Iterator[Items]:
    """The benchmark in blocks that fit a task; the driver holds one at a time."""
    ids, texts, size = [], [], 0
    for row in benchmark.select("item_id", "text").toLocalIterator():
        ids.append(row.item_id)
        texts.append(row.text)
        size += len(row.text or "") // 4
        if len(ids) >= BLOCK_ITEMS or size >= BLOCK_WORDS:
            yield Items(ids, texts)
            ids, texts, size = [], [], 0
    if ids:
        yield Items(ids, texts)


def find_matches(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, item_id, start_word, n_words, distance, similarity: best window of each pair.

    Null and empty texts or items match nothing; repeated rows on either side match each; an
    empty table gives an empty result; other columns are ignored.
    """
    spark = docs.sparkSession
    docs = docs.select("doc_id", "text")
    kinds = [docs.schema["doc_id"].dataType, benchmark.schema["item_id"].dataType]
    schema = (
        f"doc_id {kinds[0].simpleString()}, item_id {kinds[1].simpleString()}, start_word long,"
        " n_words long, distance long, similarity double"
    )
    out = spark.createDataFrame([], schema)
    for items in item_blocks(benchmark):
        held = spark.sparkContext.broadcast(items)

        def run(batches: Iterator[pa.RecordBatch], held=held) -> Iterator[pa.RecordBatch]:
            for batch in pieces(batches, "text"):
                found = held.value.matches(batch.column("text").to_pylist())
                if found:
                    row, *rest = zip(*found)
                    cols = [batch.column("doc_id").take(pa.array(row)), *map(pa.array, rest)]
                    yield pa.RecordBatch.from_arrays(
                        cols, ["doc_id", "item_id", "start_word", "n_words", "distance", "similarity"]
                    )

        out = out.unionByName(docs.mapInArrow(run, schema))
    return out


def drop_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of `docs`, with all their columns, whose text matches no item."""
    for items in item_blocks(benchmark):
        held = docs.sparkSession.sparkContext.broadcast(items)

        def run(batches: Iterator[pa.RecordBatch], held=held) -> Iterator[pa.RecordBatch]:
            for batch in pieces(batches, "text"):
                found = held.value.matches(batch.column("text").to_pylist())
                keep = np.ones(batch.num_rows, bool)
                keep[[x[0] for x in found]] = False
                yield batch.filter(pa.array(keep))

        docs = docs.mapInArrow(run, docs.schema)
    return docs


@register("op1_decontam")
def op1_decontam(spark, sf_dir):
    """Every document against every benchmark item."""
    return find_matches(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
