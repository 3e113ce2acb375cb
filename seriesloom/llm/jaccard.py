"""N-gram Jaccard join with Bayesian pruning of candidates.

1. Texts with equal word sequences become one *text*: a row with its id (the least row
   number), and MinHash values of its five-word shingles.
2. Texts meet in LSH buckets: 25 bands of 5 values, which a pair of similarity 0.8 misses
   with probability 5e-5. In a bucket MinHash values are compared `STEP` at a time; a pair
   is dropped as soon as the posterior probability of similarity >= 0.8, given the matches so
   far and a uniform prior, is below `TOLERANCE`. The rest joins texts to *clusters*; only a
   spanning forest of links leaves a task, never the pairs.
3. Each cluster's texts come together once with their shingle sets. Pairs are pruned in the
   same way and verified exactly. A task reports each text's number of links and, again, a
   spanning forest, from which the classes follow.

Large buckets and clusters are cut into blocks, and each pair of blocks is a task's work of
bounded size; a text is copied once per block of its bucket. Nothing is capped.
"""

from __future__ import annotations

import functools
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seriesloom.llm.base import (
    WORD_SEPARATORS, Packed, cut_lineage, mix, pieces, register, table, word_spans,
)

SHINGLE, SIMILARITY = 5, 0.8
BANDS, ROWS = 25, 5
HASHES = BANDS * ROWS + 3  # 128: the last ones serve the comparison only
STEP, TOLERANCE = 16, 1e-4
#: Texts of a bucket or cluster that one side of a task holds.
BLOCK = 512

_RNG = np.random.default_rng(11)
_FLIPS = _RNG.integers(0, 1 << 63, HASHES, np.uint64)[:, None]
_MULTIPLIERS = (_RNG.integers(1, 1 << 63, HASHES, np.uint64) * np.uint64(2) + np.uint64(1))[:, None]


@functools.cache
def least_matches(similarity: float = SIMILARITY, tolerance: float = TOLERANCE) -> tuple[int, ...]:
    """Matches needed after each STEP values, so that P(J >= similarity | matches) >= tolerance.

    With a uniform prior the posterior after m matches of n is Beta(m + 1, n - m + 1), and its
    tail above s equals the binomial P(X <= m) for n + 1 draws at s.
    """
    out = []
    for n in range(STEP, HASHES + 1, STEP):
        tail, need = 0.0, n + 1
        for m in range(n + 1):
            tail += math.comb(n + 1, m) * similarity**m * (1 - similarity) ** (n + 1 - m)
            if tail >= tolerance:
                need = m
                break
        out.append(need)
    return tuple(out)


def shingle_sets(texts: pa.Array) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """Per text: word hashes, and the sorted distinct hashes of its shingles.

    A text of fewer than five words has one shingle of all its words; without words, none.
    """
    packed = Packed(texts)
    starts, ends, text = word_spans(packed, WORD_SEPARATORS)
    h = packed.hasher()(starts, ends)
    cuts = np.searchsorted(text, np.arange(len(texts) + 1))
    step = np.uint64(0xD6E8FEB86659FD93)
    n = max(len(h) - SHINGLE + 1, 0)
    all_five = np.zeros(n, np.uint64)
    for k in range(SHINGLE):
        all_five = all_five * step + h[k : k + n]
    all_five = mix(all_five)
    words, sets = [], []
    for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
        words.append(h[a:b])
        if b - a >= SHINGLE:
            sets.append(np.unique(all_five[a : b - SHINGLE + 1]))
        elif b > a:
            total = np.uint64(b - a)
            for x in h[a:b]:
                total = mix(np.array([total * step + x]))[0]
            sets.append(np.array([total], np.uint64))
        else:
            sets.append(np.zeros(0, np.uint64))
    return words, sets


def minhash(shingles: np.ndarray) -> np.ndarray:
    """HASHES values of 16 bits, each from the least image of the set."""
    least = np.full(HASHES, np.iinfo(np.uint64).max, np.uint64)
    for part in np.split(shingles, range(512, len(shingles), 512)):
        images = part ^ _FLIPS
        images *= _MULTIPLIERS
        np.minimum(least, images.min(axis=1), out=least)
    return (mix(least) & np.uint64(0xFFFF)).astype(np.uint16)


def band_keys(values: np.ndarray) -> np.ndarray:
    """One 64-bit key per band for each row of MinHash values; bands never share a key."""
    bands = values[:, : BANDS * ROWS].reshape(len(values), BANDS, ROWS).astype(np.uint64)
    key = np.broadcast_to(np.arange(1, BANDS + 1, dtype=np.uint64), bands.shape[:2]).copy()
    for k in range(ROWS):
        key = mix(key * np.uint64(0x9E3779B97F4A7C15) + bands[:, :, k] + np.uint64(1))
    return key.view(np.int64)


def survivors(values: np.ndarray, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Which of the pairs (rows of `values`) the posterior does not rule out."""
    alive = np.arange(len(left))
    hits = np.zeros(len(left), np.int32)
    for s, least in enumerate(least_matches()):
        if not len(alive):
            break
        cols = slice(s * STEP, (s + 1) * STEP)
        hits += (values[left[alive], cols] == values[right[alive], cols]).sum(axis=1, dtype=np.int32)
        keep = hits >= least
        alive, hits = alive[keep], hits[keep]
    return alive


def group_pairs(
    group: np.ndarray, mixed: np.ndarray, side: np.ndarray, small: int = 48
) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of rows of one group (numbers in order); of both sides only, where it is mixed.

    Small groups go together, one distance after the other; each large one by itself.
    """
    n = len(group)
    size = np.bincount(group)
    little = size[group] <= small
    for d in range(1, small):
        t = np.flatnonzero((group[d:] == group[: n - d]) & little[: n - d]) if d < n else np.zeros(0, int)
        if not len(t):
            break
        t = t[~mixed[t] | (side[t] != side[t + d])]
        for part in np.split(t, range(100_000, len(t), 100_000)):
            yield part, part + d
    starts = np.cumsum(size) - size
    for g in np.flatnonzero(size > small):
        rows = np.arange(starts[g], starts[g] + size[g])
        if mixed[rows[0]]:
            a, b = rows[side[rows] == 0], rows[side[rows] == 1]
            yield np.repeat(a, len(b)), np.tile(b, len(a))
        else:
            i, j = np.triu_indices(len(rows), 1)
            yield rows[i], rows[j]


def forest(pairs: Iterator[tuple[int, int]]) -> list[tuple[int, int]]:
    """The pairs that join two trees, so at most one less than there are nodes."""
    parent: dict[int, int] = {}

    def find(x: int) -> int:
        while parent.setdefault(x, x) != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    out = []
    for x, y in pairs:
        p, q = find(x), find(y)
        if p != q:
            parent[max(p, q)] = min(p, q)
            out.append((x, y))
    return out


def _star(large: bool):
    """One step over edges (u, v) sorted by u, then v: link v's to the least node around u.

    Groups may span batches: the first v of a group is its least, and is carried on.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = None  # u, its least neighbour and the last v seen
        for batch in batches:
            if not batch.num_rows:
                continue
            u, v = (batch.column(k).to_numpy() for k in (0, 1))
            begins = np.append(True, u[1:] != u[:-1])
            least = v[np.flatnonzero(begins)]
            again = np.append(False, (u[1:] == u[:-1]) & (v[1:] == v[:-1]))
            if last is not None and last[0] == u[0]:
                least[0], again[0] = last[1], last[2] == v[0]
            least = least[np.cumsum(begins) - 1]
            last = (u[-1], least[-1], v[-1])
            if large:  # neighbours on both sides; those above u move
                use = ~again & (v > u)
                out = (v[use], np.minimum(least, u)[use])
            else:  # neighbours below u only; they and u move
                use = ~again & (v != least)
                out = (np.concatenate([v[use], u[begins]]), np.concatenate([least[use], least[begins]]))
            if len(out[0]):
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in out], ["u", "v"])

    return run


def components(edges: DataFrame) -> DataFrame:
    """node, root (least node of its component) for all nodes of `edges` (a, b long).

    Alternating large and small stars until nothing changes: each round is two shuffles of
    pairs of numbers, with sorted groups read as streams, so no group has to fit a task.
    """
    edges = edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    schema = "u long, v long"

    def step(df: DataFrame, large: bool) -> DataFrame:
        if large:
            df = df.unionByName(df.select(F.col("v").alias("u"), F.col("u").alias("v")))
        return df.repartition("u").sortWithinPartitions("u", "v").mapInArrow(_star(large), schema)

    edges, before = cut_lineage(edges.distinct()), None
    while True:
        edges = cut_lineage(step(step(edges, True), False).distinct())
        now = edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v")), F.sum(F.xxhash64("u", "v", F.lit(1)) % 1000003)).first()
        if now == before or not now[0]:
            break
        before = now
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
        edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    )


def in_blocks(rows: DataFrame, key: str, counts: DataFrame, block: int = BLOCK) -> DataFrame:
    """Copies of `rows` for each pair of blocks of their key: columns i, j, side.

    `counts` has n for each key; keys of one block are copied once, as i = j = 0.
    """
    blocks = F.ceil(F.col("n") / block).cast("int")
    own = F.pmod(F.xxhash64("id", F.lit(3)), F.col("blocks")).cast("int")
    dealt = rows.join(counts, key).withColumn("blocks", blocks).withColumn("own", own)
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    return (
        dealt.withColumn("other", other)
        .withColumn("i", F.least("own", "other"))
        .withColumn("j", F.greatest("own", "other"))
        .withColumn("side", (F.col("own") > F.col("other")).cast("int"))
        .drop("n", "blocks", "own", "other")
    )


def _runs(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pd.DataFrame]:
    """The rows of each key of a partition that is sorted by `keys`, many small keys at a time."""
    held: list[pd.DataFrame] = []
    for batch in batches:
        pdf = batch.to_pandas()
        if not len(pdf):
            continue
        if held:
            pdf = pd.concat([*held, pdf], ignore_index=True)
            held = []
        last = (pdf[keys] == pdf[keys].iloc[-1]).all(axis=1).to_numpy()
        cut = int(np.flatnonzero(last)[0])
        if cut:
            yield pdf.iloc[:cut]
        held = [pdf.iloc[cut:]]
    if held:
        yield held[0]


def _arranged(pdf: pd.DataFrame, keys: list[str]) -> tuple[np.ndarray, ...]:
    """Group numbers, whether two blocks meet, side, ids and MinHash values of a frame's rows."""
    change = (pdf[keys] != pdf[keys].shift()).any(axis=1).to_numpy()
    values = np.frombuffer(b"".join(pdf["values"]), np.uint16).reshape(len(pdf), HASHES)
    return (
        np.cumsum(change) - 1, (pdf["i"] != pdf["j"]).to_numpy(), pdf["side"].to_numpy(),
        pdf["id"].to_numpy(), values,
    )


def _bucket_links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    keys = ["key", "i", "j"]
    for pdf in _runs(batches, keys):
        group, mixed, side, ids, values = _arranged(pdf, keys)
        links: list[tuple[int, int]] = []
        for left, right in group_pairs(group, mixed, side):
            good = survivors(values, left, right)
            links += forest(zip(ids[left[good]].tolist(), ids[right[good]].tolist()))
        if links:
            a, b = zip(*forest(iter(links)))
            yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["a", "b"])


def similar(sets: list[np.ndarray], left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Exactly: whether the Jaccard similarity of each pair of sets is 0.8 or more."""
    size = np.array([len(s) for s in sets], np.int64)
    rows = np.unique(np.concatenate([left, right]))
    if len(left) <= 4 * len(rows):
        shared = np.array(
            [np.intersect1d(sets[i], sets[j], assume_unique=True).size for i, j in zip(left.tolist(), right.tolist())],
            np.int64,
        )
    else:
        # Many pairs of few texts: count shared shingles by products of 0/1 matrices.
        every = np.concatenate([sets[r] for r in rows])
        owner = np.repeat(np.arange(len(rows)), size[rows])
        _, column, times = np.unique(every, return_inverse=True, return_counts=True)
        often = times > 1  # a shingle of one text is shared by none
        place = np.cumsum(often) - 1
        use = often[column]
        owner, column = owner[use], place[column[use]]
        order = np.argsort(column, kind="stable")
        owner, column = owner[order], column[order]
        table_ = np.zeros((len(rows), len(rows)), np.float32)
        for a in range(0, int(often.sum()), 2048):
            lo, hi = np.searchsorted(column, [a, a + 2048])
            ones = np.zeros((len(rows), 2048), np.float32)
            ones[owner[lo:hi], column[lo:hi] - a] = 1
            table_ += ones @ ones.T
        shared = table_[np.searchsorted(rows, left), np.searchsorted(rows, right)].astype(np.int64)
    return shared * 5 >= 4 * (size[left] + size[right] - shared)


def _cluster_links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts come as (id, id, n), links as (a, b, 0)."""
    keys = ["key", "i", "j"]
    for pdf in _runs(batches, keys):
        group, mixed, side, ids, values = _arranged(pdf, keys)
        sets = [np.frombuffer(s, np.uint64) for s in pdf["shingles"]]
        count, links = np.zeros(len(ids), np.int64), []
        for left, right in group_pairs(group, mixed, side):
            good = survivors(values, left, right)
            if not len(good):
                continue
            left, right = left[good], right[good]
            yes = similar(sets, left, right)
            left, right = left[yes], right[yes]
            count += np.bincount(left, minlength=len(ids)) + np.bincount(right, minlength=len(ids))
            links += forest(zip(ids[left].tolist(), ids[right].tolist()))
        some = np.flatnonzero(count)
        if len(some):
            a, b = zip(*forest(iter(links)))
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate([ids[some], a])), pa.array(np.concatenate([ids[some], b])),
                 pa.array(np.concatenate([count[some], np.zeros(len(a), np.int64)]))],
                ["a", "b", "n"],
            )


def link(docs: DataFrame, block: int = BLOCK) -> DataFrame:
    """row, class_row, n_links, n_copies for each row of `docs` (row long unique, text).

    class_row is the least row of the class; n_links counts the other texts of similarity 0.8
    or more, n_copies the other rows with the same words. Null and empty texts have no words:
    they are copies of each other and link to nothing else. An empty table gives an empty
    result; other columns are ignored.
    """
    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import hashlib

        for batch in pieces(batches, "text"):
            words, _ = shingle_sets(batch.column("text"))
            same = [hashlib.blake2b(w.tobytes(), digest_size=16).digest() for w in words]
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), pa.array(same), pa.array([len(w) for w in words])],
                ["row", "same", "size"],
            )

    docs = docs.select("row", "text")
    rows = cut_lineage(docs.mapInArrow(sign, "row long, same binary, size long"))
    texts = rows.groupBy("same").agg(
        F.min("row").alias("id"), F.count(F.lit(1)).alias("copies"), F.max("size").alias("size")
    )
    texts = cut_lineage(texts)
    # Only one row of each text is needed; its text is read again where it lies.
    first = texts.where("size > 0").select(F.col("id").alias("row"))

    def hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "text"):
            _, sets = shingle_sets(batch.column("text"))
            values = [minhash(s) if len(s) else None for s in sets]
            keep = [k for k, v in enumerate(values) if v is not None]
            if not keep:
                continue
            matrix = np.stack([values[k] for k in keep])
            yield pa.RecordBatch.from_arrays(
                [batch.column("row").take(pa.array(keep)),
                 pa.array([v.tobytes() for v in matrix]),
                 pa.array(list(band_keys(matrix)), pa.list_(pa.int64()))],
                ["id", "values", "bands"],
            )

    signed = docs.mapInArrow(hashes, "id long, values binary, bands array<long>")
    signed = cut_lineage(signed.join(first.withColumnRenamed("row", "id"), "id", "left_semi"))
    buckets = signed.select("id", F.explode("bands").alias("key"))
    crowded = buckets.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    met = in_blocks(buckets, "key", crowded, block).join(signed.select("id", "values"), "id")
    parts = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), 1)
    links = (
        met.select("key", "i", "j", "side", "id", "values")
        .repartition(parts, "key", "i", "j")
        .sortWithinPartitions("key", "i", "j", "id")
        .mapInArrow(_bucket_links, "a long, b long")
    )
    clusters = components(links).withColumnRenamed("root", "key")
    clusters = clusters.withColumnRenamed("node", "id")
    sizes = clusters.groupBy("key").agg(F.count(F.lit(1)).alias("n"))

    def sets_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "text"):
            _, sets = shingle_sets(batch.column("text"))
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), pa.array([s.tobytes() for s in sets])], ["id", "shingles"]
            )

    members = in_blocks(clusters, "key", sizes, block)
    needed = docs.join(clusters.select(F.col("id").alias("row")), "row", "left_semi")
    full = needed.mapInArrow(sets_of, "id long, shingles binary").join(
        signed.select("id", "values"), "id"
    )
    verified = cut_lineage(
        members.join(full, "id")
        .select("key", "i", "j", "side", "id", "values", "shingles")
        .repartition(parts, "key", "i", "j")
        .sortWithinPartitions("key", "i", "j", "id")
        .mapInArrow(_cluster_links, "a long, b long, n long")
    )
    links_of = verified.where("a = b").groupBy(F.col("a").alias("id")).agg(F.sum("n").alias("links"))
    roots = components(verified.where("a <> b").select("a", "b")).withColumnRenamed("node", "id")
    classed = (
        texts.join(roots, "id", "left").join(links_of, "id", "left")
        .select(
            "same", F.coalesce("root", "id").alias("class_row"),
            F.coalesce("links", F.lit(0)).cast("long").alias("n_links"),
            (F.col("copies") - 1).alias("n_copies"),
        )
    )
    return rows.join(classed, "same").select("row", "class_row", "n_links", "n_copies")


def numbered(docs: DataFrame, key: str = "doc_id", row: str = "row") -> DataFrame:
    """`docs` with a column `row`: the key itself where it is unique and never null.

    Otherwise rows are numbered in a written copy, so that every later reading agrees.
    """
    odd = docs.groupBy(key).agg(F.count(F.lit(1)).alias("n")).where((F.col("n") > 1) | F.col(key).isNull())
    if odd.isEmpty():
        return docs.withColumn(row, F.col(key))
    return cut_lineage(docs.withColumn(row, F.monotonically_increasing_id()))


def keep_first(docs: DataFrame) -> DataFrame:
    """One row of each class, that of the least number, with all columns of `docs`."""
    rows = numbered(docs, row="__row")
    first = link(rows.select(F.col("__row").alias("row"), "text"))
    first = first.where("row = class_row").select(F.col("row").alias("__row"))
    return rows.join(first, "__row", "left_semi").select(docs.columns)


@register("op6_jaccard")
def op6_jaccard(spark, sf_dir):
    """Class (its least doc_id), links and copies of every document."""
    docs = numbered(table(spark, sf_dir, "documents").select("doc_id", "text"))
    found = link(docs).join(docs.select("row", "doc_id"), "row")
    names = found.groupBy("class_row").agg(F.min("doc_id").alias("class_id"))
    return found.join(names, "class_row").select("doc_id", "class_id", "n_links", "n_copies")
