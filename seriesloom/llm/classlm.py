"""Class-based n-gram scoring: exchange clustering, class transitions, word emissions.

Every training word counted `MIN_COUNT` times or more is put into one of `CLASSES` classes by
exchange, so the clustered vocabulary grows with the corpus. The `SEEDED` most frequent words
go first, one after another: a pass over the training texts counts how often each stands
beside each class, words then move to the class that raises the class-bigram likelihood most,
and the next pass counts with the new classes. All further words stay in a Spark table with
their counts beside each class; in each round every one of them meets the sums of the classes
(a table of fixed size) and moves to its best class, from the second round on only half of
them at a time, so that words do not swap for ever. Rarer and unseen words back off to a class
by their ending.

A word's probability is P(class | class before) * P(word | class), both smoothed by addition;
one more place in each class stands for its unseen words. Words are known by 60 bits of hash;
the low 4 bits hold the class of the ending. Counts and classes of at most `HEAD` most
frequent words go to every task; others meet theirs in joins, for transitions as for emissions.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seriesloom.llm.base import Packed, cut_lineage, pieces, register, table, word_spans

CLASSES, ENDINGS = 48, 16
SEEDED, HEAD, MIN_COUNT = 4096, 1 << 18, 5
SWEEPS, ROUNDS = 2, 2
ADD_WORD, ADD_CLASS = 0.5, 0.1
#: Classes: exchanged ones, those by ending, the text's end (and start).
END_CLASS = CLASSES + ENDINGS
K = END_CLASS + 1
#: Hash of the end token; no word has it, as its ending bits say.
END = np.int64(-1 << 4)
#: A transition whose other word is looked up as well.
BOTH = 2 * K
#: Distinct words that a task gathers before it hands them on.
FLUSH = 1 << 20

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def token_stream(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all tokens of a batch's texts, each followed by its end, and the text of each."""
    packed = Packed(batch.column("text"))
    packed.bytes = _LOWER[packed.bytes]
    starts, ends, text = word_spans(packed)
    h = packed.hasher()(starts, ends).view(np.int64)
    last = packed.bytes[ends - 1].astype(np.int64) if len(ends) else np.zeros(0, np.int64)
    before = packed.bytes[np.maximum(ends - 2, starts)].astype(np.int64) if len(ends) else last
    h = (h & ~np.int64(15)) | ((last * 31 + before) % ENDINGS)
    n = batch.num_rows
    per = np.bincount(text, minlength=n)
    out = np.full(len(h) + n, END, np.int64)
    out[np.arange(len(h)) + text] = h
    return out, np.repeat(np.arange(n), per + 1)


def _pairs_out(gathered: list, names: tuple[str, str]) -> pa.RecordBatch:
    keys = np.concatenate([k for k, _ in gathered])
    counts = np.concatenate([c for _, c in gathered])
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    first = np.flatnonzero(np.diff(keys, prepend=keys[:1] - 1) != 0)
    return pa.RecordBatch.from_arrays(
        [pa.array(keys[first]), pa.array(np.add.reduceat(counts, first))], list(names)
    )


def word_counts(train: DataFrame) -> DataFrame:
    """h, c: the count of each training token, the end included."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gathered, held = [], 0
        for batch in pieces(batches, "text"):
            h, c = np.unique(token_stream(batch)[0], return_counts=True)
            gathered.append((h, c.astype(np.int64)))
            held += len(h)
            if held > FLUSH:
                yield _pairs_out(gathered, ("h", "c"))
                gathered, held = [], 0
        if gathered:
            yield _pairs_out(gathered, ("h", "c"))

    parts = train.select("text").mapInArrow(run, "h long, c long")
    return parts.groupBy("h").agg(F.sum("c").alias("c"))


class Classes:
    """Class of each token: the exchanged words by table, others by ending."""

    def __init__(self, words: np.ndarray, classes: np.ndarray):
        order = np.argsort(words)
        self.words, self.classes, self.place = words[order], classes[order], order

    def rank(self, h: np.ndarray) -> np.ndarray:
        """Place in the vocabulary, -1 for other tokens."""
        if not len(self.words):
            return np.full(len(h), -1)
        at = np.minimum(np.searchsorted(self.words, h), len(self.words) - 1)
        return np.where(self.words[at] == h, at, -1)

    def of(self, h: np.ndarray, rank: np.ndarray) -> np.ndarray:
        out = np.where(rank >= 0, self.classes[rank] if len(self.classes) else 0, CLASSES + (h & 15))
        return np.where(h == END, END_CLASS, out)


def _cells(train: DataFrame, classes: Classes) -> np.ndarray:
    """Of each word of `classes`: counts of the classes before and after it, summed by Spark."""
    shape = (len(classes.words), 2 * K)
    held = train.sparkSession.sparkContext.broadcast(classes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = held.value
        total = np.zeros(shape[0] * shape[1], np.int64)
        for batch in pieces(batches, "text"):
            h, _ = token_stream(batch)
            rank = own.rank(h)
            before, after = _neighbours(own.of(h, rank))
            known = rank >= 0
            r = rank[known] * (2 * K)
            total += np.bincount(r + before[known], minlength=len(total))
            total += np.bincount(r + K + after[known], minlength=len(total))
        cell = np.flatnonzero(total)
        if len(cell):
            yield pa.RecordBatch.from_arrays([pa.array(cell), pa.array(total[cell])], ["cell", "n"])

    summed = (
        train.select("text").mapInArrow(run, "cell long, n long")
        .groupBy("cell").agg(F.sum("n").alias("n")).toArrow()
    )
    return _dense(summed, shape)


def _dense(summed: pa.Table, shape: tuple[int, int]) -> np.ndarray:
    out = np.zeros(shape[0] * shape[1], np.int64)
    out[summed.column("cell").to_numpy()] = summed.column("n").to_numpy()
    return out.reshape(shape)


def _neighbours(k: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Classes before and after each token; each text begins after an end, and so does a batch."""
    return np.concatenate([[END_CLASS], k[:-1]]), np.concatenate([k[1:], [END_CLASS]])


def _distinct(n: np.ndarray, *cols: np.ndarray) -> tuple[np.ndarray, ...]:
    """Distinct rows of `cols` in their order, with the sums of `n` first."""
    order = np.lexsort(cols[::-1])
    cols = tuple(c[order] for c in cols)
    new = np.ones(len(order), bool)
    if len(order):
        new[1:] = np.logical_or.reduce([c[1:] != c[:-1] for c in cols])
    first = np.flatnonzero(new)
    total = np.add.reduceat(n[order], first) if len(first) else n[:0]
    return total, *(c[first] for c in cols)


def word_profiles(train: DataFrame, seeded: Classes, min_count: int = MIN_COUNT) -> DataFrame:
    """h, cells, ns of each frequent word outside `seeded`: its counts beside each class.

    A word has 2 K cells at most. A task hands on its counts word by word, so that the
    shuffle carries a hash once per word and not once per cell.
    """
    held = train.sparkSession.sparkContext.broadcast(seeded)

    def out(gathered: list) -> pa.RecordBatch:
        n, h, cell = _distinct(*(np.concatenate(x) for x in zip(*gathered)))
        first = np.flatnonzero(np.diff(h, prepend=h[:1] - 1) != 0)
        cuts = pa.array(np.append(first, len(h)).astype(np.int32))
        lists = [pa.ListArray.from_arrays(cuts, pa.array(x)) for x in (cell.astype(np.int16), n)]
        return pa.RecordBatch.from_arrays([pa.array(h[first]), *lists], ["h", "cells", "ns"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = held.value
        gathered, size = [], 0
        for batch in pieces(batches, "text"):
            h, _ = token_stream(batch)
            rank = own.rank(h)
            before, after = _neighbours(own.of(h, rank))
            rest = (rank < 0) & (h != END)
            cell = np.concatenate([before[rest], K + after[rest]])
            if len(cell):
                gathered.append(_distinct(np.ones(len(cell), np.int64), np.tile(h[rest], 2), cell))
                size += len(gathered[-1][0])
            if size > FLUSH:
                yield out(gathered)
                gathered, size = [], 0
        if gathered:
            yield out(gathered)

    rows = train.select("text").mapInArrow(run, "h long, cells array<short>, ns array<long>")
    summed = (
        rows.repartition("h").select("h", F.inline(F.arrays_zip("cells", "ns")))
        .groupBy("h", "cells").agg(F.sum("ns").alias("n"))
    )
    count = F.sum(F.when(F.col("cells") < K, F.col("n")).otherwise(0))
    return (
        summed.groupBy("h")
        .agg(F.sort_array(F.collect_list(F.struct("cells", "n"))).alias("p"), count.alias("c"))
        .where(F.col("c") >= min_count)
        .select("h", F.col("p.cells").alias("cells"), F.col("p.n").alias("ns"))
    )


def _plain(x: np.ndarray) -> np.ndarray:
    return x * np.log(np.maximum(x, 1))


def best_classes(
    rows: np.ndarray, cell: np.ndarray, n: np.ndarray, sums: np.ndarray, own: np.ndarray | None
) -> np.ndarray:
    """The class that each word, given by its non-zero cells, raises the likelihood most in.

    Classes without words are left out, as all words would move there at once.
    `own`: the classes that the words are in, and whose sums hold them; None if in none.
    """
    count = int(rows[-1]) + 1 if len(rows) else 0
    add = lambda x: np.bincount(rows, x, count)
    size = add(n) / 2
    totals, flat = sums.sum(1) / 2, _plain(sums)
    gains = np.empty((count, CLASSES))
    for k in range(CLASSES):
        joined = add(_plain(sums[k, cell] + n) - flat[k, cell])
        gains[:, k] = joined - 2 * (_plain(totals[k] + size) - _plain(totals[k]))
    if own is not None:
        k = own[rows]
        left = add(flat[k, cell] - _plain(sums[k, cell] - n))
        at = totals[own]
        gains[np.arange(count), own] = left - 2 * (_plain(at) - _plain(at - size))
    gains[:, totals == 0] = -np.inf
    return gains.argmax(1)


def exchange_all(profiles: DataFrame, sums: np.ndarray, rounds: int = ROUNDS) -> DataFrame:
    """h, k: the class of each word of `profiles`, given the sums of the seeded classes.

    Between rounds only the sums of the classes come to the driver. A word's earlier moves
    follow from those sums, so a round works them out again and no table of classes is kept.
    """
    profiles = cut_lineage(profiles)
    context = profiles.sparkSession.sparkContext
    known = [sums]

    def placed(batch: pa.RecordBatch, known: list[np.ndarray]):
        cells, ns = batch.column("cells"), batch.column("ns")
        rows = np.repeat(np.arange(batch.num_rows), cells.value_lengths().to_numpy(False))
        cell = cells.flatten().to_numpy(False).astype(np.int64)
        n = ns.flatten().to_numpy(False).astype(float)
        half = (batch.column("h").to_numpy() >> 4) & 1
        k = best_classes(rows, cell, n, known[0], None)
        for i, later in enumerate(known[1:]):
            k = np.where(half == i % 2, best_classes(rows, cell, n, later, k), k)
        return rows, cell, n, k

    for _ in range(rounds - 1):
        held = context.broadcast(list(known))

        def summed(batches: Iterator[pa.RecordBatch], held=held) -> Iterator[pa.RecordBatch]:
            total = np.zeros(CLASSES * 2 * K)
            for batch in batches:
                rows, cell, n, k = placed(batch, held.value)
                total += np.bincount(k[rows] * (2 * K) + cell, n, len(total))
            at = np.flatnonzero(total)
            if len(at):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(at), pa.array(total[at].astype(np.int64))], ["cell", "n"]
                )

        table_of = profiles.mapInArrow(summed, "cell long, n long").groupBy("cell")
        known.append(sums + _dense(table_of.agg(F.sum("n").alias("n")).toArrow(), sums.shape))
    held = context.broadcast(known)

    def last(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            k = placed(batch, held.value)[3]
            yield pa.RecordBatch.from_arrays(
                [batch.column("h"), pa.array(k.astype(np.int32))], ["h", "k"]
            )

    return profiles.mapInArrow(last, "h long, k int")


def _gain(p: np.ndarray) -> np.ndarray:
    """A class's part of the class-bigram likelihood, given its counts beside each class."""
    return _plain(p).sum(-1) - 2 * _plain(p.sum(-1) / 2)


def exchange(profiles: np.ndarray, classes: np.ndarray) -> tuple[np.ndarray, int]:
    """Move each word, in order of frequency, to the class where the likelihood is largest."""
    classes = classes.copy()
    sums = np.zeros((CLASSES, profiles.shape[1]))
    np.add.at(sums, classes, profiles)
    gains, moved = _gain(sums), 0
    for w in np.argsort(-profiles.sum(1), kind="stable"):
        p, old = profiles[w], classes[w]
        without = sums[old] - p
        sums[old], gains[old] = without, _gain(without)
        new = int(np.argmax(_gain(sums + p) - gains))
        sums[new] += p
        gains[new] = _gain(sums[new])
        moved += new != old
        classes[w] = new
    return classes, moved


def cluster(train: DataFrame, words: np.ndarray, sweeps: int = SWEEPS) -> tuple[Classes, np.ndarray]:
    """Exchange clustering of `words` (most frequent first), and the sums of the classes."""
    classes = Classes(words, np.arange(len(words)) % CLASSES)
    sums = np.zeros((CLASSES, 2 * K))
    for _ in range(sweeps if len(words) else 0):
        profiles = _cells(train, classes).astype(float)
        better, moved = exchange(profiles, classes.classes)
        classes = Classes(classes.words, better)
        sums[:] = 0
        np.add.at(sums, better, profiles)
        if not moved:
            break
    return classes, sums


def frequent(counts: DataFrame, most: int) -> DataFrame:
    """The words counted more often than some bound, `most` of them at most.

    The bound comes from a histogram by the logarithm of the count, so nothing is ordered
    and words of equal count stay together.
    """
    grade = F.floor(F.log2("c") * 16)
    steps = counts.groupBy(grade.alias("g")).count().collect()  # 16 * 63 rows at most
    held, bound = 0, None
    for r in sorted(steps, key=lambda r: -r.g):
        held += r["count"]
        if held > most:
            break
        bound = r.g
    return counts.where(grade >= bound if bound is not None else F.lit(False))


def _ending(h: str):
    return (CLASSES + F.col(h).bitwiseAND(15)).cast("int")


def _look_up(df: DataFrame, h: str, spread, words: DataFrame, cols: list[str]) -> DataFrame:
    """`cols` of the word `h`; rows without a word are dealt by `spread`, as they match none."""
    w = words.select(F.col("h").alias("__h"), *cols)
    key = F.coalesce(h, F.coalesce(spread, F.lit(0)).cast("long"))
    return df.join(w, (key == F.col("__h")) & F.col(h).isNotNull(), "left").drop("__h")


def transitions(train: DataFrame, head: Classes, words: DataFrame) -> np.ndarray:
    """[class before, class]: counts over all training tokens, all words by their own class."""
    held = train.sparkSession.sparkContext.broadcast(head)

    def out(gathered: list) -> pa.RecordBatch:
        n, h, cell, other = _distinct(*(np.concatenate(x) for x in zip(*gathered)))
        other = pa.array(other, mask=cell != BOTH)
        return pa.RecordBatch.from_arrays(
            [pa.array(h), pa.array(cell.astype(np.int32)), other, pa.array(n)],
            ["h", "cell", "other", "n"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = held.value
        total = np.zeros(K * K, np.int64)
        gathered, size = [], 0
        for batch in pieces(batches, "text"):
            h, _ = token_stream(batch)
            k, step, rows = _open_steps(h, own)
            total += np.bincount(step, minlength=len(total))
            if len(rows[0]):
                gathered.append(_distinct(np.ones(len(rows[0]), np.int64), *rows[1:]))
                size += len(gathered[-1][0])
            if size > FLUSH:
                yield out(gathered)
                gathered, size = [], 0
        if gathered:
            yield out(gathered)
        at = np.flatnonzero(total)
        if len(at):
            none = pa.nulls(len(at), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [none, pa.array(at.astype(np.int32)), none, pa.array(total[at])],
                ["h", "cell", "other", "n"],
            )

    rows = train.select("text").mapInArrow(run, "h long, cell int, other long, n long")
    cell, k = F.col("cell"), F.coalesce("k", _ending("h"))
    # Place in the table of K x K; with the class before still open, the class alone.
    place = (
        F.when(F.col("h").isNull(), cell).when(cell == BOTH, k)
        .when(cell < K, cell * K + k).otherwise(k * K + cell - K)
    )
    one = (
        _look_up(rows, "h", cell, words, ["k"])
        .groupBy("other", place.alias("place")).agg(F.sum("n").alias("n"))
    )
    before = F.coalesce("k", _ending("other")) * K
    both = (
        _look_up(one, "other", F.col("place"), words, ["k"])
        .groupBy((F.when(F.col("other").isNull(), 0).otherwise(before) + F.col("place")).alias("cell"))
        .agg(F.sum("n").alias("n"))
    )
    return _dense(both.toArrow(), (K, K))


def _open_steps(h: np.ndarray, head: Classes):
    """Classes of tokens, the K x K places of steps between known ones, and the other steps.

    The other steps: token number, word, cell and second word. The cell is the class before the
    word, or K + the class after it, or BOTH if the second word, not known either, is before it.
    """
    rank = head.rank(h)
    k = head.of(h, rank)
    closed = (rank >= 0) | (h == END)
    prev_closed = np.concatenate([[True], closed[:-1]])
    before = _neighbours(k)[0]
    step = (before * K + k)[closed & prev_closed]
    prev = np.concatenate([[END], h[:-1]])
    here = np.flatnonzero(~closed)
    after = np.flatnonzero(closed & ~prev_closed)
    both = ~prev_closed[here]
    rows = (
        np.concatenate([here, after]),
        np.concatenate([h[here], prev[after]]),
        np.concatenate([np.where(both, BOTH, before[here]), K + k[after]]),
        np.concatenate([np.where(both, prev[here], 0), np.zeros(len(after), np.int64)]),
    )
    return k, step, rows


def score(
    docs: DataFrame,
    held_out,
    sweeps: int = SWEEPS,
    *,
    seeded: int = SEEDED,
    head: int = HEAD,
    min_count: int = MIN_COUNT,
) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score per row.

    `held_out` is a boolean column expression, true for rows that train nothing. A null text
    is empty: its end is its only token. Repeated rows train and are scored each; an empty
    table gives an empty result; with nothing to train from, every token is unseen. Other
    columns are ignored. `head` bounds what goes to every task and changes no result.
    """
    docs = docs.select("doc_id", "text", F.coalesce(held_out, F.lit(False)).alias("held_out"))
    train = docs.where(~F.col("held_out"))
    counts = cut_lineage(word_counts(train))
    is_end = F.col("h") == int(END)
    sums = counts.agg(
        F.coalesce(F.sum("c"), F.lit(0)), F.count(F.lit(1)), F.coalesce(F.max(F.when(is_end, F.col("c"))), F.lit(0))
    ).first()
    n, v, ends = (int(x) for x in sums)
    first = frequent(counts.where(~is_end), 16 * seeded).toArrow()
    h, c = (first.column(x).to_numpy() for x in ("h", "c"))
    classes, class_sums = cluster(train, h[np.lexsort((h, -c))][:seeded], sweeps)

    spark = docs.sparkSession
    listed = spark.createDataFrame(
        [(int(h), int(k)) for h, k in zip(classes.words, classes.classes)], "h long, k int"
    )
    further = exchange_all(word_profiles(train, classes, min_count), class_sums)
    words = cut_lineage(
        counts.where(~is_end).join(listed.unionByName(further), "h", "left")
        .select("h", "c", F.coalesce("k", _ending("h")).alias("k"))
    )
    kinds = words.groupBy("k").agg(F.sum("c").alias("n"), F.count(F.lit(1)).alias("v"))
    room = np.full(K, ADD_WORD)
    for r in kinds.collect():  # K rows at most
        room[r.k] = r.n + ADD_WORD * (r.v + 1)
    near = frequent(words, head).orderBy("h").toArrow()
    near_h, near_c, near_k = (near.column(x).to_numpy() for x in ("h", "c", "k"))
    known = Classes(near_h, near_k.astype(np.int64))
    steps = transitions(train, known, words)
    step = np.log10((steps + ADD_CLASS) / (steps.sum(1, keepdims=True) + ADD_CLASS * K)).ravel()
    held = spark.sparkContext.broadcast((known, near_c, step, room, n, v, ends))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, near_c, step, room, n, v, ends = held.value
        near_c = np.append(near_c, ends)  # place -1: the end
        for batch in pieces(batches, "text"):
            h, text = token_stream(batch)
            k, steps, (token, word, cell, other) = _open_steps(h, known)
            rank = known.rank(h)
            closed = (rank >= 0) | (h == END)
            c = np.where(closed, near_c[rank], 0)
            base = np.where(closed, np.log10((c + 1) / (n + v + 1)), 0)
            own = np.where(closed & (h != END), np.log10((c + ADD_WORD) / room[k]), 0)
            prev_closed = np.concatenate([[True], closed[:-1]])
            own[closed & prev_closed] += step[steps]
            rows = batch.num_rows
            add = lambda x: np.bincount(text, x, rows)
            # Steps beside other words go on, once per text.
            t, at, word, cell, other = _distinct(
                np.ones(len(token), np.int64), text[token], word, cell, other
            )
            one, two = cell != BOTH, cell == BOTH

            def lists(of: np.ndarray, x: np.ndarray, kind) -> pa.ListArray:
                cuts = np.searchsorted(at[of], np.arange(rows + 1)).astype(np.int32)
                return pa.ListArray.from_arrays(pa.array(cuts), pa.array(x[of].astype(kind)))

            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("held_out"),
                 pa.array(np.bincount(text, minlength=rows)), pa.array(add(c > 0).astype(np.int64)),
                 pa.array(add(base)), pa.array(add(own)),
                 lists(one, word, np.int64), lists(one, cell, np.int16), lists(one, t, np.int32),
                 lists(two, word, np.int64), lists(two, other, np.int64), lists(two, t, np.int32)],
                ["doc_id", "held_out", "n_tokens", "known", "base", "own",
                 "h", "cell", "t", "h2", "other", "t2"],
            )

    part = cut_lineage(
        docs.mapInArrow(
            run,
            f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, held_out boolean, n_tokens long,"
            " known long, base double, own double, h array<long>, cell array<short>, t array<int>,"
            " h2 array<long>, other array<long>, t2 array<int>",
        ).withColumn("row", F.monotonically_increasing_id())
    )
    rest = part.select(
        "row", F.inline(F.arrays_zip("h", "cell", "t")), F.lit(None).cast("long").alias("other")
    ).unionByName(
        part.select("row", F.inline(F.arrays_zip("h2", "other", "t2")))
        .select("row", F.col("h2").alias("h"), F.lit(BOTH).cast("short").alias("cell"),
                F.col("t2").alias("t"), "other")
    )
    c, k, cell = F.coalesce("c", F.lit(0)), F.coalesce("k", _ending("h")), F.col("cell").cast("int")
    itself = (cell < K) | (cell == BOTH)
    rooms, places = F.lit(room), F.lit(step)
    base = F.log10((c + 1) / F.lit(float(n + v + 1)))
    emitted = F.when(itself, F.log10((c + ADD_WORD) / F.get(rooms, k))).otherwise(0.0)
    stepped = (
        F.when(cell == BOTH, 0.0).when(cell < K, F.get(places, cell * K + k))
        .otherwise(F.get(places, k * K + cell - K))
    )
    once = (
        _look_up(rest, "h", F.col("row"), words, ["c", "k"])
        .groupBy("row", "other", F.when(cell == BOTH, k).alias("kb"))
        .agg(
            F.sum(F.when(itself & (c > 0), F.col("t")).otherwise(0)).alias("more"),
            F.sum(F.when(itself, F.col("t") * base).otherwise(0.0)).alias("more_base"),
            F.sum(F.col("t") * (emitted + stepped)).alias("more_own"),
            F.sum("t").alias("t"),
        )
    )
    before = F.coalesce("k", _ending("other"))
    last_step = F.coalesce(F.col("t") * F.get(places, before * K + F.col("kb")), F.lit(0.0))
    more = (
        _look_up(once, "other", F.col("row"), words, ["k"])
        .groupBy("row")
        .agg(
            F.sum("more").alias("more"), F.sum("more_base").alias("more_base"),
            F.sum(F.col("more_own") + last_step).alias("more_own"),
        )
    )
    plus = lambda a, b: F.col(a) + F.coalesce(F.col(b), F.lit(0))
    return part.select("row", "doc_id", "held_out", "n_tokens", "known", "base", "own").join(
        more, "row", "left"
    ).select(
        "doc_id", "held_out", "n_tokens", plus("known", "more").alias("n_known"),
        F.lit(n).cast("long").alias("train_tokens"), plus("base", "more_base").alias("base_score"),
        plus("own", "more_own").alias("score"),
    )


def perplexity(log10_probability, tokens):
    """Of a text or of any number of texts, from their sums."""
    return F.pow(F.lit(10.0), -log10_probability / tokens)


@register("op9_classlm")
def op9_classlm(spark, sf_dir):
    """All documents by a model of those whose id's CRC is not 2 modulo 7."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    crc = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary"))
    out = score(docs, crc % 7 == 2)
    return out.withColumn("perplexity", perplexity(F.col("score"), F.col("n_tokens")))
