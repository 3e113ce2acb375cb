"""Removal of long repeated byte strings by suffix order.

Every window of `length` bytes belongs to the least hash of the `GRAM`-byte strings in it,
so equal windows belong to equal hashes. A document is thus a sequence of spans of window
starts with one hash each, about one for 140 bytes, and a span's bytes go to the shard of its
hash: equal windows meet there, and no text is needed elsewhere.

- A hash that stands at one place only holds no repeat.
- Spans of one hash with equal bytes repeat each other in full; one row stands for them, and
  if all of a hash's spans are equal, no bytes need to travel at all.
- The different spans of a hash go to a shard, which sorts all suffixes of its spans by
  external induced sorting (`suffixes`); a window is a repeat if its common prefix with a
  neighbour reaches `length`.
- A hash whose different spans exceed `GROUP_BYTES` (a passage in many documents, with other
  text around it each time) would make a shard as large as its group. The windows of its spans
  are counted by their own hash instead, in a grouping that combines before the shuffle, so
  such a group is spread over all tasks.

Equality of spans is that of two 64-bit hashes of different strings of them, and so is that of
windows that are counted.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from seriesloom.llm.base import Packed, ensure_checkpoint_dir, pieces, register, table
from seriesloom.llm.jaccard import numbered
from seriesloom.llm.suffixes import repeated_starts

LENGTH, GRAM = 400, 128
#: Window starts of one span at most, so that spans stay small in periodic text.
SPAN = 1024
#: Span bytes that a shard sorts at a time, about; a hash's spans are never parted.
SHARD_BYTES = 8 << 20
#: Bytes of different spans of one hash that a shard takes at most; beyond, windows are counted.
GROUP_BYTES = 4 << 20
_SIEVE = 1 << 21


def stored(df: DataFrame) -> DataFrame:
    """Written as a table in the shared folder and read back: compact, and cuts the lineage."""
    path = f"{ensure_checkpoint_dir(df.sparkSession).rstrip('/')}/{uuid.uuid4().hex}.parquet"
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def sliding_least(h: np.ndarray, width: int) -> np.ndarray:
    """Least value of each `width` consecutive ones."""
    n = len(h) - width + 1
    if n <= 0:
        return h[:0]
    full = np.full(-(-len(h) // width) * width, np.iinfo(h.dtype).max, h.dtype)
    full[: len(h)] = h
    blocks = full.reshape(-1, width)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    back = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(back[:n], ahead[width - 1 : width - 1 + n])


def spans_of(packed: Packed, length: int, gram: int):
    """Text number, first window start in it, number of starts, hash, digest and `many` of each span.

    many: the span's hash stands at two places of it, so that it may repeat itself.
    """
    hash_of = packed.hasher()
    n = len(packed.bytes)
    if n < length:
        none = np.zeros(0, np.int64)
        return none, none, none, none, none, none.astype(bool)
    at = np.arange(n - gram + 1)
    grams = hash_of(at, at + gram)
    least = sliding_least(grams, length - gram + 1)
    sizes = np.diff(packed.starts)
    long = np.flatnonzero(sizes >= length)
    steps = np.zeros(n + 1, np.int64)  # windows inside one text
    np.add.at(steps, packed.starts[long], long + 1)
    np.add.at(steps, packed.starts[long] + sizes[long] - length + 1, -(long + 1))
    owner = np.cumsum(steps)[: n - length + 1] - 1
    change = np.flatnonzero((np.diff(least) != 0) | (np.diff(owner) != 0)) + 1
    cuts = np.unique(np.concatenate([[0], change]))
    size = np.diff(np.append(cuts, len(owner)))
    wide = np.flatnonzero((size > SPAN) & (owner[cuts] >= 0))
    if len(wide):
        more = [np.arange(cuts[k] + SPAN, cuts[k] + size[k], SPAN) for k in wide]
        cuts = np.unique(np.concatenate([cuts, *more]))
        size = np.diff(np.append(cuts, len(owner)))
    real = owner[cuts] >= 0
    cuts, size = cuts[real], size[real]
    digest = hash_of(cuts, cuts + size + length - 1) ^ size.astype(np.uint64)
    values, value = np.unique(least[cuts], return_inverse=True)
    low = np.uint64(_SIEVE - 1)
    sieve = np.zeros(_SIEVE, bool)
    sieve[(values & low).astype(np.int64)] = True
    places = np.flatnonzero(sieve[(grams & low).astype(np.int64)])
    if len(values):
        of = np.minimum(np.searchsorted(values, grams[places]), len(values) - 1)
        real = values[of] == grams[places]
        key = np.sort(of[real] * n + places[real])
        reach = cuts + size + length - gram
        many = np.searchsorted(key, value * n + reach) - np.searchsorted(key, value * n + cuts) > 1
    else:
        many = np.zeros(0, bool)
    text = owner[cuts]
    return text, cuts - packed.starts[text], size, least[cuts].view(np.int64), digest.view(np.int64), many


def _runs(flags: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    edges = np.diff(np.concatenate([[0], flags.astype(np.int8), [0]]))
    return np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)


def _shard(rows: list[tuple], length: int) -> pa.RecordBatch | None:
    """hash, digest, first and end start of each run of repeated windows of the shard's spans."""
    sizes = np.array([len(r[3]) + 1 for r in rows], np.int64)
    starts = np.concatenate([[0], np.cumsum(sizes)])
    with tempfile.TemporaryFile() as f:  # the shard's text lies on disk and is mapped
        for r in rows:
            f.write(r[3] + b"\xff")  # no byte of UTF-8: no window crosses spans
        f.flush()
        packed = Packed(pa.array([""]))
        packed.bytes = np.memmap(f, np.uint8, "r")
        marks = repeated_starts(packed.bytes, packed.hasher(), length)
    out: list[list] = [[], [], [], []]
    for r, a, b in zip(rows, starts[:-1].tolist(), starts[1:].tolist()):
        inside = b - a - length
        flags = np.ones(inside, bool) if r[2] > 1 else marks[a : a + inside]
        for x, y in zip(*_runs(flags)):
            for c, v in zip(out, (r[0], r[1], int(x), int(y))):
                c.append(v)
    if not out[0]:
        return None
    return pa.RecordBatch.from_arrays(
        [pa.array(c, pa.int64()) for c in out], ["h", "d", "x", "y"]
    )


def counted_windows(docs: DataFrame, kinds: DataFrame, length: int) -> DataFrame:
    """h, d, x, y as of `_shard` for spans (h, d, n, row, first, size), by counts of windows."""

    def hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "text"):
            packed = Packed(batch.column("text"))
            hash_of = packed.hasher()
            spans = [
                (s["h"], s["d"], s["n"], start + s["first"], s["size"])
                for start, own in zip(packed.starts.tolist(), batch.column("w").to_pylist())
                for s in own
            ]
            h, d, n, first, size = (np.array(c, np.int64) for c in zip(*spans))
            cuts = np.concatenate([[0], np.cumsum(size)])
            at = np.arange(cuts[-1]) + np.repeat(first - cuts[:-1], size)
            windows = pa.ListArray.from_arrays(
                pa.array(cuts, pa.int32()), pa.array(hash_of(at, at + length).view(np.int64))
            )
            yield pa.RecordBatch.from_arrays(
                [pa.array(h), pa.array(d), pa.array(n), windows], ["h", "d", "n", "windows"]
            )

    wanted = kinds.groupBy("row").agg(F.collect_list(F.struct("h", "d", "n", "first", "size")).alias("w"))
    windows = stored(
        docs.join(wanted, "row").mapInArrow(hashes, "h long, d long, n long, windows array<long>")
    ).select("h", "d", "n", F.posexplode("windows").alias("x", "window"))
    repeated = windows.groupBy("h", "window").agg(F.sum("n").alias("n")).where("n > 1").select("h", "window")
    # Consecutive starts have one difference to their rank in the span (SPAN starts at most).
    rank = F.row_number().over(Window.partitionBy("h", "d").orderBy("x"))
    return stored(
        windows.join(repeated, ["h", "window"])
        .select("h", "d", "x", (F.col("x") - rank).alias("run"))
        .groupBy("h", "d", "run")
        .agg(F.min("x").cast("long").alias("x"), (F.max("x") + 1).cast("long").alias("y"))
        .drop("run")
    )


def repeated_spans(docs: DataFrame, length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """row, first, last: runs of window starts whose `length` bytes start elsewhere too."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "text"):
            text, first, size, h, d, many = spans_of(Packed(batch.column("text")), length, gram)
            if len(text):
                yield pa.RecordBatch.from_arrays(
                    [batch.column("row").take(pa.array(text)), pa.array(first), pa.array(size.astype(np.int32)),
                     pa.array(h), pa.array(d), pa.array(many)],
                    ["row", "first", "size", "h", "d", "many"],
                )

    docs = docs.select("row", "text")
    spans = stored(docs.mapInArrow(cut, "row long, first long, size int, h long, d long, many boolean"))
    often = (
        spans.groupBy("h")
        .agg(F.count(F.lit(1)).alias("n"), F.min("d").alias("d0"), F.max("d").alias("d1"), F.max("many").alias("many"))
        .where("n > 1 OR many")
        .select("h", ((F.col("d0") != F.col("d1")) | F.col("many")).alias("mixed"))
    )
    found = stored(spans.drop("many").join(often, "h"))
    equal = found.where(~F.col("mixed")).select("row", "first", (F.col("first") + F.col("size") - 1).alias("last"))

    # One span stands for equal ones; its text is cut where the document lies.
    kinds = stored(
        found.where("mixed").groupBy("h", "d")
        .agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("row", "first", "size")).alias("s"))
        .select("h", "d", "n", "s.*")
    )
    wide = stored(
        kinds.groupBy("h").agg(F.sum(F.col("size") + (length - 1)).alias("bytes"))
        .where(F.col("bytes") > GROUP_BYTES).select("h")
    )
    wanted = kinds.join(wide, "h", "left_anti").groupBy("row").agg(F.collect_list(F.struct("h", "d", "n", "first", "size")).alias("w"))

    def fetch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "text"):
            rows = []
            for text, own in zip(batch.column("text").to_pylist(), batch.column("w").to_pylist()):
                raw = text.encode()
                rows += [
                    (s["h"], s["d"], s["n"], raw[s["first"] : s["first"] + s["size"] + length - 1])
                    for s in own
                ]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*rows), (pa.int64(), pa.int64(), pa.int64(), pa.binary()))],
                ["h", "d", "n", "bytes"],
            )

    def sort(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        size = 0
        for batch in batches:
            for r in zip(*(c.to_pylist() for c in batch.columns)):
                if size > SHARD_BYTES and r[0] != held[-1][0]:
                    if (out := _shard(held, length)) is not None:
                        yield out
                    held, size = [], 0
                held.append(r)
                size += len(r[3])
        if held and (out := _shard(held, length)) is not None:
            yield out

    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    sorted_ = stored(
        docs.join(wanted, "row")
        .mapInArrow(fetch, "h long, d long, n long, bytes binary")
        .repartition(parts, "h")
        .sortWithinPartitions("h", "d")
        .mapInArrow(sort, "h long, d long, x long, y long")
    )
    if not wide.isEmpty():
        sorted_ = sorted_.unionByName(counted_windows(docs, kinds.join(wide, "h"), length))
    mixed = found.where("mixed").join(sorted_, ["h", "d"]).select(
        "row", (F.col("first") + F.col("x")).alias("first"), (F.col("first") + F.col("y") - 1).alias("last")
    )
    return equal.unionByName(mixed)


def remove_repeats(docs: DataFrame, length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """row, kept (the remaining bytes), n_bytes, n_removed, n_spans for each row of `docs`.

    `docs` has row (long, unique) and text. A byte goes if a string of `length` bytes over it
    also starts anywhere else, so all copies of a repeat go, whole equal texts included. A
    null text is empty, texts shorter than `length` stay as they are, an empty table gives an
    empty result; other columns are ignored.
    """
    spans = repeated_spans(docs, length, gram)
    lists = spans.groupBy("row").agg(F.collect_list(F.struct("first", "last")).alias("spans"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "text"):
            rows = []
            for row, text, spans in zip(*(c.to_pylist() for c in batch.columns)):
                raw = (text or "").encode()
                if not spans:
                    rows.append((row, raw, len(raw), 0, 0))
                    continue
                mask = np.zeros(len(raw) + 1, np.int32)
                np.add.at(mask, [s["first"] for s in spans], 1)
                np.add.at(mask, [s["last"] + length for s in spans], -1)
                gone = np.cumsum(mask[:-1]) > 0
                kept = np.frombuffer(raw, np.uint8)[~gone].tobytes()
                rows.append((row, kept, len(raw), int(gone.sum()), len(_runs(gone)[0])))
            kinds = (pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*rows), kinds)],
                ["row", "kept", "n_bytes", "n_removed", "n_spans"],
            )

    return docs.select("row", "text").join(lists, "row", "left").mapInArrow(
        cut, "row long, kept binary, n_bytes long, n_removed long, n_spans long"
    )


@register("op3_substrings")
def op3_substrings(spark, sf_dir):
    """Bytes, removed bytes, removed runs and digest of the rest of every document."""
    docs = numbered(table(spark, sf_dir, "documents").select("doc_id", "text"))
    out = remove_repeats(docs).withColumn("kept_sha256", F.sha2("kept", 256))
    return out.join(docs.select("row", "doc_id"), "row").select(
        "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"
    )
