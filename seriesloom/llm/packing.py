"""Best-fit packing of token pieces into sequences, certified by lower bounds.

Documents are tokenized where they are read; only lengths travel on. Pieces are dealt over
partitions, and each is packed by best-fit decreasing. Dual feasible functions give a lower
bound on its number of bins: where it is met, the partition's bins are certified. What does
not fill its bin - in partitions with a gap all but full bins, else the open ends - is
exchanged: it goes to the next, smaller round and is packed again, until one partition is
left. A round's partition holds `part_rows` pieces at most, about.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seriesloom.llm.base import cut_lineage, pieces, register, table
from seriesloom.llm.tokens import encoder

CAPACITY = 1024
END_ID = 2
PART_ROWS = 100_000
#: A bin with at most this share free is closed and takes no part in the exchange.
SLACK = 0.005
ROUNDS = 12


def best_fit_decreasing(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, int]:
    """Bin and offset of each piece (1 to capacity long), and the number of bins."""
    order = np.argsort(-lengths, kind="stable")
    bins, offsets = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    open_by_room: list[list[int]] = [[] for _ in range(capacity + 1)]
    rooms, count = 0, 0  # bit r is set if a bin with room r is open
    for i, n in zip(order.tolist(), lengths[order].tolist()):
        fitting = rooms >> n
        if fitting:
            room = n + (fitting & -fitting).bit_length() - 1
            held = open_by_room[room]
            b = held.pop()
            if not held:
                rooms &= ~(1 << room)
        else:
            room, b = capacity, count
            count += 1
        bins[i], offsets[i] = b, capacity - room
        if room > n:
            open_by_room[room - n].append(b)
            rooms |= 1 << (room - n)
    return bins, offsets, count


def lower_bound(lengths: np.ndarray, capacity: int) -> int:
    """Bins that any packing needs: the best of two families of dual feasible functions."""
    if not len(lengths):
        return 0
    x = np.arange(capacity + 1)
    count = np.bincount(lengths, minlength=capacity + 1)
    cut = np.arange(0, capacity // 2 + 1)[:, None]
    raised = np.where(x > capacity - cut, capacity, np.where(x < cut, 0, x))
    best = int(-(-(raised @ count).max() // capacity))
    for k in range(1, 33):
        step = (k + 1) * x
        value = np.where(step % capacity == 0, k * x, step // capacity * capacity)
        best = max(best, int(-(-(value @ count) // (k * capacity))))
    return best


def token_pieces(docs: DataFrame, path: str, capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32: one row per piece of every whole text.

    A null or empty text is the end id alone. Texts longer than `capacity` are cut so that
    only the first piece is shorter; other columns of `docs` are ignored.
    """
    schema = pa.schema(
        [("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64())]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(path)
        try:
            for batch in pieces(batches, "text"):
                texts = [t or "" for t in batch.column("text").to_pylist()]
                row, piece, start, length, crc = [], [], [], [], []
                for k, ids in enumerate(encode.ids(texts)):
                    n = len(ids) + 1
                    raw = memoryview(np.append(ids, ids.dtype.type(end_id)).astype("<u4")).cast("B")
                    first = (n - 1) % capacity + 1
                    starts = [0, *range(first, n, capacity)]
                    row += [k] * len(starts)
                    piece += range(len(starts))
                    start += starts
                    length += [first] + [capacity] * (len(starts) - 1)
                    crc += [zlib.crc32(raw[4 * a : 4 * b]) for a, b in zip(starts, [*starts[1:], n])]
                columns = [batch.column("doc_id").take(pa.array(row)), piece, start, length, crc]
                yield pa.RecordBatch.from_arrays(
                    [c if isinstance(c, pa.Array) else pa.array(c, t) for c, t in zip(columns, schema.types)], schema=schema
                )
        finally:
            encode.forget()

    return docs.select("doc_id", "text").mapInArrow(
        run, "doc_id long, piece int, start long, length long, ids_crc32 long"
    )


def _packer(capacity: int, last: bool):
    """Packs one partition and says which of its bins are closed."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["length", "__row"], ascending=[False, True])
        length = pdf["length"].to_numpy()
        bins, offsets, count = best_fit_decreasing(length, capacity)
        tight = count == lower_bound(length, capacity)
        fill = np.bincount(bins, length, count)
        closed = fill >= (capacity * (1 - SLACK) if tight else capacity)
        return pd.DataFrame(
            {"__row": pdf["__row"], "length": length, "__part": pdf["__part"], "__bin": bins,
             "offset": offsets, "certified": tight, "__closed": closed[bins] | last}
        )

    return run


def pack(rows: DataFrame, capacity: int = CAPACITY, part_rows: int = PART_ROWS) -> DataFrame:
    """`rows` (with a column length of 1 to capacity) plus sequence_id, offset, certified.

    certified: the sequence comes from a partition whose number of bins equals its lower
    bound. Repeated rows are packed each; an empty table gives an empty result.
    """
    # The checkpoint fixes the rows' order, so that the ids are the same on each reading.
    rows = cut_lineage(rows.withColumn("__row", F.monotonically_increasing_id()))
    whole = rows.where(F.col("length") == capacity).select(
        "__row", (-F.col("__row") - 1).alias("sequence_id"),
        F.lit(0).cast("long").alias("offset"), F.lit(True).alias("certified"),
    )
    todo = rows.where(F.col("length") < capacity).select("__row", "length")
    done = []
    left = todo.count()
    first_id = 0
    for turn in range(ROUNDS):
        if not left:
            break
        parts = -(-left // part_rows)
        last = parts == 1 or turn == ROUNDS - 1

        dealt = todo.withColumn(
            "__part", F.pmod(F.xxhash64("__row", F.lit(turn)), F.lit(parts)).cast("int")
        )
        packed = cut_lineage(
            dealt.groupBy("__part").applyInPandas(
                _packer(capacity, last),
                "__row long, length long, __part int, __bin long, offset long, certified boolean,"
                " __closed boolean",
            )
        )
        most = part_rows * 4  # bins of a part have numbers below its rows
        done.append(
            packed.where("__closed").select(
                "__row",
                (F.lit(first_id) + F.col("__part").cast("long") * most + F.col("__bin")).alias("sequence_id"),
                "offset", "certified",
            )
        )
        first_id += parts * most
        todo = packed.where(~F.col("__closed")).select("__row", "length")
        left = todo.count()
    for part in done:
        whole = whole.unionByName(part)
    return rows.join(whole, "__row").drop("__row")


@register("op7_packing")
def op7_packing(spark, sf_dir):
    """All documents as token pieces in sequences of at most 1024 tokens."""
    import public_tokenizers

    docs = table(spark, sf_dir, "documents")
    return pack(token_pieces(docs, public_tokenizers.path("byte_bpe_50k.json"))).select(
        "doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset", "certified"
    )
