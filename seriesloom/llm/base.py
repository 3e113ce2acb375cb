"""Registry, table access and byte-level helpers that the operators share.

Texts reach Python as Arrow batches; `pieces` cuts them so that the numpy arrays of one
step stay within a few dozen MB whatever the batch holds.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession

from seriesloom.session import cut_lineage, ensure_checkpoint_dir, prepare_session

__all__ = [
    "ORACLES", "QUERIES", "Packed", "cut_lineage", "ensure_checkpoint_dir", "pieces",
    "register", "table", "word_spans",
]

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

#: Separators of words: space and the ASCII controls 9 to 13.
WORD_SEPARATORS = np.zeros(256, bool)
WORD_SEPARATORS[[0x20, *range(0x09, 0x0E)]] = True

#: Arrow text that one numpy step takes at a time; a longer text is a step of its own.
STEP_BYTES = 1 << 20

_BASE = np.uint64(0x9E3779B97F4A7C15)  # odd, so that it has an inverse modulo 2**64
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))
_CODES = np.random.default_rng(20240607).integers(1, 1 << 63, 256, np.uint64)


def register(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def keep(fn: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query registered twice: {name}")

        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return fn(prepare_session(spark), sf_dir)

        run.__name__, run.__doc__ = name, fn.__doc__
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return keep


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def pieces(batches: Iterator[pa.RecordBatch], text: str) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of about STEP_BYTES of `text`, at least one row each."""
    for batch in batches:
        if not batch.num_rows:
            continue
        size = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(False)
        step = np.cumsum(size.astype(np.int64)) // STEP_BYTES
        cuts = [0, *(np.flatnonzero(np.diff(step)) + 1).tolist(), batch.num_rows]
        for a, b in zip(cuts, cuts[1:]):
            yield batch.slice(a, b - a)


class Packed:
    """The UTF-8 bytes of several texts one after another (null: empty)."""

    _powers = np.ones(1, np.uint64)
    _inverses = np.ones(1, np.uint64)

    def __init__(self, texts: pa.Array):
        flat = pc.fill_null(texts, "").cast(pa.large_string())
        if isinstance(flat, pa.ChunkedArray):
            flat = flat.combine_chunks()
        offsets = np.frombuffer(flat.buffers()[1], np.int64)[flat.offset : flat.offset + len(flat) + 1]
        data = flat.buffers()[2]
        raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
        self.bytes = raw[offsets[0] : offsets[-1]]
        self.starts = offsets - offsets[0]

    def hasher(self) -> Callable[[np.ndarray, np.ndarray], np.ndarray]:
        """f(starts, ends): a 64-bit hash of each byte string, by prefix sums of a polynomial."""
        n = len(self.bytes) + 1
        if len(Packed._powers) < n:
            for name, base in (("_powers", _BASE), ("_inverses", _INVERSE)):
                full = np.full(n, base, np.uint64)
                full[0] = 1
                setattr(Packed, name, np.multiply.accumulate(full))
        sums = np.zeros(n, np.uint64)
        np.cumsum(_CODES[self.bytes] * Packed._powers[: n - 1], out=sums[1:])
        inverses = Packed._inverses

        def hash_of(starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
            return mix((sums[ends] - sums[starts]) * inverses[starts])

        return hash_of


def mix(h: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values (a bijection)."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def word_spans(
    packed: Packed, separators: np.ndarray = WORD_SEPARATORS
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and text number of each word: a maximal run of other bytes in one text."""
    inside = np.zeros(len(packed.bytes) + 1, bool)
    inside[:-1] = ~separators[packed.bytes]
    fresh = np.zeros(len(inside), bool)
    fresh[packed.starts] = True
    before = np.zeros(len(inside), bool)
    before[1:] = inside[:-1]
    starts = np.flatnonzero(inside & (fresh | ~before))
    ends = np.flatnonzero(before & (fresh | ~inside))
    text = np.searchsorted(packed.starts, starts, side="right") - 1
    return starts, ends, text
