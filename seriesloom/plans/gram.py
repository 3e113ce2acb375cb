"""Cross-product (Gram) matrices per series by distributed partial sums.

Least squares on a long series only needs X'X. Each task sums X'X of the rows it
holds, whatever series they belong to; a keyed sum finishes the job. The matrices
that reach a solver have a few hundred to a few thousand numbers per series.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute  # noqa: F401  (pa.compute)
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Bytes of partial sums one task keeps before passing them on, and of one output batch.
HELD_BYTES = 64 << 20
BATCH_BYTES = 8 << 20


class _Partial:
    """Rows of one series, summed to X'X once that takes less room than the rows."""

    __slots__ = ("rows", "count", "matrix")

    def __init__(self) -> None:
        self.rows: list[np.ndarray] = []
        self.count = 0
        self.matrix: np.ndarray | None = None

    def add(self, x: np.ndarray) -> int:
        """Take rows; returns by how many bytes this has grown."""
        k = x.shape[1]
        if self.matrix is None and self.count + len(x) <= (k + 1) // 2:
            self.rows.append(x)
            self.count += len(x)
            return x.nbytes
        grown = 0
        if self.matrix is None:
            self.matrix = np.zeros((k, k))
            grown = self.matrix.nbytes - sum(r.nbytes for r in self.rows)
            for r in self.rows:
                self.matrix += r.T @ r
            self.rows = []
        self.matrix += x.T @ x
        return grown

    def values(self, tri: tuple) -> np.ndarray:
        if self.matrix is not None:
            return self.matrix[tri]
        return np.concatenate(self.rows).ravel()


def _batches(key: str, rows: Iterable[tuple[str | None, bool, np.ndarray]]) -> Iterator[pa.RecordBatch]:
    names, summed, values, size = [], [], [], 0
    for name, is_sum, v in rows:
        names.append(name)
        summed.append(is_sum)
        values.append(v)
        size += v.nbytes
        if size > BATCH_BYTES:
            yield _batch(key, names, summed, values)
            names, summed, values, size = [], [], [], 0
    if names:
        yield _batch(key, names, summed, values)


def _batch(key: str, names: list, summed: list, values: list) -> pa.RecordBatch:
    offsets = np.concatenate([[0], np.cumsum([len(v) for v in values])]).astype(np.int32)
    lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(values)))
    return pa.RecordBatch.from_arrays(
        [pa.array(names, pa.string()), pa.array(summed), lists], names=[key, "summed", "v"]
    )


def _partials(key: str, k: int, tri: tuple) -> Callable:
    """Per series either the packed triangle of X'X or, if that is larger, the rows."""

    def out(held: dict) -> Iterator[pa.RecordBatch]:
        return _batches(key, ((n, p.matrix is not None, p.values(tri)) for n, p in held.items()))

    def sums(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str | None, _Partial] = {}
        size = 0
        for b in batches:
            if b.num_rows == 0:
                continue
            ids = b.column(0).dictionary_encode()
            codes = pa.compute.fill_null(ids.indices, -1).to_numpy(zero_copy_only=False)
            x = b.column(1).flatten().to_numpy(zero_copy_only=False).reshape(-1, k)
            whole = np.flatnonzero(~np.isnan(x).any(axis=1))
            if not len(whole):
                continue
            order = whole[np.argsort(codes[whole], kind="stable")]
            cuts = np.flatnonzero(np.diff(codes[order])) + 1
            for part in np.split(order, cuts):
                code = int(codes[part[0]])
                name = None if code < 0 else ids.dictionary[code].as_py()
                size += held.setdefault(name, _Partial()).add(x[part])
            if size > HELD_BYTES:
                yield from out(held)
                held, size = {}, 0
        yield from out(held)

    return sums


def _totals(key: str, k: int, tri: tuple) -> Callable:
    """Add up the partials of each series of a partition sorted by series."""

    def finish(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def series() -> Iterator[tuple[str | None, bool, np.ndarray]]:
            now, total, begun = None, np.zeros(len(tri[0])), False
            for b in batches:
                values = b.column(2)
                for i, (name, summed) in enumerate(zip(b.column(0).to_pylist(), b.column(1).to_pylist())):
                    if begun and name != now:
                        yield now, True, total
                        total = np.zeros(len(tri[0]))
                    now, begun = name, True
                    v = values[i].values.to_numpy()
                    if summed:
                        total = total + v
                    else:
                        x = v.reshape(-1, k)
                        total = total + (x.T @ x)[tri]
            if begun:
                yield now, True, total

        for b in _batches(key, series()):
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(2)], names=[key, "g"])

    return finish


def gram(df: DataFrame, key: str, cols: Sequence[str]) -> DataFrame:
    """``key, g``: upper triangle of X'X of ``cols``, row by row, as one array per series.

    A task hands on one packed triangle per series, or the series' rows where these are
    fewer numbers, so a shuffle never carries more than the input. Rows with a null in any
    column are left out, by the summing function: as one array the columns stay out of the
    optimizer's null-constraint inference, whose cost explodes with the number of columns.
    """
    tri = np.triu_indices(len(cols))
    row = F.array(*(F.col(c).cast("double") for c in cols))
    slim = df.select(F.col(key).cast("string").alias(key), row.alias("x"))
    parts = slim.mapInArrow(
        _partials(key, len(cols), tri), f"{key} string, summed boolean, v array<double>"
    )
    tasks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return (
        parts.repartition(tasks, key)
        .sortWithinPartitions(key)
        .mapInArrow(_totals(key, len(cols), tri), f"{key} string, g array<double>")
    )


def full_matrix(g: Sequence[float], k: int) -> np.ndarray:
    """Symmetric matrix from its upper triangle."""
    m = np.zeros((k, k))
    m[np.triu_indices(k)] = np.asarray(g, dtype=float)
    return m + np.triu(m, 1).T


class Fit:
    """Least squares of one column of a Gram matrix on some of the others."""

    def __init__(
        self,
        m: np.ndarray,
        xs: Sequence[int],
        y: int,
        n: float,
        ridge: np.ndarray | None = None,
    ) -> None:
        xs = list(xs)
        a = m[np.ix_(xs, xs)].copy()
        if ridge is not None:
            a += np.diag(ridge)
        self.inverse = np.linalg.pinv(a, hermitian=True) if xs else np.zeros((0, 0))
        b = m[xs, y]
        self.beta = self.inverse @ b
        fitted = self.beta @ b
        if ridge is None:
            self.ssr = max(m[y, y] - fitted, 0.0)
        else:
            plain = m[np.ix_(xs, xs)]
            self.ssr = max(m[y, y] - 2 * fitted + self.beta @ plain @ self.beta, 0.0)
        self.n = n
        self.k = len(xs)

    @property
    def sigma2(self) -> float:
        return self.ssr / max(self.n - self.k, 1)

    @property
    def errors(self) -> np.ndarray:
        return np.sqrt(np.maximum(np.diag(self.inverse) * self.sigma2, 0.0))

    def loglik(self) -> float:
        s2 = max(self.ssr / self.n, 1e-300)
        return -0.5 * self.n * (np.log(2 * np.pi * s2) + 1.0)

    def aic(self, extra: int = 0) -> float:
        return -2 * self.loglik() + 2 * (self.k + extra)

    def bic(self, extra: int = 0) -> float:
        return -2 * self.loglik() + np.log(self.n) * (self.k + extra)


def per_series(df: DataFrame, solve: Callable[[dict], list[dict]], schema: str) -> DataFrame:
    """Apply ``solve`` to each (small) row and emit the rows it returns."""
    names = [part.split()[0].strip("`") for part in _fields(schema)]

    def run(frames: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            out = [r for row in f.to_dict("records") for r in solve(row)]
            yield pd.DataFrame(out, columns=names)

    return df.mapInPandas(run, schema)


def _fields(schema: str) -> list[str]:
    """Split a DDL string at top-level commas."""
    out, depth, start = [], 0, 0
    for i, ch in enumerate(schema):
        depth += (ch in "<(") - (ch in ">)")
        if ch == "," and depth == 0:
            out.append(schema[start:i].strip())
            start = i + 1
    return [*out, schema[start:].strip()]
