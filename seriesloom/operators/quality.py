"""Spans, null counts, leakage checks and training-data checks."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from seriesloom.plans.layout import BUCKET, POS, Layout, bucket_rows, with_positions


def unpivot_row(df: DataFrame, by: Sequence[str], values: dict[str, Column], name: str, value: str) -> DataFrame:
    """Turn the columns of a small aggregate into rows."""
    entries = F.array(
        *(
            F.struct(F.lit(n).alias("k"), v.alias("v"))
            for n, v in values.items()
        )
    )
    return df.select(*by, F.explode(entries).alias("e")).select(
        *by, F.col("e.k").alias(name), F.col("e.v").alias(value)
    )


def series_span(df: DataFrame, key: str = "ticker", ts: str = "d") -> DataFrame:
    return df.groupBy(key).agg(
        F.min(ts).alias("first_d"),
        F.max(ts).alias("last_d"),
        F.count(F.lit(1)).alias("n_rows"),
    )


def null_counts(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Nulls of every column in one pass, one row per column."""
    cols = list(cols or df.columns)
    one = df.agg(*(F.count_if(F.col(c).isNull()).alias(c) for c in cols))
    return unpivot_row(one, [], {c: F.col(c) for c in cols}, "column", "nulls")


def leakage_corr(
    features: DataFrame,
    cols: Sequence[str],
    target: str = "target",
    top: int | None = None,
    layout: Layout = Layout(),
    per_series: bool = False,
) -> DataFrame:
    """Correlation of each feature with the next row's target, strongest first.

    ``features`` may carry the next value already, as ``target_1``. Undefined correlations
    are dropped. Each task reduces all columns to six sums per series.
    """
    if f"{target}_1" in features.columns:
        ahead = features.withColumn("__next", F.col(f"{target}_1"))
    else:
        placed = features if POS in features.columns else with_positions(features, layout)
        laid = bucket_rows(placed, layout, ahead=1)
        ahead = laid.with_columns({"__next": F.lead(target, 1).over(laid.w)}).close()
    by = [layout.key] if per_series else []
    corr = correlations(ahead.where(F.col("__next").isNotNull()), cols, "__next", by)
    out = corr.withColumnRenamed("corr", "future_corr").where(F.col("future_corr").isNotNull())
    out = out.orderBy(F.abs("future_corr").desc(), "feature")
    return out if top is None else out.limit(top)


def _moments(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Per column of x: n, means of x and y, and centred sums xx, yy, xy over rows without NaN."""
    ok = ~(np.isnan(x) | np.isnan(y)[:, None])
    n = ok.sum(0)
    with np.errstate(invalid="ignore", divide="ignore"):
        mx = np.where(ok, x, 0).sum(0) / n
        my = (ok * np.where(np.isnan(y), 0, y)[:, None]).sum(0) / n
    dx, dy = np.where(ok, x - mx, 0), np.where(ok, y[:, None] - my, 0)
    return np.nan_to_num(np.stack([n, mx, my, (dx * dx).sum(0), (dy * dy).sum(0), (dx * dy).sum(0)]))


def _joined(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Moments of two sets of rows together."""
    n = a[0] + b[0]
    share = np.divide(b[0], n, out=np.zeros_like(n), where=n > 0)
    dx, dy, w = b[1] - a[1], b[2] - a[2], a[0] * share
    return np.stack([
        n, a[1] + dx * share, a[2] + dy * share,
        a[3] + b[3] + w * dx * dx, a[4] + b[4] + w * dy * dy, a[5] + b[5] + w * dx * dy,
    ])


def correlations(df: DataFrame, cols: Sequence[str], with_: str, by: Sequence[str] = ()) -> DataFrame:
    """``by, feature, corr`` of each column with ``with_``, null where one of them is constant.

    Pairs with a null or NaN are left out, each column's own.
    """
    cols, by = list(cols), list(by)
    group = by[0] if by else "__all"
    slim = df.select(
        *(F.col(c) for c in by), *([] if by else [F.lit(0).alias(group)]),
        F.array(*(F.col(c).cast("double") for c in [*cols, with_])).alias("__x"),
    )
    kind = slim.schema[group].dataType.simpleString()

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict = {}
        for batch in batches:
            x = pc.list_flatten(batch.column("__x")).to_numpy(False).reshape(batch.num_rows, -1)
            names = batch.column(group).dictionary_encode()
            codes = names.indices.fill_null(-1).to_numpy(False)
            for code in np.unique(codes).tolist():
                name = None if code < 0 else names.dictionary[code].as_py()
                own = x[codes == code]
                found = _moments(own[:, :-1], own[:, -1])
                held[name] = _joined(held[name], found) if name in held else found
            if len(held) * len(cols) > 1 << 20:
                yield from out(held, batch.schema.field(group).type)
                held = {}
        if held:
            yield from out(held, batch.schema.field(group).type)

    def out(held: dict, type_: pa.DataType) -> Iterator[pa.RecordBatch]:
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(held), type_), pa.array([v.ravel() for v in held.values()], pa.list_(pa.float64()))], [group, "m"]
        )

    def finish(table: pa.Table) -> pa.Table:
        total = np.zeros((6, len(cols)))
        for m in table.column("m").to_pylist():
            total = _joined(total, np.array(m).reshape(6, -1))
        n, _, _, xx, yy, xy = total
        flat = (xx <= 1e-24 * np.maximum(total[1] ** 2 * n, 1e-300)) | (yy <= 1e-24 * np.maximum(total[2] ** 2 * n, 1e-300))
        with np.errstate(invalid="ignore", divide="ignore"):
            corr = np.where(flat, np.nan, xy / np.sqrt(xx * yy))
        first = table.column(group).combine_chunks().take(pa.array(np.zeros(len(cols), np.int64)))
        return pa.table({group: first, "feature": cols, "corr": pa.array(corr, from_pandas=True)})

    parts = slim.mapInArrow(partial, f"`{group}` {kind}, m array<double>")
    found = parts.groupBy(group).applyInArrow(finish, f"`{group}` {kind}, feature string, corr double")
    return found if by else found.drop(group)


def leakage_recheck(
    features: DataFrame,
    lags: Sequence[int],
    means: Sequence[int],
    target: str = "target",
    layout: Layout = Layout(),
    min_periods: int | None = 1,
    lag_tol: float = 1e-6,
    mean_tol: float = 1e-4,
) -> DataFrame:
    """Recompute every lag and mean another way and count the rows that disagree.

    The recomputation addresses rows by position value (RANGE frames over the row
    number), not by the ROWS frames the features were built with, so a misplaced
    row or halo shows up.
    """
    placed = (
        features if POS in features.columns else with_positions(features, layout)
    )
    laid = bucket_rows(placed, layout, back=max([*lags, *means]))
    w = Window.partitionBy(layout.key, BUCKET).orderBy(POS)
    again: dict[str, Column] = {}
    for k in lags:
        again[f"lag_{k}"] = F.max(target).over(w.rangeBetween(-k, -k))
    for n in means:
        f = w.rangeBetween(-n, -1)
        need = n if min_periods is None else min_periods
        again[f"ma_{n}"] = F.when(
            F.count(target).over(f) >= need,
            F.try_divide(F.sum(target).over(f), F.count(target).over(f)),
        )
    checked = laid.with_columns({f"__again_{c}": v for c, v in again.items()}).close()
    aggs = []
    for c in again:
        tol = lag_tol if c.startswith("lag_") else mean_tol
        one, other = F.col(c), F.col(f"__again_{c}")
        wrong = (one.isNull() != other.isNull()) | (
            F.coalesce(F.abs(one - other), F.lit(0.0)) >= tol
        )
        aggs.append(F.count_if(wrong).alias(c))
    counts = checked.agg(*aggs)
    return unpivot_row(counts, [], {c: F.col(c) for c in again}, "feature", "violations")


def training_checks(df: DataFrame, target: str, key: str = "ticker") -> DataFrame:
    """Per series: rows, usable targets, distinct targets (up to two) and the verdict.

    Only "fewer than two distinct values" matters, so minimum and maximum are
    compared instead of counting distinct values.
    """
    numeric = isinstance(df.schema[target].dataType, T.NumericType)
    x = F.col(target)
    stats = df.groupBy(key).agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count(x).alias("n_target"),
        F.coalesce(F.min(x) < F.max(x), F.lit(False)).alias("varies"),
    )
    status = (
        F.when(F.lit(not numeric), "target not numeric")
        .when(F.col("n_rows") == 0, "no rows")
        .when(F.col("n_target") == 0, "all targets null")
        .when(~F.col("varies"), "fewer than two values")
        .otherwise("ok")
    )
    return stats.withColumn("status", status)


def require_trainable(df: DataFrame, target: str, key: str = "ticker") -> DataFrame:
    """Raise when there is nothing to train on."""
    checks = training_checks(df, target, key)
    bad = checks.where(F.col("status") != "ok").select(key, "status").first()
    if bad is not None:
        raise ValueError(f"{bad[0]}: {bad[1]}")
    if checks.isEmpty():
        raise ValueError("no training data available")
    return df
