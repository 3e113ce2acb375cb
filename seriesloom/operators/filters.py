"""Date filters, chronological splits, complete cases and column selection."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from seriesloom.plans.groupstats import attach
from seriesloom.plans.layout import POS, Layout, with_positions


def instant(df: DataFrame, ts: str, literal: str, zone: str | None = None) -> Column:
    """A date string as a value comparable with column ``ts``; a bare date is midnight.

    ``zone`` is the local zone of the string, used when the column is an instant.
    """
    kind = df.schema[ts].dataType
    if isinstance(kind, T.TimestampNTZType):
        return F.to_timestamp_ntz(F.lit(literal))
    stamp = F.to_timestamp(F.lit(literal))
    if zone is not None:
        stamp = F.to_utc_timestamp(stamp, zone)
    return stamp.cast("date") if isinstance(kind, T.DateType) else stamp


def between_ts(
    df: DataFrame,
    start: str | None,
    end: str | None,
    ts: str = "d",
    zone: str | None = None,
) -> DataFrame:
    """Rows with ``start <= ts <= end``; both bounds are instants and both are kept."""
    if start is not None:
        df = df.where(F.col(ts) >= instant(df, ts, start, zone))
    if end is not None:
        df = df.where(F.col(ts) <= instant(df, ts, end, zone))
    return df


def day_slice(
    df: DataFrame, start: str | None = None, end: str | None = None, ts: str = "d"
) -> DataFrame:
    """Rows of the days ``start`` to ``end``, both days in full; either side may be open."""
    if start is not None:
        df = df.where(F.col(ts) >= F.lit(start).cast("date"))
    if end is not None:
        df = df.where(F.col(ts) < F.date_add(F.lit(end).cast("date"), 1))
    return df


def split_dates(
    df: DataFrame,
    train_start: str,
    train_end: str,
    test_start: str | None = None,
    ts: str = "d",
) -> DataFrame:
    """Label rows ``train`` or ``test`` in column ``split``; one row may be in both.

    Bounds are inclusive; rows in neither part are dropped. The row is scanned
    once and emitted once per part it belongs to.
    """
    t = F.col(ts)
    in_train = (t >= instant(df, ts, train_start)) & (t <= instant(df, ts, train_end))
    in_test = t >= instant(df, ts, test_start) if test_start else F.lit(False)
    parts = F.filter(
        F.array(F.when(in_train, F.lit("train")), F.when(in_test, F.lit("test"))),
        lambda p: p.isNotNull(),
    )
    return df.where(in_train | in_test).withColumn("split", F.explode(parts))


def series_length(df: DataFrame, key: str = "ticker") -> DataFrame:
    return df.groupBy(key).agg(F.count(F.lit(1)).alias("__n"))


def split_ratio(
    df: DataFrame, ratio: float = 0.8, layout: Layout = Layout()
) -> DataFrame:
    """First ``floor(n * ratio)`` rows of each series are ``train``, the rest ``test``."""
    placed = attach(
        with_positions(df, layout),
        series_length(df, layout.key),
        [layout.key],
    )
    is_train = F.col(POS) < F.floor(F.col("__n") * F.lit(ratio))
    return placed.withColumn(
        "split", F.when(is_train, "train").otherwise("test")
    ).drop(POS, "__n")


def complete_cases(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Drop rows with a null or NaN in any of ``cols``.

    One predicate per column instead of one over all of them, which the optimizer would
    rewrite in 2**k ways through k computed columns as soon as a filter stands above it.
    """
    floats = {f.name for f in df.schema if isinstance(f.dataType, (T.DoubleType, T.FloatType))}
    present = F.lit(True)
    for c in cols:
        present = present & F.col(c).isNotNull()
        if c in floats:
            present = present & ~F.isnan(c)
    return df.where(present)


def warmup_trim(
    df: DataFrame, k: int, cols: Sequence[str], layout: Layout = Layout()
) -> DataFrame:
    """Drop the first k rows of each series that has a null anywhere in ``cols``.

    ``df`` may already carry positions (``__pos``); they are used and dropped.
    """
    placed = df if POS in df.columns else with_positions(df, layout)
    any_null = F.lit(False)
    for c in cols:
        any_null = any_null | F.col(c).isNull()
    nulls = placed.groupBy(layout.key).agg(F.max(any_null).alias("__nulls"))
    flagged = attach(placed, nulls, [layout.key])
    keep = (F.col(POS) >= k) | ~F.col("__nulls")
    return flagged.where(keep).drop(POS, "__nulls")


def features_target(
    df: DataFrame,
    target: str = "target",
    exclude: Sequence[str] = ("target", "target_diff"),
    index: Sequence[str] = ("ticker", "d"),
) -> DataFrame:
    """Index columns, every feature column, and the target as ``label``."""
    skip = {*exclude, target, *index}
    features = [c for c in df.columns if c not in skip]
    return df.select(*index, *features, F.col(target).alias("label"))


def cast_features(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("double") for c in cols})


def to_day(df: DataFrame, ts: str, value: str, name: str) -> DataFrame:
    """Series key, calendar day and one renamed value column."""
    return df.select(
        "ticker", F.col(ts).cast("date").alias("d"), F.col(value).alias(name)
    )


def drop_duplicate_columns(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """Drop columns equal to an earlier column in every row.

    Flags, integers and floats compare by value. Which columns go depends on the
    data, so two aggregates run first: one order-free fingerprint per column, then
    a row-by-row check of the pairs whose fingerprints agree.
    """
    comparable = [
        f.name
        for f in df.schema
        if f.name not in key and isinstance(f.dataType, (T.NumericType, T.BooleanType))
    ]
    if len(comparable) < 2:
        return df

    def number(c: str) -> Column:
        return F.col(c).cast("int" if dict(df.dtypes)[c] == "boolean" else "double").cast(
            "double"
        )

    prints = df.agg(
        *(
            F.bit_xor(F.xxhash64(*key, F.coalesce(number(c), F.lit(float("nan"))))).alias(c)
            for c in comparable
        )
    ).first()
    pairs = [
        (a, b)
        for i, b in enumerate(comparable)
        for a in comparable[:i]
        if prints[a] == prints[b]
    ]
    if not pairs:
        return df
    same = df.agg(
        *(
            F.bool_and(number(a).eqNullSafe(number(b))).alias(f"p{i}")
            for i, (a, b) in enumerate(pairs)
        )
    ).first()
    gone = {b for i, (_, b) in enumerate(pairs) if same[f"p{i}"]}
    return df.drop(*gone)


def window_predictions(
    forecasts: DataFrame, start: str, end: str, steps: int, layout: Layout = Layout()
) -> DataFrame:
    """Predictions inside the requested window, the first ``steps`` of each series."""
    inside = between_ts(forecasts, start, end, layout.ts)
    return with_positions(inside, layout).where(F.col(POS) < steps).drop(POS)


def top_rows(
    df: DataFrame, order: Sequence[Column], k: int, by: Sequence[str] | None = None
) -> DataFrame:
    """First k rows overall, or of each group; a limit is applied before the shuffle."""
    if by is None:
        return df.orderBy(*order).limit(k)
    w = Window.partitionBy(*by).orderBy(*order)
    return df.withColumn("__rn", F.row_number().over(w)).where(F.col("__rn") <= k).drop(
        "__rn"
    )
