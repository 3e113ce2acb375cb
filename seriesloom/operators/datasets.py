"""Model-ready tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seriesloom.operators.features import (
    FeatureConfig,
    build_features,
    feature_names,
)
from seriesloom.operators.filters import between_ts, complete_cases, split_dates
from seriesloom.operators.joins import Event, event_flags
from seriesloom.operators.sequences import sequence_dataset
from seriesloom.operators.stationarity import stationarize
from seriesloom.plans.layout import Layout

MODEL_TYPES = ("arima", "prophet", "ml", "lstm", "sarimax")


def additive_input(
    df: DataFrame,
    events: Sequence[Event] = (),
    value: str = "close",
    layout: Layout = Layout(),
) -> DataFrame:
    """``ds`` (no zone), ``y`` and one flag per event."""
    base = df.select(
        layout.key, F.col(layout.ts).cast("timestamp_ntz").alias("ds"), F.col(value).alias("y")
    )
    return event_flags(base, events, "ds", per_event=True) if events else base


def ml_dataset(
    df: DataFrame,
    train_start: str = "2021-01-01",
    train_end: str = "2023-12-31",
    test_start: str | None = "2024-01-01",
    target: str = "level",
    cfg: FeatureConfig = FeatureConfig(),
    value: str = "close",
    layout: Layout = Layout(),
) -> DataFrame:
    """Features, ``label`` and ``split``, complete rows only.

    ``target``: ``level`` (the value itself), ``diff`` (its first difference) or
    ``h<k>`` (the value k rows ahead).
    """
    if target.startswith("h") and target[1:].isdigit():
        h = int(target[1:])
        feats = build_features(df, cfg, value, layout, target_diff=False, ahead=h)
        rows = feats.withColumn("label", F.col(f"target_{h}"))
    elif target in ("level", "diff"):
        feats = build_features(df, cfg, value, layout, target_diff=target == "diff")
        source = "target" if target == "level" else "target_diff"
        rows = feats.withColumn("label", F.col(source))
    else:
        raise ValueError(f"unknown target: {target}")
    names = feature_names(cfg)
    kept = complete_cases(rows, [*names, "label"])
    parts = split_dates(kept, train_start, train_end, test_start, layout.ts)
    return parts.select(layout.key, layout.ts, *names, "label", "split")


def arima_input(
    df: DataFrame,
    start: str = "2000-01-01",
    value: str = "close",
    layout: Layout = Layout(),
) -> DataFrame:
    """Rows from ``start``, differenced once where the series is not stationary."""
    return stationarize(between_ts(df, start, None, layout.ts), value=value, layout=layout)


def prepare(
    df: DataFrame, model_type: str, *, value: str = "close", layout: Layout = Layout(), **kw
) -> DataFrame:
    """Input table of a model family."""
    if value not in df.columns:
        value = next(c for c in df.columns if c not in (layout.key, layout.ts))
    if model_type == "arima":
        return arima_input(df, value=value, layout=layout, **kw)
    if model_type == "prophet":
        return additive_input(df, value=value, layout=layout, **kw)
    if model_type == "ml":
        return ml_dataset(df, value=value, layout=layout, **kw)
    if model_type == "lstm":
        return sequence_dataset(df, target=value, layout=layout, **kw)
    if model_type == "sarimax":
        events = kw.get("events", ())
        base = df.select(layout.key, layout.ts, value)
        return event_flags(base, events, layout.ts, per_event=True) if events else base
    raise ValueError(f"unknown model type: {model_type}; expected one of {MODEL_TYPES}")
