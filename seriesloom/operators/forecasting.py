"""Train and forecast several model families, with a run ledger."""

from __future__ import annotations

import time
from collections.abc import Callable, Mapping, Sequence
from dataclasses import replace
from datetime import date

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from seriesloom.operators.additive import AdditiveConfig, additive_fit, additive_forecast
from seriesloom.operators.arima import arima_fit, arima_forecast
from seriesloom.operators.calendars import future_calendar
from seriesloom.operators.filters import between_ts
from seriesloom.operators.ledger import LEDGER
from seriesloom.operators.metrics import forecast_metrics
from seriesloom.operators.sequences import flat_sequences, sequences
from seriesloom.operators.trees import gbt_fit, last_windows, recursive_forecast
from seriesloom.plans.layout import Layout
from seriesloom.session import cut_lineage

Forecaster = Callable[[DataFrame, int, Layout], DataFrame]


def arima_model(order=(1, 1, 1)) -> Forecaster:
    def run(df: DataFrame, steps: int, layout: Layout) -> DataFrame:
        fit = arima_fit(df, order, layout=layout)
        path = arima_forecast(fit, steps, key=layout.key)
        return path.join(fit.select(layout.key, "aic", "bic"), layout.key)

    return run


def naive_model() -> Forecaster:
    """The last value repeated."""
    def run(df: DataFrame, steps: int, layout: Layout) -> DataFrame:
        known = df.where(F.col("close").isNotNull())
        last = known.groupBy(layout.key).agg(
            F.max_by("close", layout.ts).cast("double").alias("yhat"), F.max(layout.ts).alias("__d")
        )
        ahead = future_calendar(last.select(layout.key, F.col("__d").alias("d")), steps, "D", layout.key)
        blank = F.lit(None).cast("double")
        return ahead.join(last.drop("__d"), layout.key).select(
            layout.key, F.lit("naive").alias("model"), "step", "d", "yhat",
            blank.alias("lower"), blank.alias("upper"),
        )

    return run


def additive_model(cfg: AdditiveConfig = AdditiveConfig()) -> Forecaster:
    def run(df: DataFrame, steps: int, layout: Layout) -> DataFrame:
        fit = additive_fit(df, cfg, layout=layout)
        return additive_forecast(fit, steps, cfg=cfg, key=layout.key)

    return run


def tree_model(length: int = 5, rounds: int = 50, depth: int = 5) -> Forecaster:
    """Boosted trees on the last values of a series, fed back step by step."""
    def run(df: DataFrame, steps: int, layout: Layout) -> DataFrame:
        flat = flat_sequences(sequences(df, ["close"], "close", length, layout), length)
        cols = [f"x{i + 1}" for i in range(length)]
        model = gbt_fit(flat.dropna(), cols, "y", key=layout.key, rounds=rounds, depth=depth)
        state = last_windows(df, length, "close", layout)
        path = recursive_forecast(model, state, length, steps, layout.key)
        blank = F.lit(None).cast("double")
        return path.select(
            layout.key,
            F.lit("trees").alias("model"),
            "step",
            F.date_add(F.col("last_d").cast("date"), F.col("step")).alias("d"),
            "yhat",
            blank.alias("lower"),
            blank.alias("upper"),
        )

    return run


def default_models() -> dict[str, Forecaster]:
    return {"arima": arima_model(), "additive": additive_model(), "trees": tree_model()}


def forecast_all(
    df: DataFrame,
    steps: int = 30,
    models: Mapping[str, Forecaster] | None = None,
    layout: Layout = Layout(),
    *,
    start: str | None = None,
    end: str | None = None,
    job_id: str = "job",
) -> tuple[DataFrame, DataFrame]:
    """Forecasts of every model that works, and one ledger row per model.

    The requested date range applies to every model. A model that fails leaves a
    ledger row with its message and does not stop the others. Where a family has AIC and
    BIC per series, the ledger holds their means.
    """
    train = between_ts(df, start, end, layout.ts)
    if train.isEmpty():
        raise ValueError("no data available for the specified date range")
    tables, runs = [], []
    for name, forecast in (models or default_models()).items():
        began = time.monotonic()
        try:
            table = forecast(train, steps, layout).withColumn("model", F.lit(name))
            # Computed here: a plan that failed later could not be skipped any more.
            table = cut_lineage(table)
            scores = _ledger_scores(table, layout.key)
            tables.append(table.drop("aic", "bic"))
            status, message = "success", f"{name} trained"
        except Exception as e:  # one model's failure is data for the ledger
            status, message, scores = "failed", f"{type(e).__name__}: {e}", (None, None)
        runs.append((job_id, name, status, time.monotonic() - began, message, *scores))
    ledger = df.sparkSession.createDataFrame(runs, LEDGER)
    if not tables:
        raise ValueError(f"every model failed: {[r[4] for r in runs]}")
    out = tables[0]
    for t in tables[1:]:
        out = out.unionByName(t)
    return out, ledger


def _ledger_scores(table: DataFrame, key: str) -> tuple[float | None, float | None]:
    if not {"aic", "bic"} <= set(table.columns):
        return None, None
    each = table.groupBy(key).agg(F.first("aic").alias("aic"), F.first("bic").alias("bic"))
    return tuple(each.agg(F.avg("aic"), F.avg("bic")).first())


def rolling_origin(
    df: DataFrame,
    cuts: Sequence[str],
    steps: int = 30,
    models: Mapping[str, Forecaster] | None = None,
    layout: Layout = Layout(),
    value: str = "close",
) -> DataFrame:
    """Held-out forecasts: each model trained on the rows before each cut date.

    Step n meets the n-th row from the cut on, ``y``; steps beyond the last row are dropped. A
    (series, cut) pair is a series of its own, so each family is fitted in one pass whatever
    the number of cuts. A series without rows before a cut has no forecasts there.
    """
    cuts = [date.fromisoformat(c).isoformat() for c in cuts]
    at = F.lit("@")
    run = F.concat(F.col(layout.key).cast("string"), at, F.col("cut"))
    copies = df.withColumn("cut", F.explode(F.array(*(F.lit(c) for c in cuts))))
    known = F.col(layout.ts) < F.col("cut").cast("date")
    train = copies.where(known).withColumn("__run", run).drop("cut", layout.key)
    w = Window.partitionBy("__run").orderBy("d")
    # The limit per run is applied before the shuffle.
    actual = (
        copies.where(~known & F.col(value).isNotNull())
        .select(layout.key, "cut", run.alias("__run"), F.col(layout.ts).alias("d"),
                F.col(value).cast("double").alias("y"))
        .withColumn("step", F.row_number().over(w))
        .where(F.col("step") <= steps)
        .select(layout.key, "cut", "__run", "step", "d", "y")
    )
    own = replace(layout, key="__run")
    out = None
    for name, forecast in (models or default_models()).items():
        table = cut_lineage(forecast(train, steps, own)).select(
            "__run", F.lit(name).alias("model"), "step", "yhat", "lower", "upper"
        )
        out = table if out is None else out.unionByName(table)
    return actual.join(out, ["__run", "step"]).drop("__run")


def backtest(df: DataFrame, cuts: Sequence[str], *args, by_cut: bool = False, **kw) -> DataFrame:
    """MAE, MSE, RMSE and MAPE of ``rolling_origin`` by series and model, over all cuts or each."""
    layout = kw.get("layout") or (args[2] if len(args) > 2 else Layout())
    held_out = rolling_origin(df, cuts, *args, **kw)
    by = [layout.key, "model", *(["cut"] if by_cut else [])]
    return forecast_metrics(held_out, "y", "yhat", by)
