"""Tree ensembles: boosted regression, forest classification, scoring, recursion."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.ml import Model, Pipeline, PipelineModel
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from seriesloom.operators.boosting import Boosted, boost_fit
from seriesloom.operators.filters import cast_features
from seriesloom.plans.layout import Layout
from seriesloom.session import cut_lineage


def gbt_fit(
    df: DataFrame,
    cols: Sequence[str],
    target: str = "label",
    *,
    key: str = "ticker",
    rounds: int = 50,
    depth: int = 5,
    **kw,
) -> Boosted:
    """Boosted regression trees of each series, squared error; see ``boosting``."""
    return boost_fit(df, cols, target, key=key, rounds=rounds, depth=depth, **kw)


def gbt_score(model: Boosted, df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Add ``yhat`` to a feature table."""
    return model.transform(cast_features(df, cols))


def feature_importance(
    model: Boosted, cols: Sequence[str], top: int | None = None
) -> DataFrame:
    """``feature, importance`` of each series, sorted descending; all ``cols`` or the top ones."""
    found = model.importances(top)
    return found.where(F.col("feature").isin(list(cols)))


def _ready(df: DataFrame, cols: Sequence[str], label: str) -> DataFrame:
    """Features and label as doubles, stored: folds, forests and scores read them many times."""
    return cut_lineage(cast_features(df.select(*cols, label), [*cols, label]))


def rf_cv(
    df: DataFrame,
    cols: Sequence[str],
    label: str,
    *,
    trees: int = 100,
    folds: int = 5,
    seed: int = 42,
    by_label: float | None = 1.0,
) -> DataFrame:
    """Mean F1 of a random forest over cross-validation folds.

    F1 of class ``by_label``; with None the class-weighted mean.
    """
    forest = RandomForestClassifier(
        featuresCol="features", labelCol=label, numTrees=trees, seed=seed
    )
    metric = MulticlassClassificationEvaluator(labelCol=label, metricName="f1")
    if by_label is not None:
        metric = metric.setMetricName("fMeasureByLabel").setMetricLabel(by_label)
    stages = [VectorAssembler(inputCols=list(cols), outputCol="features"), forest]
    # The folds of CrossValidator, without its last fit on all rows, whose model has no use here.
    ready = _ready(df, cols, label).withColumn("__fold", F.rand(seed))
    scores, h = [], 1.0 / folds
    for k in range(folds):
        held = (F.col("__fold") >= k * h) & (F.col("__fold") < (k + 1) * h)
        train, test = ready.where(~held).cache(), ready.where(held).cache()
        scores.append(metric.evaluate(Pipeline(stages=stages).fit(train).transform(test)))
        train.unpersist()
        test.unpersist()
    return df.sparkSession.createDataFrame(
        [(trees, folds, float(np.mean(scores)))], "trees int, folds int, f1 double"
    )


def rf_fit(
    df: DataFrame, cols: Sequence[str], label: str, *, trees: int = 100, seed: int = 42
) -> PipelineModel:
    stages = [
        VectorAssembler(inputCols=list(cols), outputCol="features"),
        RandomForestClassifier(
            featuresCol="features", labelCol=label, numTrees=trees, seed=seed
        ),
    ]
    return Pipeline(stages=stages).fit(_ready(df, cols, label))


def rf_score(path: str, df: DataFrame, cols: Sequence[str], keep: Sequence[str]) -> DataFrame:
    """Probability of class 1 from a saved model."""
    model = PipelineModel.load(path)
    scored = model.transform(cast_features(df.select(*{*cols, *keep}), cols))
    return scored.select(
        *keep, F.get(vector_to_array("probability"), F.lit(1)).alias("probability")
    )


def last_windows(df: DataFrame, length: int, value: str, layout: Layout = Layout()) -> DataFrame:
    """The last ``length`` values of each series as ``x1..xL`` (oldest first).

    A limit per series runs before the shuffle, so long series are not moved.
    """
    w = Window.partitionBy(layout.key).orderBy(F.col(layout.ts).desc())
    near = df.select(
        layout.key, layout.ts, F.col(value).cast("double").alias("__v"),
        F.row_number().over(w).alias("__rn"),
    ).where(F.col("__rn") <= length)
    cols = [
        F.max(F.when(F.col("__rn") == length - i, F.col("__v"))).alias(f"x{i + 1}")
        for i in range(length)
    ]
    return near.groupBy(layout.key).agg(
        F.max(layout.ts).alias("last_d"), F.count(F.lit(1)).alias("__n"), *cols
    ).where(F.col("__n") == length).drop("__n")


def recursive_forecast(
    model: Boosted | Model,
    state: DataFrame,
    length: int,
    steps: int = 30,
    key: str = "ticker",
    *,
    checkpoint_every: int = 8,
) -> DataFrame:
    """Feed each prediction back as the newest value, all series stepping together.

    ``state`` has ``x1..xL`` per series. Boosted trees of a series roll forward in one task.
    With another model the plan grows by one scoring per step, so it is cut at intervals by
    a reliable checkpoint.
    """
    names = [f"x{i + 1}" for i in range(length)]
    if isinstance(model, Boosted):
        return model.roll(state, names, steps)
    rest = [c for c in state.columns if c not in names]
    now = state.withColumn("__path", F.array().cast("array<double>"))
    for step in range(1, steps + 1):
        scored = model.transform(now)
        now = scored.select(
            *rest,
            *(F.col(b).alias(a) for a, b in zip(names, names[1:])),
            F.col("yhat").alias(names[-1]),
            F.concat("__path", F.array("yhat")).alias("__path"),
        )
        if step % checkpoint_every == 0 and step < steps:
            now = cut_lineage(now)
    return now.select(*rest, F.posexplode("__path").alias("i", "yhat")).select(
        *rest, (F.col("i") + 1).alias("step"), "yhat"
    )


def next_step(model: Boosted | Model, state: DataFrame, length: int) -> DataFrame:
    return recursive_forecast(model, state, length, steps=1)


def recursive_linear(
    state: DataFrame, coefs: Column, intercept: Column, length: int, steps: int = 30
) -> DataFrame:
    """The same recursion for a linear model, folded inside one expression.

    ``coefs`` is an array Column, oldest value first.
    """
    names = [f"x{i + 1}" for i in range(length)]
    rest = [c for c in state.columns if c not in names]
    start = F.struct(
        F.array(*names).alias("w"), F.array().cast("array<double>").alias("p")
    )

    def step(acc: Column, _: Column) -> Column:
        terms = F.zip_with(acc["w"], coefs, lambda a, b: a * b)
        y = F.aggregate(terms, F.lit(0.0), lambda s, v: s + v) + intercept
        return F.struct(
            F.concat(F.slice(acc["w"], 2, length - 1), F.array(y)).alias("w"),
            F.concat(acc["p"], F.array(y)).alias("p"),
        )

    path = F.aggregate(F.sequence(F.lit(1), F.lit(steps)), start, step)["p"]
    return state.select(*rest, F.posexplode(path).alias("i", "yhat")).select(
        *rest, (F.col("i") + 1).alias("step"), "yhat"
    )
