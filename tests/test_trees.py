import pytest
from pyspark.ml import Pipeline
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
from pyspark.sql import functions as F

from seriesloom.operators import trees


@pytest.fixture
def rows(spark):
    df = spark.range(400, numPartitions=3)
    a = F.pmod(F.hash("id"), F.lit(100)).alias("a")
    b = F.pmod(F.hash("id", F.lit(1)), F.lit(100)).alias("b")
    label = F.when(F.pmod(F.hash("id", F.lit(2)), F.lit(150)) < F.pmod(F.hash("id"), F.lit(100)), 1).otherwise(0)
    return df.select(a, b, label.alias("label"))


def test_cross_validation_reads_its_input_once(spark, rows):
    seen = spark.sparkContext.accumulator(0)

    def look(x):
        seen.add(1)
        return x

    counted = rows.withColumn("a", F.udf(look, "int")("a"))
    trees.rf_cv(counted, ["a", "b"], "label", trees=3, folds=3).collect()
    assert seen.value == 400
    trees.rf_fit(counted, ["a", "b"], "label", trees=3)
    assert seen.value == 800


@pytest.mark.parametrize("by_label", [1.0, None])
def test_cross_validation_equals_that_of_spark(rows, by_label):
    metric = MulticlassClassificationEvaluator(labelCol="label", metricName="f1")
    if by_label is not None:
        metric = metric.setMetricName("fMeasureByLabel").setMetricLabel(by_label)
    forest = RandomForestClassifier(featuresCol="features", labelCol="label", numTrees=5, seed=7)
    stages = [VectorAssembler(inputCols=["a", "b"], outputCol="features"), forest]
    cv = CrossValidator(
        estimator=Pipeline(stages=stages), estimatorParamMaps=ParamGridBuilder().build(),
        evaluator=metric, numFolds=4, seed=7,
    )
    want = cv.fit(rows.select(*(F.col(c).cast("double").alias(c) for c in rows.columns))).avgMetrics[0]
    got = trees.rf_cv(rows, ["a", "b"], "label", trees=5, folds=4, seed=7, by_label=by_label).first()
    assert (got.trees, got.folds, got.f1) == (5, 4, pytest.approx(want, abs=1e-12))
