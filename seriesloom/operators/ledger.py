"""Run ledger: what was trained, how it went, what mattered."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

LEDGER = (
    "job_id string, model string, status string, seconds double, message string,"
    " aic double, bic double"
)


def run_summary(runs: DataFrame) -> DataFrame:
    """Per job: totals, progress in percent, seconds and the overall status."""
    def is_(s: str) -> Column:
        return F.col("status") == s

    done = F.count_if(is_("success") | is_("failed"))
    total = F.count(F.lit(1))
    return runs.groupBy("job_id").agg(
        total.alias("total"),
        F.count_if(is_("success")).alias("successful"),
        F.count_if(is_("failed")).alias("failed"),
        (F.try_divide(done, total) * 100).alias("progress"),
        F.sum(F.coalesce("seconds", F.lit(0.0))).alias("total_seconds"),
        F.when(done == total, "completed").otherwise("running").alias("status"),
    )


def training_summary(
    runs: DataFrame, importances: DataFrame, top: int = 5
) -> DataFrame:
    """Score columns of each trained model with its strongest features, strongest first."""
    w = Window.partitionBy("model").orderBy(F.col("importance").desc(), "feature")
    best = (
        importances.withColumn("rank", F.row_number().over(w))
        .where(F.col("rank") <= top)
        .groupBy("model")
        .agg(
            F.array_sort(F.collect_list(F.struct("rank", "feature", "importance"))).alias(
                "top_features"
            )
        )
    )
    return runs.join(best, "model", "left")
