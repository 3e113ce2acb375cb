"""Pick the newest stored object, by prefix or suffix."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def list_files(spark: SparkSession, path: str) -> DataFrame:
    """``key, modified`` of every file below ``path``; contents are not read."""
    return (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .load(path)
        .select(F.col("path").alias("key"), F.col("modificationTime").alias("modified"))
    )


def latest_snapshot(
    files: DataFrame,
    prefix: str = "",
    ticker: str | None = None,
    suffix: str | None = None,
    by: list[str] | None = None,
) -> DataFrame:
    """Newest object under a prefix, one row per group of ``by``.

    With ``ticker``, objects named ``<prefix><ticker>_...`` are preferred and any
    other object under the prefix is the fallback. Of equally new objects the
    first in key order wins. One aggregate, combined before the shuffle.
    """
    found = files.where(F.col("key").startswith(prefix))
    if suffix is not None:
        found = found.where(F.col("key").endswith(suffix))
    # Newest first, then smallest key, as the minimum of one orderable struct.
    rank = F.struct(
        (-F.unix_micros(F.col("modified").cast("timestamp"))).alias("age"),
        F.col("key"),
        F.col("modified"),
    )
    any_best = F.min(rank).alias("__any")
    if ticker is None:
        picked = found.groupBy(*(by or [])).agg(any_best).withColumn("__b", F.col("__any"))
    else:
        preferred = F.col("key").startswith(f"{prefix}{ticker.lower()}_")
        picked = (
            found.groupBy(*(by or []))
            .agg(any_best, F.min(F.when(preferred, rank)).alias("__own"))
            .withColumn("__b", F.coalesce("__own", "__any"))
        )
    return picked.where(F.col("__b").isNotNull()).select(
        *(by or []),
        F.col("__b.key").alias("key"),
        F.col("__b.modified").alias("modified"),
    )


def resolve_latest(
    spark: SparkSession, path: str, ticker: str | None = None, suffix: str | None = None
) -> str:
    """Path of the newest file under a folder; an empty folder is an error."""
    files = list_files(spark, path)
    if ticker is not None:
        name = F.element_at(F.split("key", "/"), -1)
        own = files.where(name.startswith(f"{ticker.lower()}_"))
        row = latest_snapshot(own, suffix=suffix).first()
        if row is not None:
            return row["key"]
    row = latest_snapshot(files, suffix=suffix).first()
    if row is None:
        raise FileNotFoundError(f"no objects found under {path}")
    return row["key"]
