"""Session settings the operators rely on."""

from __future__ import annotations

import atexit
import shutil
import tempfile

from pyspark.sql import DataFrame, SparkSession


def prepare_session(spark: SparkSession) -> SparkSession:
    """Pin the zone to UTC; the rest of the configuration belongs to the cluster."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Use the checkpoint folder the cluster names; fall back only when unset (tests)."""
    current = spark.sparkContext.getCheckpointDir()
    if current:
        return current
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        master = spark.sparkContext.master
        if not master.startswith("local"):
            raise ValueError(
                "spark.checkpoint.dir must name a shared folder on a cluster"
            )
        named = tempfile.mkdtemp(prefix="seriesloom-ckpt-")
        atexit.register(shutil.rmtree, named, ignore_errors=True)
    spark.sparkContext.setCheckpointDir(named)
    return named


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint: survives the loss of executors."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)
