"""Wall seconds of the headline queries; prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) and BENCH_CPUS (default 8) choose the
input and the threads. Each query runs twice and the second run counts; every
column of every row is computed (noop sink). BENCH_DUCKDB=1 adds DuckDB's seconds
for the same queries.
"""

from __future__ import annotations

import json
import os
import sys
import time

from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "ohlcv_bars",
    "monthly_returns",
    "lags",
    "ma_partial",
    "roll_skew",
    "roll_quantiles",
    "rsi",
    "macd",
    "full_features",
    "full_features_plain",
    "full_features_nations",
    "full_features_one_series",
    "calendar_features",
    "event_flags",
    "leakage_corr",
    "ml_dataset",
    "sequence_dataset",
    "minmax_scale",
    "decompose_seasonal",
    "acf",
    "forecast_metrics",
    "describe",
    "dedupe_key",
    "derived_ratio",
    "adf_test",
    "arima_fit",
    "additive_fit",
]


def duckdb_seconds(sf_dir: str, names: list[str], cpus: int) -> dict[str, float]:
    import duckdb

    from seriesloom.catalog import ORACLES

    con = duckdb.connect()
    con.execute(f"SET threads={cpus}")
    for f in os.listdir(sf_dir):
        if f.endswith(".parquet"):
            con.execute(f"CREATE VIEW {f[:-8]} AS SELECT * FROM '{sf_dir}/{f}'")
    out = {}
    for name in names:
        if name in ORACLES:
            start = time.perf_counter()
            con.execute(ORACLES[name]).fetchall()
            out[name] = round(time.perf_counter() - start, 3)
    return out


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.sql.shuffle.partitions", str(cpus))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "16g"))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    from seriesloom.catalog import QUERIES

    seconds = {}
    for name in os.environ.get("BENCH_QUERIES", " ".join(HEADLINE)).split():
        for _ in range(2):
            start = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            seconds[name] = round(time.perf_counter() - start, 3)
    result = {
        "metric": "headline_queries_total",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": sf_dir.rstrip("/").rsplit("sf", 1)[-1],
    }
    if os.environ.get("BENCH_DUCKDB"):
        result["duckdb"] = duckdb_seconds(sf_dir, list(seconds), cpus)
    print(json.dumps(result))
    spark.stop()


if __name__ == "__main__":
    main()
