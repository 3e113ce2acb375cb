import os
import sys

import numpy as np
import pandas as pd
import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

from pyspark.sql import SparkSession  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def make(spark):
    """Series table from {ticker: values}; NaN becomes null."""

    def build(series, start="2020-01-01"):
        rows = []
        for ticker, values in series.items():
            days = pd.date_range(start, periods=len(values), freq="D")
            rows += [
                (ticker, d.date(), None if v is None or np.isnan(v) else float(v))
                for d, v in zip(days, values)
            ]
        return spark.createDataFrame(rows, "ticker string, d date, close double")

    return build


@pytest.fixture(scope="session")
def pdf():
    """Collect to pandas ordered by series and day."""

    def collect(df, by=("ticker", "d")):
        return df.toPandas().sort_values(list(by)).reset_index(drop=True)

    return collect
