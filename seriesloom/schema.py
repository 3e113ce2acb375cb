"""Schemas of the tables the operators exchange."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import types as T

# One row per series and trading day.
BARS = T.StructType(
    [
        T.StructField("ticker", T.StringType()),
        T.StructField("d", T.DateType()),
        T.StructField("open", T.DoubleType()),
        T.StructField("high", T.DoubleType()),
        T.StructField("low", T.DoubleType()),
        T.StructField("close", T.DoubleType()),
        T.StructField("volume", T.LongType()),
    ]
)

# A saved price history; the time column is called Date.
PRICE_HISTORY = T.StructType(
    [
        T.StructField("Date", T.StringType()),
        T.StructField("Open", T.DoubleType()),
        T.StructField("High", T.DoubleType()),
        T.StructField("Low", T.DoubleType()),
        T.StructField("Close", T.DoubleType()),
        T.StructField("Volume", T.LongType()),
    ]
)

# A monthly price file.
MONTHLY_PRICES = T.StructType(
    [
        T.StructField("Date", T.StringType()),
        T.StructField("Price", T.DoubleType()),
    ]
)

# One row per series, model and forecast step.
FORECAST = T.StructType(
    [
        T.StructField("ticker", T.StringType()),
        T.StructField("model", T.StringType()),
        T.StructField("step", T.IntegerType()),
        T.StructField("d", T.DateType()),
        T.StructField("yhat", T.DoubleType()),
        T.StructField("lower", T.DoubleType()),
        T.StructField("upper", T.DoubleType()),
    ]
)


def require_columns(df: DataFrame, cols: Iterable[str]) -> DataFrame:
    missing = [c for c in cols if c not in df.columns]
    if missing:
        raise ValueError(f"missing columns {missing}; found {df.columns}")
    return df


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema if isinstance(f.dataType, T.NumericType)]
