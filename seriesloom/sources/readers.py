"""Load saved series."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, DataFrameReader, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from seriesloom.schema import MONTHLY_PRICES

# Schemes treated as object stores.
OBJECT_STORES = ("s3://", "s3a://")
# Names an unnamed saved index can have; the first present is used as Date.
INDEX_NAMES = ("__index_level_0__", "index")


def load_series(
    spark: SparkSession,
    path: str,
    schema: T.StructType | None = None,
    *,
    index: str | None = None,
) -> DataFrame:
    """Read a ``.csv`` file as CSV and anything else as parquet, with ``Date`` parsed.

    Object-store paths must end in ``.csv`` or ``.parquet``. A missing ``Date``
    is taken from the column named by ``index`` or a saved index column. Without a
    ``schema`` the types of CSV columns are inferred, at the cost of one more scan. Rows
    are not sorted here: order belongs to the windows that need it.
    """
    is_csv = path.endswith(".csv")
    if path.startswith(OBJECT_STORES) and not (is_csv or path.endswith(".parquet")):
        raise ValueError(f"unsupported file format: {path}; expected .csv or .parquet")
    if schema is not None:
        reader = spark.read.schema(schema)
    else:  # parquet ignores the option
        reader = spark.read.option("inferSchema", True)
    df = reader.option("header", True).csv(path) if is_csv else _parquet(reader, path)
    if "Date" not in df.columns:
        names = [index] if index else [c for c in INDEX_NAMES if c in df.columns]
        if not names:
            raise ValueError("expected a 'Date' column in the dataset after loading")
        df = df.withColumnRenamed(names[0], "Date")
    kind = df.schema["Date"].dataType
    if isinstance(kind, T.DateType):
        df = df.withColumn("Date", F.col("Date").cast("timestamp"))
    elif isinstance(kind, T.StringType):
        df = df.withColumn("Date", F.to_timestamp("Date"))
    elif isinstance(kind, T.LongType):
        df = df.withColumn("Date", F.timestamp_micros(F.floor(F.col("Date") / 1000)))
    return df


def _parquet(reader: DataFrameReader, path: str) -> DataFrame:
    """Files with nanosecond timestamps are read with those as integers."""
    try:
        return reader.parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PARQUET_TYPE_ILLEGAL":
            raise
        # Needed when the files are read, too, so the setting stays on.
        SparkSession.active().conf.set("spark.sql.legacy.parquet.nanosAsLong", "true")
        return reader.parquet(path)


def load_monthly_csv(spark: SparkSession, path: str) -> DataFrame:
    """Monthly prices: ``Date, Price`` with a header row."""
    raw = spark.read.schema(MONTHLY_PRICES).option("header", True).csv(path)
    return raw.withColumn("Date", F.to_date("Date"))


def null_for_nan(df: DataFrame, cols: list[str]) -> DataFrame:
    """NaN means missing in the saved series; Spark keeps it apart from null."""
    return df.withColumns(
        {c: F.when(~F.isnan(F.col(c).cast("double")), F.col(c)) for c in cols}
    )
