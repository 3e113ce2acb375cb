"""Query registry, input tables and shared SQL text."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from seriesloom.plans.layout import Layout
from seriesloom.session import prepare_session
from seriesloom.sources.bars import ohlcv_bars

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

# Short buckets, so that the checks also cover the seams between buckets.
CUT = Layout(rows=1000)

EVENTS = (
    ("1996-02-01", "1996-04-01"),
    ("1998-03-01", "1998-05-01"),
    ("2000-02-01", "2000-04-01"),
    ("2005-01-01", "2005-02-01"),
)
TRAIN = ("1995-01-01", "1999-12-31")
TEST_START = "2000-01-01"


def register(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def keep(fn: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query registered twice: {name}")

        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return fn(prepare_session(spark), sf_dir)

        run.__name__ = name
        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return keep


_SCHEMAS: dict[str, T.StructType] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """An input table; its schema is looked up once, which saves a job per read."""
    path = f"{sf_dir}/{name}.parquet"
    if path not in _SCHEMAS:
        _SCHEMAS[path] = spark.read.parquet(path).schema
    return spark.read.schema(_SCHEMAS[path]).parquet(path)


def bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily bars of order prices per market segment."""
    orders = table(spark, sf_dir, "orders").select(
        "o_custkey", "o_orderdate", "o_totalprice", "o_orderkey"
    )
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment")
    joined = orders.join(customer, F.col("o_custkey") == F.col("c_custkey"))
    return ohlcv_bars(joined, "c_mktsegment", "o_orderdate", "o_totalprice", "o_orderkey")


def closes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bars(spark, sf_dir).select("ticker", "d", "close")


def mkt(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One long series over all orders."""
    return (
        table(spark, sf_dir, "orders")
        .groupBy(F.lit("ALL").alias("ticker"), F.col("o_orderdate").cast("date").alias("d"))
        .agg(
            F.max_by("o_totalprice", "o_orderkey").alias("close"),
            F.count(F.lit(1)).alias("volume"),
        )
    )


def natbars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily closes per nation."""
    orders = table(spark, sf_dir, "orders")
    customer = table(spark, sf_dir, "customer")
    nation = table(spark, sf_dir, "nation")
    return (
        orders.join(customer, F.col("o_custkey") == F.col("c_custkey"))
        .join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .groupBy(
            F.col("n_name").alias("ticker"), F.col("o_orderdate").cast("date").alias("d")
        )
        .agg(F.max_by("o_totalprice", "o_orderkey").alias("close"))
    )


def ticks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hourly values per event type."""
    return (
        table(spark, sf_dir, "events")
        .groupBy(
            F.col("event_type").alias("ticker"),
            F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("h"),
        )
        .agg(F.max_by("value", "event_id").alias("close"), F.count(F.lit(1)).alias("n"))
    )


def gappy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Closes with every seventh day (by day number) missing."""
    day = F.datediff("d", F.lit("1970-01-01").cast("date"))
    return closes(spark, sf_dir).withColumn(
        "close", F.when(day % 7 != 0, F.col("close"))
    )


# Prices have two decimals, so means of them can lie exactly between two rounded
# values, where the last bit of a sum decides. Both sides shift by this share of
# the last digit first, which no such mean can land on.
SHIFT = 0.00314159


def rounded(df: DataFrame, digits: int = 4, cols: Sequence[str] | None = None) -> DataFrame:
    """Round floating columns, as the SQL side does."""
    names = cols or [
        f.name for f in df.schema if isinstance(f.dataType, (T.DoubleType, T.FloatType))
    ]
    shift = SHIFT * 10.0**-digits
    # Adding zero turns a negative zero into zero.
    return df.selectExpr(
        *(
            f"round(`{c}` + {shift!r}D, {digits}) + 0.0D AS `{c}`"
            if c in names
            else f"`{c}`"
            for c in df.columns
        )
    )


def big(col: str | Column) -> Column:
    return (F.col(col) if isinstance(col, str) else col).cast("bigint")


BARS = """bars AS (
SELECT c_mktsegment AS ticker, CAST(o_orderdate AS DATE) AS d,
  arg_min(o_totalprice, o_orderkey) AS open, max(o_totalprice) AS high,
  min(o_totalprice) AS low, arg_max(o_totalprice, o_orderkey) AS close, count(*) AS volume
FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1, 2)"""

ROWS = f"""{BARS},
x AS (SELECT ticker, d, close, row_number() OVER (PARTITION BY ticker ORDER BY d) AS rn,
  count(*) OVER (PARTITION BY ticker) AS n FROM bars)"""

GAPPY = f"""{BARS},
g AS (SELECT ticker, d, CASE WHEN date_diff('day', DATE '1970-01-01', d) % 7 <> 0 THEN close END AS close,
  row_number() OVER (PARTITION BY ticker ORDER BY d) AS rn FROM bars)"""

MKT = """mkt AS (
SELECT 'ALL' AS ticker, CAST(o_orderdate AS DATE) AS d, arg_max(o_totalprice, o_orderkey) AS close
FROM orders GROUP BY 2)"""

NATBARS = """natbars AS (
SELECT n_name AS ticker, CAST(o_orderdate AS DATE) AS d, arg_max(o_totalprice, o_orderkey) AS close
FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey GROUP BY 1, 2)"""

TICKS = """ticks AS (
SELECT event_type AS ticker, date_trunc('hour', ts) AS h, arg_max(value, event_id) AS close, count(*) AS n
FROM events GROUP BY 1, 2)"""


def prev(size: int, order: str = "d") -> str:
    """OVER clause of the ``size`` rows before the current one."""
    return (
        f"OVER (PARTITION BY ticker ORDER BY {order} "
        f"ROWS BETWEEN {size} PRECEDING AND 1 PRECEDING)"
    )


def last(size: int, order: str = "d") -> str:
    """OVER clause of the last ``size`` rows, current row included."""
    return (
        f"OVER (PARTITION BY ticker ORDER BY {order} "
        f"ROWS BETWEEN {size - 1} PRECEDING AND CURRENT ROW)"
    )


W = "OVER (PARTITION BY ticker ORDER BY d)"


def rnd(expr: str, digits: int = 4) -> str:
    return f"ROUND({expr} + {SHIFT * 10.0**-digits!r}, {digits}) + 0.0"


def r(expr: str, name: str, digits: int = 4) -> str:
    return f'{rnd(expr, digits)} AS "{name}"'
