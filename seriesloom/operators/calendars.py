"""Calendars as tables: business days, future dates, dates for predictions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def local_time(df: DataFrame, ts: str, zone: str, name: str) -> DataFrame:
    """Local wall-clock time of a UTC instant, for calendar columns."""
    instant = F.col(ts)
    if isinstance(df.schema[ts].dataType, T.TimestampNTZType):
        return df.withColumn(name, F.convert_timezone(F.lit("UTC"), F.lit(zone), instant))
    return df.withColumn(name, F.from_utc_timestamp(instant, zone))


def _weekdays(start: Column, end: Column) -> Column:
    days = F.sequence(start, end, F.expr("interval 1 day"))
    return F.filter(days, lambda d: F.weekday(d) < 5)


def business_days_between(
    spans: DataFrame, start: str = "start", end: str = "end"
) -> DataFrame:
    """Monday-to-Friday days of each span, inclusive, numbered from 1, with their count.

    Spans without a business day give no rows.
    """
    keep = [c for c in spans.columns if c not in (start, end)]
    days = _weekdays(F.col(start).cast("date"), F.col(end).cast("date"))
    return (
        spans.withColumn("__days", days)
        .select(*keep, F.size("__days").alias("n_days"), F.posexplode("__days").alias("i", "d"))
        .withColumn("step", F.col("i") + 1)
        .drop("i")
    )


def business_days(spark: SparkSession, start: str, end: str) -> DataFrame:
    """Business days of one window; an empty window is an error."""
    span = spark.range(1).select(
        F.lit(start).cast("date").alias("start"), F.lit(end).cast("date").alias("end")
    )
    days = business_days_between(span)
    if days.isEmpty():
        raise ValueError("the requested window has no business days to predict")
    return days


def future_calendar(
    df: DataFrame, periods: int, freq: str = "D", key: str = "ticker", ts: str = "d"
) -> DataFrame:
    """``periods`` dates per series from the day after its last: days, week ends or month ends.

    Another ``freq`` is an interval such as ``1 hour``: times at that step after the last one.
    """
    first = F.date_add(F.col("__last"), 1)
    step = F.col("step")
    if freq == "D":
        date = F.date_add(F.col("__last"), step)
    elif freq == "W":
        # Weeks end on Sunday; next_day looks strictly after its argument.
        date = F.date_add(F.next_day(F.col("__last"), "SUN"), 7 * (step - 1))
    elif freq == "M":
        date = F.last_day(F.add_months(first, step - 1))
    elif len(parts := freq.split()) == 2 and parts[0].isdigit():
        date = F.col("__last") + F.expr(f"INTERVAL '1' {parts[1]}") * (step * int(parts[0]))
    else:
        raise ValueError(f"unknown frequency: {freq}")
    last = F.col(ts).cast("date") if freq in ("D", "W", "M") else F.col(ts)
    return (
        df.groupBy(key)
        .agg(F.max(last).alias("__last"))
        .withColumn("step", F.explode(F.sequence(F.lit(1), F.lit(periods))))
        .select(key, "step", date.alias("d"))
    )


def calendar_align(forecasts: DataFrame, start: str, end: str, key: str = "ticker") -> DataFrame:
    """Give step n the n-th business day of the window; extra steps are dropped."""
    days = business_days(forecasts.sparkSession, start, end).select("step", "d")
    base = forecasts.drop("d") if "d" in forecasts.columns else forecasts
    return base.join(days, "step", "inner")
