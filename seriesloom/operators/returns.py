"""Daily and monthly returns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from seriesloom.functions.rolling import relative_change
from seriesloom.plans.layout import Layout, lay_out


def daily_return(
    df: DataFrame, value: str = "close", layout: Layout = Layout()
) -> DataFrame:
    """Relative change to the row before; a missing value repeats the last known one."""
    laid = lay_out(df.withColumn("__x", F.col(value)), layout, back=1, pad=["__x"])
    change = relative_change(F.col("__x"), 1, laid.w)
    return laid.with_columns({"daily_return": change}).close().drop("__x")


def _compounded(prev: Column) -> Column:
    """Product of daily growth factors of a month, from its summary.

    Without zeros the product telescopes to last / last-of-earlier-months. A price
    that falls to zero contributes a factor 0 and one that leaves zero an infinite
    factor, so the product is 0 if the month ends in zeros it never leaves, and
    undefined (null) once a zero is left.
    """
    start = F.coalesce(prev, F.col("first"))
    leaves_zero = (F.col("first_zero") < F.col("last_nonzero")) | (
        (start == 0) & (F.col("n_nonzero") > 0)
    )
    only_zero = (start == 0) & (F.col("n_nonzero") == 0)
    return (
        F.when(F.col("last").isNull() | only_zero, F.lit(1.0))
        .when(leaves_zero, F.lit(None).cast("double"))
        .otherwise(F.try_divide(F.col("last"), start))
    )


def monthly_returns(
    df: DataFrame, value: str = "close", key: str = "ticker", ts: str = "d"
) -> DataFrame:
    """Compounded return per calendar month, labelled with the month end.

    Months without rows between the first and the last one give 0.0. Daily growth
    factors telescope, so one map-side combined aggregate per (series, month)
    replaces a window over every row; the rest runs on the monthly table.
    """
    x, t = F.col(value).cast("double"), F.col(ts)
    zero, nonzero = x == 0, x != 0
    months = df.groupBy(key, F.last_day(t.cast("date")).alias("month_end")).agg(
        F.min_by(x, F.when(x.isNotNull(), t)).alias("first"),
        F.max_by(x, F.when(x.isNotNull(), t)).alias("last"),
        F.min(F.when(zero, t)).alias("first_zero"),
        F.max(F.when(nonzero, t)).alias("last_nonzero"),
        F.count_if(nonzero).alias("n_nonzero"),
    )
    w = Window.partitionBy(key).orderBy("month_end")
    prev = F.last("last", True).over(w.rowsBetween(Window.unboundedPreceding, -1))
    following = F.coalesce(F.lead("month_end", 1).over(w), F.add_months("month_end", 1))
    done = months.select(
        key,
        "month_end",
        _compounded(prev).alias("__growth"),
        F.trunc("month_end", "month").alias("__from"),
        F.trunc(following, "month").alias("__next"),
    )
    # Each month also emits the empty months up to the next one with rows.
    filled = done.select(
        key,
        F.posexplode(
            F.sequence(
                F.col("__from"),
                F.add_months("__next", -1),
                F.expr("interval 1 month"),
            )
        ).alias("__gap", "__month"),
        "__growth",
    )
    value_of = F.when(F.col("__gap") == 0, F.col("__growth") - 1).otherwise(F.lit(0.0))
    return filled.select(
        key, F.last_day("__month").alias("month_end"), value_of.alias("monthly_return")
    )
