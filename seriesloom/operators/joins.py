"""Joins: attach columns by date, align, event flags, positional alignment."""

from __future__ import annotations

import calendar
from collections.abc import Sequence
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seriesloom.plans.groupstats import attach as attach_stats
from seriesloom.plans.layout import POS, Layout, with_positions

Event = Sequence[str] | str


def attach(df: DataFrame, other: DataFrame, on: Sequence[str] = ("ticker", "d")) -> DataFrame:
    """Left equi join; rows of ``df`` without a partner keep nulls."""
    return df.join(other, list(on), "left")


def align(
    df: DataFrame,
    exog: DataFrame,
    on: Sequence[str] = ("ticker", "d"),
    strict: bool = False,
) -> DataFrame:
    """Rows present on both sides; ``strict`` raises if either side has others."""
    if strict:
        missing = [
            a.join(b, list(on), "left_anti").limit(1).count()
            for a, b in ((df, exog), (exog, df))
        ]
        if any(missing):
            raise ValueError("the series and the exogenous table have different dates")
    return df.join(exog, list(on), "inner")


def period_days(event: Event) -> tuple[str, str]:
    """First and last day of an event given as a pair, a day, a month or a year."""
    if not isinstance(event, str):
        start, end = event
        return period_days(start)[0], period_days(end)[1]
    parts = event.split("-")
    if len(parts) == 3:
        return event, event
    year = int(parts[0])
    if len(parts) == 2:
        month = int(parts[1])
        last = calendar.monthrange(year, month)[1]
        return f"{year:04d}-{month:02d}-01", f"{year:04d}-{month:02d}-{last:02d}"
    return f"{year:04d}-01-01", f"{year:04d}-12-31"


def in_event(ts: Column, event: Event, day_granular: bool = True) -> Column:
    """Whether ``ts`` falls in the event.

    Day-granular events include their whole last day; otherwise the end is the
    instant at midnight.
    """
    start, end = period_days(event)
    first, last = F.lit(start).cast("date"), F.lit(end).cast("date")
    if day_granular:
        return (ts >= first) & (ts < F.date_add(last, 1))
    return (ts >= first) & (ts <= last)


def event_flags(
    df: DataFrame,
    events: Sequence[Event],
    ts: str = "d",
    *,
    per_event: bool = False,
    day_granular: bool = True,
    name: str = "event",
) -> DataFrame:
    """0/1 flag of the rows inside any event, or one flag ``event_1..n`` per event.

    A null time has a null flag; a period that ends before it starts marks nothing.
    """
    if per_event:
        tests = {
            f"{name}_{i}": in_event(F.col(ts), e, day_granular).cast("int")
            for i, e in enumerate(events, 1)
        }
        return df.withColumns(tests)
    hit = F.lit(False)
    for period in merged_periods(events, day_granular):
        hit = hit | in_event(F.col(ts), period, day_granular)
    if events:
        hit = F.when(F.col(ts).isNotNull(), hit)
    return df.withColumn(name, hit.cast("int"))


def merged_periods(
    events: Sequence[Event], day_granular: bool = True
) -> list[tuple[str, str]]:
    """The same instants as disjoint periods in order; empty periods are left out.

    Day-granular periods also merge when the next one starts on the day after.
    """
    days = sorted(
        (date.fromisoformat(a), date.fromisoformat(b)) for a, b in map(period_days, events)
    )
    gap = timedelta(days=1 if day_granular else 0)
    out: list[list[date]] = []
    for first, last in days:
        if last < first:
            continue
        if out and first <= out[-1][1] + gap:
            out[-1][1] = max(out[-1][1], last)
        else:
            out.append([first, last])
    return [(a.isoformat(), b.isoformat()) for a, b in out]


def event_flags_table(
    df: DataFrame, events: DataFrame, ts: str = "d", name: str = "event"
) -> DataFrame:
    """Day-granular flag from a table of ``start, end`` dates.

    Periods are opened into distinct days, so the interval test becomes an equi
    join on the day; its size is the number of calendar days covered. A null time
    has a null flag; a period that ends before it starts marks nothing.
    """
    days = events.where(F.col("start") <= F.col("end")).select(
        F.explode(F.sequence("start", "end", F.expr("interval 1 day"))).alias("__day")
    ).distinct()
    keyed = df.withColumn("__day", F.col(ts).cast("date"))
    joined = attach_stats(keyed, days.withColumn("__hit", F.lit(1)), ["__day"])
    hit = F.when(F.col(ts).isNotNull(), F.coalesce("__hit", F.lit(0)))
    return joined.withColumn(name, hit).drop("__day", "__hit")


def event_coverage(
    df: DataFrame,
    events: Sequence[tuple[str, str]],
    ts: str = "d",
    key: str = "ticker",
) -> DataFrame:
    """Rows marked by each event in each series, zero and out-of-range events included."""
    t = F.col(ts)
    aggs = [F.min(t).alias("__min"), F.max(t).alias("__max")]
    for i, e in enumerate(events):
        aggs.append(F.count_if(in_event(t, e, day_granular=False)).alias(f"__c{i}"))
    stats = df.groupBy(key).agg(*aggs)
    rows = []
    for i, (start, end) in enumerate(events):
        first, last = F.lit(start).cast("date"), F.lit(end).cast("date")
        rows.append(
            F.struct(
                F.lit(i + 1).alias("event_no"),
                first.alias("start_d"),
                last.alias("end_d"),
                (~((first > F.col("__max")) | (last < F.col("__min")))).alias("in_range"),
                F.col(f"__c{i}").alias("marked"),
            )
        )
    # Both ends of the range test use the series' own dates.
    return stats.select(key, F.explode(F.array(*_named(rows))).alias("e")).select(
        key, "e.event_no", "e.start_d", "e.end_d", "e.in_range", "e.marked"
    )


def _named(rows: list[Column]) -> list[Column]:
    kind = "struct<event_no:int,start_d:date,end_d:date,in_range:boolean,marked:bigint>"
    return [r.cast(kind) for r in rows]


def positional_align(
    values: DataFrame, dates: DataFrame, layout: Layout = Layout()
) -> DataFrame:
    """Give the n-th value of a series the n-th date of the same series.

    ``values`` has ``step`` (1-based) per series; the shorter side decides.
    """
    placed = with_positions(dates, layout).withColumn(
        "step", (F.col(POS) + 1).cast("int")
    )
    return values.join(placed.drop(POS), [layout.key, "step"], "inner")


def union_predictions(train: DataFrame, test: DataFrame) -> DataFrame:
    return train.unionByName(test)
