"""Technical indicators that need more than one window stage."""

from __future__ import annotations

import math
from collections.abc import Iterable, Mapping

from pyspark.sql import Column, Window
from pyspark.sql import functions as F

from seriesloom.functions.rolling import before, gated
from seriesloom.plans.layout import BUCKET, HALO, POS, Laid
from seriesloom.session import cut_lineage

# Weight below which older rows no longer change a double.
NEGLIGIBLE = 1e-17
# Largest exponent (natural log) kept when weights are written relative to a chunk start.
MAX_EXPONENT = 300.0


def rsi_back(ws: Iterable[int]) -> int:
    return max(ws) + 1


def rsi(laid: Laid, x: str, ws: Iterable[int] = (14, 30)) -> Laid:
    """Relative strength over the previous n rows: 100 without losses, null when flat."""
    delta = F.col(x) - F.lag(x, 1).over(laid.w)
    staged = laid.with_columns(
        {
            "__gain": F.when(delta > 0, delta).otherwise(F.lit(0.0)),
            "__loss": F.when(delta < 0, -delta).otherwise(F.lit(0.0)),
        }
    )
    out: dict[str, Column] = {}
    for n in ws:
        f = before(staged.w, n)
        gain = gated(F.avg("__gain").over(f), F.col("__gain"), f, n, None)
        loss = gated(F.avg("__loss").over(f), F.col("__loss"), f, n, None)
        ratio = F.lit(100.0) - F.lit(100.0) / (1 + F.try_divide(gain, loss))
        out[f"rsi_{n}"] = F.when((loss == 0) & (gain > 0), F.lit(100.0)).otherwise(ratio)
    done = staged.with_columns(out)
    return Laid(done.df.drop("__gain", "__loss"), laid.layout)


def bollinger(
    x: Column, ws: Iterable[int], laid: Laid, k: float = 2.0
) -> dict[str, Column]:
    """Full-window mean plus and minus k standard deviations, and the width."""
    out: dict[str, Column] = {}
    for n in ws:
        f = before(laid.w, n)
        mean = gated(F.avg(x).over(f), x, f, n, None)
        std = gated(F.stddev_samp(x).over(f), x, f, n, None)
        upper, lower = mean + k * std, mean - k * std
        out[f"bb_upper_{n}"] = upper
        out[f"bb_lower_{n}"] = lower
        out[f"bb_width_{n}"] = upper - lower
    return out


def _decay(span: float) -> float:
    return 1.0 - 2.0 / (span + 1.0)


def ewm_chunk(span: float) -> int:
    """Rows after which a weight has decayed below ``NEGLIGIBLE``."""
    return math.ceil(math.log(NEGLIGIBLE) / math.log(_decay(span)))


def ewm_back(spans: Iterable[float]) -> int:
    return 2 * max(ewm_chunk(s) for s in spans)


def _chunk_groups(spans: Mapping[str, float]) -> list[tuple[int, dict[str, float]]]:
    """Share one chunk length between spans unless a fast decay would overflow in it."""
    size = max(ewm_chunk(s) for s in spans.values())
    if all(-size * math.log(_decay(s)) < MAX_EXPONENT for s in spans.values()):
        return [(size, dict(spans))]
    return [(ewm_chunk(s), {name: s}) for name, s in spans.items()]


def ewm(laid: Laid, x: str, spans: Mapping[str, float]) -> Laid:
    """Exponentially weighted mean, ``{output name: span}``, current row included.

    Weights are normalised and a null keeps its place in the decay. The series is
    read in fixed chunks long enough for a weight to vanish, so one running sum
    inside the chunk plus the total of the chunk before is the whole sum: constant
    work per row instead of a frame per row. Needs ``back >= ewm_back(spans)``.

    Nulls leave the mean as it was. Where they fill a bucket and its halo, the mean
    comes from the nearest bucket before that has one: a table of one row per bucket.
    """
    key = laid.layout.key
    for size, group in _chunk_groups(spans):
        chunk = F.floor(F.col(POS) / size)
        j = F.pmod(F.col(POS), F.lit(size)).cast("double")
        laid = laid.with_columns({"__chunk": chunk, "__j": j})
        inner = (
            Window.partitionBy(key, BUCKET, "__chunk")
            .orderBy(POS)
            .rowsBetween(Window.unboundedPreceding, 0)
        )
        outer = Window.partitionBy(key, BUCKET).orderBy("__chunk", POS)
        past = outer.rowsBetween(Window.unboundedPreceding, -1)
        upto = outer.rowsBetween(Window.unboundedPreceding, 0)
        present = F.col(x).isNotNull()
        sums: dict[str, Column] = {}
        for name, span in group.items():
            r = _decay(span)
            weight = F.pow(F.lit(1.0 / r), F.col("__j"))
            shrink = F.pow(F.lit(r), F.col("__j"))
            sums[f"__num_{name}"] = (
                F.coalesce(F.sum(F.col(x) * weight).over(inner), F.lit(0.0)) * shrink
            )
            sums[f"__den_{name}"] = (
                F.coalesce(F.sum(F.when(present, weight)).over(inner), F.lit(0.0))
                * shrink
            )
        laid = laid.with_columns(sums)
        last_row = F.col("__j") == size - 1
        totals: dict[str, Column] = {}
        for name, span in group.items():
            step = F.pow(F.lit(_decay(span)), F.col("__j") + 1)
            for part in ("num", "den"):
                own = F.col(f"__{part}_{name}")
                carried = F.last(F.when(last_row, own), True).over(past)
                totals[f"__{part}_{name}"] = (
                    own + F.coalesce(carried, F.lit(0.0)) * step
                )
        laid = laid.with_columns(totals)
        means = {
            name: F.try_divide(
                F.col(f"__num_{name}"), F.nullif(F.col(f"__den_{name}"), F.lit(0.0))
            )
            for name in group
        }
        laid = laid.with_columns(means)
        held = {name: F.last(name, True).over(upto) for name in group}
        laid = laid.with_columns(held)
        laid = Laid(laid.df.drop("__chunk", "__j", *totals), laid.layout)
    return laid if laid.layout.mode == "plain" else _carry(laid, list(spans))


def _carry(laid: Laid, names: list[str]) -> Laid:
    """Fill leading nulls of a bucket with the last value of the buckets before it.

    The last value of a bucket is its last row's, as values are held within it.
    """
    key = laid.layout.key
    ends = laid.df.where(~F.col(HALO)).groupBy(key, BUCKET).agg(
        *(F.max_by(n, POS).alias(f"__end_{n}") for n in names)
    )
    past = Window.partitionBy(key).orderBy(BUCKET).rowsBetween(Window.unboundedPreceding, -1)
    before_ = ends.select(
        key, BUCKET, *(F.last(f"__end_{n}", True).over(past).alias(f"__past_{n}") for n in names)
    )
    joined = laid.df.join(before_, [key, BUCKET], "left")
    return Laid(
        joined.withColumns({n: F.coalesce(n, f"__past_{n}") for n in names}).drop(
            *(f"__past_{n}" for n in names)
        ),
        laid.layout,
    )


def macd_back(fast: int = 12, slow: int = 26, signal: int = 9) -> int:
    return ewm_back([fast, slow]) + ewm_back([signal]) + 2


def macd(laid: Laid, x: str, fast: int = 12, slow: int = 26, signal: int = 9) -> Laid:
    """Difference of two exponential means of the past, its smoothed signal and their gap.

    Shifting before or after an exponential mean is the same, so the means run on
    the series itself and are shifted afterwards. Each mean reads its input twice, so the
    laid-out rows are stored first.
    """
    if laid.layout.mode != "plain":
        tasks = laid.df.sparkSession.conf.get("spark.sql.shuffle.partitions")
        stored = cut_lineage(laid.df).repartition(laid.layout.tasks or int(tasks), laid.layout.key, BUCKET)
        laid = Laid(stored, laid.layout)
    staged = ewm(laid, x, {"__fast": fast, "__slow": slow})
    staged = staged.with_columns(
        {"macd": F.lag(F.col("__fast") - F.col("__slow"), 1).over(laid.w)}
    )
    staged = ewm(staged, "macd", {"__signal": signal})
    staged = staged.with_columns({"macd_signal": F.lag("__signal", 1).over(laid.w)})
    staged = staged.with_columns(
        {"macd_histogram": F.col("macd") - F.col("macd_signal")}
    )
    return Laid(staged.df.drop("__fast", "__slow", "__signal"), laid.layout)
