"""Exact quantiles of whole columns without gathering a column in one task."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

ACCURACY = 10_000
# Distinct values per bracket that may be counted in one aggregation buffer.
SMALL = 200_000


def exact_quantiles(
    df: DataFrame,
    cols: Sequence[str],
    qs: Sequence[float],
    small: int = SMALL,
    accuracy: int = ACCURACY,
) -> dict[str, dict[float, float | None]]:
    """Linear-interpolated quantiles of each column, ``{column: {q: value}}``.

    Each needed order statistic is bracketed between two values: a mergeable
    sketch proposes tighter ends, exact counts below and at the ends keep the
    bracket right, and the loop repeats until few rows remain inside, whose
    values are then counted exactly. Only scalars reach the driver.
    """
    base = df.agg(
        *(F.count(c).alias(f"n_{c}") for c in cols),
        *(F.min(c).cast("double").alias(f"lo_{c}") for c in cols),
        *(F.max(c).cast("double").alias(f"hi_{c}") for c in cols),
    ).first()
    ranks: dict[str, set[int]] = {}
    for c in cols:
        n = base[f"n_{c}"]
        ranks[c] = set()
        for q in qs if n else ():
            at = q * (n - 1)
            ranks[c] |= {math.floor(at), math.ceil(at)}
    values: dict[tuple[str, int], float] = {}
    # (column, rank) -> (lo, hi, rows below lo, rows inside [lo, hi])
    open_: dict[tuple[str, int], tuple[float, float, int, int]] = {
        (c, r): (base[f"lo_{c}"], base[f"hi_{c}"], 0, base[f"n_{c}"])
        for c in cols
        for r in ranks[c]
    }
    while open_:
        for job, (lo, hi, _, _) in list(open_.items()):
            if lo == hi:
                values[job] = lo
                del open_[job]
        wide = {j: b for j, b in open_.items() if b[3] > small}
        if not wide:
            break
        open_ |= _narrow(df, wide, accuracy)
    if open_:
        values |= _select(df, open_)
    out: dict[str, dict[float, float | None]] = {}
    for c in cols:
        n = base[f"n_{c}"]
        out[c] = {}
        for q in qs:
            if not n:
                out[c][q] = None
                continue
            at = q * (n - 1)
            low, high = values[c, math.floor(at)], values[c, math.ceil(at)]
            out[c][q] = low + (high - low) * (at - math.floor(at))
    return out


def _inside(c: str, lo: float, hi: float):
    x = F.col(c).cast("double")
    return (x >= F.lit(lo)) & (x <= F.lit(hi))


def _narrow(df: DataFrame, wide: dict, accuracy: int) -> dict:
    jobs = list(wide.items())
    margin = 4.0 / accuracy
    asks = []
    for i, ((c, rank), (lo, hi, below, inside)) in enumerate(jobs):
        share = (rank - below + 0.5) / inside
        ends = [max(0.0, share - margin), min(1.0, share + margin)]
        # A value inside the bracket, also when both ends equal the bracket's own.
        picks = F.array(*(F.lit(e) for e in (ends[0], share, ends[1])))
        asks.append(
            F.percentile_approx(
                F.when(_inside(c, lo, hi), F.col(c).cast("double")), picks, accuracy
            ).alias(f"p{i}")
        )
    cuts = df.agg(*asks).first()
    counts = []
    points: list[list[float]] = []
    for i, ((c, _), (lo, hi, _, _)) in enumerate(jobs):
        pts = sorted({lo, hi, *(v for v in cuts[f"p{i}"])})
        points.append(pts)
        x = F.col(c).cast("double")
        for k, p in enumerate(pts):
            counts.append(F.count_if(x < F.lit(p)).alias(f"b{i}_{k}"))
            counts.append(F.count_if(x == F.lit(p)).alias(f"e{i}_{k}"))
    got = df.agg(*counts).first()
    out = {}
    for i, ((c, rank), (lo, hi, below, inside)) in enumerate(jobs):
        pts = points[i]
        best = (lo, hi, below, inside)
        for k, p in enumerate(pts):
            less, equal = got[f"b{i}_{k}"], got[f"e{i}_{k}"]
            if less <= rank < less + equal:
                best = (p, p, less, equal)
                break
            if k + 1 < len(pts):
                upper = got[f"b{i}_{k + 1}"]
                if less + equal <= rank < upper:
                    # Strictly between two cut points: open ends via nextafter.
                    best = (
                        math.nextafter(p, math.inf),
                        math.nextafter(pts[k + 1], -math.inf),
                        less + equal,
                        upper - less - equal,
                    )
                    break
        out[c, rank] = best
    return out


def _select(df: DataFrame, open_: dict) -> dict:
    """Order statistics of small brackets from exact value counts."""
    jobs = list(open_.items())
    cols, asks = [], []
    for i, ((c, rank), (lo, hi, below, inside)) in enumerate(jobs):
        x = F.col(c).cast("double")
        cols.append(F.when(_inside(c, lo, hi), x).alias(f"x{i}"))
        # The smallest value whose share of rows reaches this is the wanted one.
        share = (rank - below + 0.5) / inside
        asks.append(
            F.expr(f"percentile_disc({share!r}D) WITHIN GROUP (ORDER BY x{i})").alias(
                f"v{i}"
            )
        )
    got = df.select(*cols).agg(*asks).first()
    return {job: got[f"v{i}"] for i, (job, _) in enumerate(jobs)}
