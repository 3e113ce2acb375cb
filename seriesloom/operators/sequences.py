"""Sequence windows for sequence models."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seriesloom.functions.rolling import before
from seriesloom.operators.scaling import fit_minmax, minmax_scale
from seriesloom.plans.groupstats import attach
from seriesloom.plans.layout import POS, Layout, lay_out, with_positions


def sequences(
    df: DataFrame,
    cols: Sequence[str],
    target: str,
    length: int = 60,
    layout: Layout = Layout(),
    *,
    keep_pos: bool = False,
) -> DataFrame:
    """``seq``: the feature rows of the ``length`` rows before, oldest first; ``y``: this row.

    The first ``length`` rows of a series give no sequence. Nulls keep their place.
    """
    slim = df.select(
        layout.key, layout.ts, F.array(*(F.col(c) for c in cols)).alias("__f"),
        F.col(target).alias("y"),
    )
    laid = lay_out(slim, layout, back=length)
    laid = laid.with_columns(
        {"seq": F.collect_list("__f").over(before(laid.w, length))}
    )
    out = laid.close(keep_pos=True).where(F.col(POS) >= length).drop("__f")
    return out if keep_pos else out.drop(POS)


def flat_sequences(seq_df: DataFrame, length: int, feature: int = 0) -> DataFrame:
    """One feature of each sequence as columns ``x1..xL``."""
    return seq_df.select(
        *(c for c in seq_df.columns if c not in ("seq", "y")),
        *(
            F.get(F.get("seq", F.lit(i)), F.lit(feature)).alias(f"x{i + 1}")
            for i in range(length)
        ),
        "y",
    )


def sequence_dataset(
    df: DataFrame,
    length: int = 60,
    ratio: float = 0.8,
    features: Sequence[str] | None = None,
    target: str = "close",
    layout: Layout = Layout(),
    *,
    fit_on: str = "all",
) -> DataFrame:
    """Scaled sequences with a chronological ``split`` column.

    Default features are all columns but the target. ``fit_on="all"`` scales by
    every row; ``"train"`` only by rows that the training sequences see.
    """
    if features is None:
        skip = {layout.key, layout.ts, target}
        features = [c for c in df.columns if c not in skip]
    cols = list(dict.fromkeys([*features, target]))
    n = df.groupBy(layout.key).agg(F.count(F.lit(1)).alias("__n"))
    if fit_on == "all":
        stats = fit_minmax(df, cols, layout.key)
    elif fit_on == "train":
        counted = attach(with_positions(df, layout), n, [layout.key])
        limit = F.floor((F.col("__n") - length) * F.lit(ratio)) + length
        stats = fit_minmax(counted, cols, layout.key, F.col(POS) < limit)
    else:
        raise ValueError(f"unknown fit_on: {fit_on}")
    scaled = minmax_scale(df, stats, cols, layout.key, layout.ts)
    seq = sequences(scaled, features, target, length, layout, keep_pos=True)
    counted = attach(seq, n, [layout.key])
    is_train = F.col(POS) - length < F.floor((F.col("__n") - length) * F.lit(ratio))
    return counted.withColumn(
        "split", F.when(is_train, "train").otherwise("test")
    ).drop(POS, "__n")
