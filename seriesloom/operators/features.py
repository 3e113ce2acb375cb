"""Wide feature frames, driven by a frozen configuration."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seriesloom.functions import rolling, technical
from seriesloom.functions.calendar import calendar_columns
from seriesloom.operators.filters import warmup_trim
from seriesloom.plans.groupstats import attach
from seriesloom.plans.layout import POS, Laid, Layout, lay_out, with_positions

Windows = tuple[int, ...]


@dataclass(frozen=True)
class FeatureConfig:
    """Which blocks to build; a block set to None is left out.

    The library profile uses partial windows and calendar and momentum blocks; the
    notebook profile uses full windows, quantiles and technical indicators.
    """

    profile: str = "library"
    lags: Windows | None = rolling.LAGS
    means: Windows | None = rolling.MEAN_WINDOWS
    stds: Windows | None = rolling.STD_WINDOWS
    rolls: Windows | None = rolling.STAT_WINDOWS
    shorts: Windows = (5, 10)
    longs: Windows = (20, 50)
    momentum: Windows = (5, 10, 20)
    rsi: Windows = (14, 30)
    with_technical: bool = True
    with_dates: bool = True
    with_momentum: bool = True

    @classmethod
    def library(cls, **kw) -> FeatureConfig:
        return cls(**kw)

    @classmethod
    def notebook(cls, **kw) -> FeatureConfig:
        base = dict(
            profile="notebook",
            means=(3, 5, 10, 20, 50),
            stds=(5, 10, 20),
            shorts=(5, 10, 20),
            with_dates=False,
            with_momentum=False,
        )
        return cls(**(base | kw))

    @property
    def full_windows(self) -> bool:
        return self.profile == "notebook"

    def frame_reach(self) -> int:
        """Longest lag or window among the blocks that are trimmed as warm-up."""
        blocks = (self.lags, self.means, self.stds, self.rolls)
        return max((k for b in blocks if b for k in b), default=0)

    def back(self) -> int:
        """Rows of history any feature can look at."""
        reach = max(self.frame_reach(), 1)
        if self.with_technical:
            reach = max(reach, *self.shorts)
            if self.full_windows:
                reach = max(reach, technical.rsi_back(self.rsi), technical.macd_back())
            else:
                reach = max(reach, *self.longs)
        if self.with_momentum:
            reach = max(reach, *self.momentum)
        return reach


def _frame_columns(laid: Laid, value: str, cfg: FeatureConfig) -> dict:
    x, w = F.col(value), laid.w
    periods = None if cfg.full_windows else 1
    out: dict = {}
    if cfg.lags:
        out |= rolling.lags(x, cfg.lags, w)
    if cfg.means:
        out |= rolling.rolling_mean(x, cfg.means, w, periods)
    if cfg.stds:
        out |= rolling.rolling_std(x, cfg.stds, w, periods)
    if cfg.rolls:
        stats = (
            ("min", "max", "median", "q25", "q75")
            if cfg.full_windows
            else ("min", "max", "skew", "kurt")
        )
        out |= rolling.rolling_stats(x, cfg.rolls, w, stats, periods)
    if cfg.with_technical and not cfg.full_windows:
        out |= rolling.ma_cross(x, cfg.shorts, cfg.longs, w)
    if cfg.with_technical and cfg.full_windows:
        out |= technical.bollinger(x, cfg.shorts, laid)
    if cfg.with_momentum:
        out |= rolling.momentum(x, cfg.momentum, w)
        out |= rolling.velocity(x, cfg.momentum, w, "diff")
    return out


def feature_names(cfg: FeatureConfig) -> list[str]:
    """Feature columns of a configuration in output order, without target columns."""
    names: list[str] = []
    names += [f"lag_{k}" for k in cfg.lags or ()]
    names += [f"ma_{k}" for k in cfg.means or ()]
    names += [f"std_{k}" for k in cfg.stds or ()]
    stats = (
        ("min", "max", "median", "q25", "q75")
        if cfg.full_windows
        else ("min", "max", "skew", "kurt")
    )
    names += [f"roll_{s}_{k}" for k in cfg.rolls or () for s in stats]
    if cfg.with_technical:
        if cfg.full_windows:
            names += [f"rsi_{k}" for k in cfg.rsi]
            for k in cfg.shorts:
                names += [f"bb_upper_{k}", f"bb_lower_{k}", f"bb_width_{k}"]
            names += ["macd", "macd_signal", "macd_histogram"]
        else:
            for s in cfg.shorts:
                for n in cfg.longs:
                    if s < n:
                        names += [f"ma_diff_{s}_{n}", f"ma_ratio_{s}_{n}"]
    if cfg.with_dates:
        names += list(calendar_columns(F.current_date(), cfg.profile))
    if cfg.with_momentum:
        names += [f"momentum_{k}" for k in cfg.momentum]
        names += [f"velocidad_{k}" for k in cfg.momentum]
    return names


def build_features(
    df: DataFrame,
    cfg: FeatureConfig = FeatureConfig(),
    value: str = "close",
    layout: Layout = Layout(),
    *,
    target_diff: bool = True,
    trim: bool | None = None,
    keep_pos: bool = False,
    ahead: int = 0,
) -> DataFrame:
    """``ticker, d, target``, all feature columns and ``target_diff``.

    All frames share one partitioning and order, so they run in one Window pass
    after one shuffle. The notebook profile drops its warm-up rows. ``ahead`` adds
    ``target_<ahead>``, the value so many rows later, in the same pass.
    """
    x = df.select(layout.key, layout.ts, F.col(value).cast("double").alias("target"))
    laid = lay_out(x, layout, back=cfg.back(), ahead=ahead)
    if cfg.with_technical and cfg.full_windows:
        # First, as exponential means read their input twice to carry values over gaps.
        laid = technical.macd(laid, "target")
        laid = technical.rsi(laid, "target", cfg.rsi)
    cols = _frame_columns(laid, "target", cfg)
    if target_diff:
        cols["target_diff"] = F.col("target") - F.lag("target", 1).over(laid.w)
    if ahead:
        cols[f"target_{ahead}"] = F.lead("target", ahead).over(laid.w)
    laid = laid.with_columns(cols)
    trim = cfg.full_windows if trim is None else trim
    out = laid.close(keep_pos=trim or keep_pos)
    names = feature_names(cfg)
    if cfg.with_dates:
        out = out.withColumns(calendar_columns(F.col(layout.ts), cfg.profile))
    if trim:
        reach, framed = cfg.frame_reach(), [n for n in names if n in cols]
        if cfg.lags or (cfg.full_windows and (cfg.means or cfg.stds or cfg.rolls)):
            # The first row of every series has a null there: no need to look for one.
            out = out.where(F.col(POS) >= reach).drop(POS)
        else:
            out = warmup_trim(out, reach, framed, layout)
    tail = ["target_diff"] if target_diff else []
    tail += [f"target_{ahead}"] if ahead else []
    pos = ["__pos"] if keep_pos and not trim else []
    return out.select(layout.key, layout.ts, "target", *names, *tail, *pos)


def frame_features(
    df: DataFrame,
    build: Callable[[Laid], dict],
    back: int,
    layout: Layout = Layout(),
    *,
    ahead: int = 0,
    pad: tuple[str, ...] = (),
) -> DataFrame:
    """Series columns plus the columns ``build`` makes on the laid-out table."""
    laid = lay_out(df, layout, back=back, ahead=ahead, pad=pad)
    return laid.with_columns(build(laid)).close()


def forward_target(
    df: DataFrame, h: int = 30, value: str = "close", layout: Layout = Layout()
) -> DataFrame:
    """Value h rows ahead, and the previous kept row's value minus it.

    Rows without a forward value are dropped before the lag is taken, so the rows
    are placed again between the two steps.
    """
    ahead = lay_out(df, layout, ahead=h)
    ahead = ahead.with_columns({f"target_{h}": F.lead(value, h).over(ahead.w)})
    kept = ahead.close().where(F.col(f"target_{h}").isNotNull())
    back = lay_out(kept, layout, back=1)
    gap = F.lag(value, 1).over(back.w) - F.col(f"target_{h}")
    out = back.with_columns({f"diff_{h}": gap}).close()
    return out.where(F.col(f"diff_{h}").isNotNull())


def reconstruct_level(
    df: DataFrame,
    base: DataFrame,
    diffs: dict[str, str],
    layout: Layout = Layout(),
) -> DataFrame:
    """Base value plus the running sum of differences, for each ``{diff column: name}``.

    Running sums are carried between slices of a series, so no frame spans it.
    ``base`` has one row per series: ``ticker, base``.
    """
    sums = {f"__cum_{c}": F.col(c).cast("double") for c in diffs}
    placed = with_positions(df, layout, running=sums).drop(POS)
    joined = attach(placed, base, [layout.key])
    return joined.withColumns(
        {name: F.col("base") + F.col(f"__cum_{c}") for c, name in diffs.items()}
    ).drop("base", *sums)
