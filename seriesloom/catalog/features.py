"""Window features, wide frames and model-ready datasets."""

from __future__ import annotations

import re

from pyspark.sql import functions as F

from seriesloom.catalog.base import (
    BARS,
    CUT,
    EVENTS,
    GAPPY,
    MKT,
    NATBARS,
    ROWS,
    TEST_START,
    TICKS,
    TRAIN,
    W,
    bars,
    closes,
    gappy,
    last,
    mkt,
    natbars,
    prev,
    r,
    register,
    rnd,
    rounded,
    table,
    ticks,
)
from seriesloom.catalog.calendar import LIBRARY, columns_sql
from seriesloom.functions import rolling, technical
from seriesloom.operators import datasets, features, quality, returns, sequences
from seriesloom.operators.features import FeatureConfig, frame_features
from seriesloom.plans.layout import POS, Layout, lay_out

def X():
    return F.col("close")


def _frames(df, build, back, **kw):
    return frame_features(df, build, back, CUT, **kw)


def full(agg: str, n: int) -> str:
    return f"CASE WHEN count(close) {prev(n)} >= {n} THEN {agg} {prev(n)} END"


def sql_lags(ks) -> list[str]:
    return [f"lag(close, {k}) {W} AS lag_{k}" for k in ks]


def sql_partial(agg: str, prefix: str, ws, digits: int = 4) -> list[str]:
    return [r(f"{agg}(close) {prev(n)}", f"{prefix}_{n}", digits) for n in ws]


def sql_full(agg: str, prefix: str, ws, digits: int = 4) -> list[str]:
    return [r(full(f"{agg}(close)", n), f"{prefix}_{n}", digits) for n in ws]


def sql_moment(fn: str, prefix: str, ws) -> list[str]:
    least = 3 if fn == "skewness" else 4
    return [
        r(f"CASE WHEN count(close) {prev(n)} >= {least} THEN {fn}(close) {prev(n)} END", f"{prefix}_{n}")
        for n in ws
    ]


def sql_minmax(ws) -> list[str]:
    return [f"{s}(close) {prev(n)} AS roll_{s}_{n}" for n in ws for s in ("min", "max")]


def sql_cross(what: str) -> list[str]:
    out = []
    for s in (5, 10):
        for n in (20, 50):
            a, b = full("avg(close)", s), full("avg(close)", n)
            if what == "diff":
                out.append(r(f"({a}) - ({b})", f"ma_diff_{s}_{n}"))
            else:
                out.append(r(f"({a}) / NULLIF(({b}), 0)", f"ma_ratio_{s}_{n}", 6))
    return out


def sql_momentum(ws) -> list[str]:
    return [r(f"close / NULLIF(lag(close, {k}) {W}, 0) - 1", f"momentum_{k}", 6) for k in ws]


def sql_velocity(ws) -> list[str]:
    return [r(f"(close - lag(close, {k}) {W}) / {k}", f"velocidad_{k}") for k in ws]


def over_bars(cols: list[str], source: str = BARS, table_: str = "bars", t: str = "d") -> str:
    return f"WITH {source} SELECT ticker, {t}, {', '.join(cols)} FROM {table_}"


@register("lags", over_bars(sql_lags(rolling.LAGS)))
def _(spark, sf):
    return _frames(closes(spark, sf), lambda s: rolling.lags(X(), rolling.LAGS, s.w), 20).drop("close")


@register("lags_count", over_bars(sql_lags(range(1, 11))))
def _(spark, sf):
    """An int n asks for lags 1..n."""
    return _frames(closes(spark, sf), lambda s: rolling.lags(X(), 10, s.w), 10).drop("close")


@register("ma_partial", over_bars(sql_partial("avg", "ma", rolling.MEAN_WINDOWS)))
def _(spark, sf):
    df = _frames(closes(spark, sf), lambda s: rolling.rolling_mean(X(), rolling.MEAN_WINDOWS, s.w), 100)
    return rounded(df.drop("close"))


NB_WINDOWS = (3, 5, 10, 20, 50)


@register("ma_full", over_bars(sql_full("avg", "ma", NB_WINDOWS, 5)))
def _(spark, sf):
    df = _frames(closes(spark, sf), lambda s: rolling.rolling_mean(X(), NB_WINDOWS, s.w, None), 50)
    return rounded(df.drop("close"), 5)


@register("std_partial", over_bars(sql_partial("stddev_samp", "std", rolling.STD_WINDOWS)))
def _(spark, sf):
    df = _frames(closes(spark, sf), lambda s: rolling.rolling_std(X(), rolling.STD_WINDOWS, s.w), 50)
    return rounded(df.drop("close"))


@register("std_full", over_bars(sql_full("stddev_samp", "std", NB_WINDOWS)))
def _(spark, sf):
    df = _frames(closes(spark, sf), lambda s: rolling.rolling_std(X(), NB_WINDOWS, s.w, None), 50)
    return rounded(df.drop("close"))


def _stat(name, stats, sql, digits=4):
    @register(name, over_bars(sql))
    def _(spark, sf):
        df = _frames(
            closes(spark, sf), lambda s: rolling.rolling_stats(X(), rolling.STAT_WINDOWS, s.w, stats), 20
        )
        return rounded(df.drop("close"), digits)


_stat("roll_skew", ["skew"], sql_moment("skewness", "roll_skew", rolling.STAT_WINDOWS))
_stat("roll_kurt", ["kurt"], sql_moment("kurtosis", "roll_kurt", rolling.STAT_WINDOWS))
_stat("roll_minmax", ["min", "max"], sql_minmax(rolling.STAT_WINDOWS))


def sql_quantiles(ws) -> list[str]:
    out = []
    for n in ws:
        out += [f"{full(f'{s}(close)', n)} AS roll_{s}_{n}" for s in ("min", "max")]
        for s, q in (("median", 0.5), ("q25", 0.25), ("q75", 0.75)):
            out.append(r(full(f"quantile_cont(close, {q})", n), f"roll_{s}_{n}", 5))
    return out


NB_STATS = ("min", "max", "median", "q25", "q75")


@register("roll_quantiles", over_bars(sql_quantiles(rolling.STAT_WINDOWS)))
def _(spark, sf):
    df = _frames(
        closes(spark, sf),
        lambda s: rolling.rolling_stats(X(), rolling.STAT_WINDOWS, s.w, NB_STATS, None),
        20,
    )
    return rounded(df.drop("close"), 5)


def _cross(what):
    @register(f"ma_{what}", over_bars(sql_cross(what)))
    def _(spark, sf):
        df = _frames(closes(spark, sf), lambda s: rolling.ma_cross(X(), w=s.w), 50)
        cols = [c for c in df.columns if c.startswith(f"ma_{what}")]
        return rounded(df.select("ticker", "d", *cols), 4 if what == "diff" else 6)


_cross("diff")
_cross("ratio")

RSI_SQL = f"""{ROWS}, dl AS (SELECT *, close - lag(close) {W} AS delta FROM x),
gl AS (SELECT *, CASE WHEN delta > 0 THEN delta ELSE 0 END AS gain, CASE WHEN delta < 0 THEN -delta ELSE 0 END AS loss FROM dl)"""


def sql_rsi(ws) -> list[str]:
    out = []
    for n in ws:
        g, l = f"avg(gain) {prev(n)}", f"avg(loss) {prev(n)}"
        out.append(
            r(
                f"CASE WHEN rn > {n} THEN CASE WHEN {l} = 0 AND {g} > 0 THEN 100 ELSE 100 - 100 / (1 + {g} / NULLIF({l}, 0)) END END",
                f"rsi_{n}",
                6,
            )
        )
    return out


@register("rsi", f"WITH {RSI_SQL} SELECT ticker, d, {', '.join(sql_rsi((14, 30)))} FROM gl")
def _(spark, sf):
    laid = lay_out(closes(spark, sf), CUT, back=technical.rsi_back((14, 30)))
    return rounded(technical.rsi(laid, "close").close().drop("close"), 6)


def sql_bollinger(ws) -> list[str]:
    out = []
    for n in ws:
        m, s = full("avg(close)", n), full("stddev_samp(close)", n)
        out += [
            r(f"({m}) + 2 * ({s})", f"bb_upper_{n}"),
            r(f"({m}) - 2 * ({s})", f"bb_lower_{n}"),
            r(f"4 * ({s})", f"bb_width_{n}"),
        ]
    return out


@register("bollinger", over_bars(sql_bollinger((5, 10, 20))))
def _(spark, sf):
    df = _frames(closes(spark, sf), lambda s: technical.bollinger(X(), (5, 10, 20), s), 20)
    return rounded(df.drop("close"))


def ewm_ctes(source: str, x: str, spans: dict[str, int], tag: str) -> str:
    """Recursive fold of the numerators and denominators, one row at a time."""
    start = ", ".join(
        f"coalesce({x}, 0.0)::DOUBLE AS {n}_a, CASE WHEN {x} IS NULL THEN 0.0 ELSE 1.0 END::DOUBLE AS {n}_b" for n in spans
    )
    step = ", ".join(
        f"w.{n}_a * (1 - 2.0::DOUBLE / {s + 1}) + coalesce(s.{x}, 0.0), w.{n}_b * (1 - 2.0::DOUBLE / {s + 1}) + CASE WHEN s.{x} IS NULL THEN 0.0 ELSE 1.0 END"
        for n, s in spans.items()
    )
    means = ", ".join(f"{n}_a / NULLIF({n}_b, 0) AS {n}" for n in spans)
    return f"""{tag}_w AS (SELECT ticker, rn, {start} FROM {source} WHERE rn = 1
UNION ALL SELECT s.ticker, s.rn, {step} FROM {tag}_w w JOIN {source} s ON s.ticker = w.ticker AND s.rn = w.rn + 1),
{tag} AS (SELECT ticker, rn, {means} FROM {tag}_w)"""


@register(
    "ewm",
    f"""WITH RECURSIVE {GAPPY}, {ewm_ctes("g", "close", {"ewm_9": 9, "ewm_26": 26}, "e")}
SELECT ticker, d, {r("ewm_9", "ewm_9")}, {r("ewm_26", "ewm_26")} FROM e JOIN g USING (ticker, rn)""",
)
def _(spark, sf):
    """Exponential means of a series with missing days."""
    laid = lay_out(gappy(spark, sf), CUT, back=technical.ewm_back([9, 26]))
    out = technical.ewm(laid, "close", {"ewm_9": 9, "ewm_26": 26})
    return rounded(out.close().drop("close"))


MACD_CTES = f"""{ewm_ctes("x", "close", {"f12": 12, "s26": 26}, "e")},
mm AS (SELECT ticker, rn, lag(f12 - s26) OVER (PARTITION BY ticker ORDER BY rn) AS macd FROM e),
{ewm_ctes("mm", "macd", {"sig": 9}, "sg")},
md AS (SELECT mm.ticker, mm.rn, macd, lag(sig) OVER (PARTITION BY mm.ticker ORDER BY mm.rn) AS macd_signal FROM mm JOIN sg USING (ticker, rn))"""


@register(
    "macd",
    f"""WITH RECURSIVE {ROWS}, {MACD_CTES}
SELECT ticker, d, {r("macd", "macd")}, {r("macd_signal", "macd_signal")}, {r("macd - macd_signal", "macd_histogram")} FROM md JOIN x USING (ticker, rn)""",
)
def _(spark, sf):
    laid = lay_out(closes(spark, sf), CUT, back=technical.macd_back())
    return rounded(technical.macd(laid, "close").close().drop("close"))


@register("momentum", over_bars(sql_momentum((5, 10, 20))))
def _(spark, sf):
    df = _frames(closes(spark, sf), lambda s: rolling.momentum(X(), (5, 10, 20), s.w), 20)
    return rounded(df.drop("close"), 6)


MOM_NB = (1, 2, 3, 5, 10, 20)
_PADDED = f"""{GAPPY}, p AS (SELECT ticker, d, close, last_value(close IGNORE NULLS) OVER (PARTITION BY ticker ORDER BY d ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS c FROM g)"""


@register(
    "momentum_abs",
    f"""WITH {_PADDED} SELECT ticker, d, {', '.join(
        [r(f"c / NULLIF(lag(c, {k}) {W}, 0) - 1", f"momentum_{k}", 6) for k in MOM_NB]
        + [r(f"close - lag(close, {k}) {W}", f"momentum_abs_{k}") for k in MOM_NB]
    )} FROM p""",
)
def _(spark, sf):
    """Padded relative change and change in points on a series with missing days."""
    df = gappy(spark, sf).withColumn("c", X())
    out = _frames(
        df,
        lambda s: rolling.momentum(X(), MOM_NB, s.w, absolute=True, padded=F.col("c")),
        20,
        pad=("c",),
    )
    points = [f"momentum_abs_{k}" for k in MOM_NB]
    return rounded(rounded(out.drop("close", "c"), 6), 4, points)


@register("velocity_linear", over_bars(sql_velocity((5, 10, 20))))
def _(spark, sf):
    df = _frames(closes(spark, sf), lambda s: rolling.velocity(X(), (5, 10, 20), s.w, "diff"), 20)
    return rounded(df.drop("close"))


@register(
    "velocity_log",
    over_bars([r(f"(ln(close) - ln(lag(close, {k}) {W})) / {k}", f"velocidad_log_{k}", 6) for k in (5, 10, 20)]),
)
def _(spark, sf):
    df = _frames(closes(spark, sf), lambda s: rolling.velocity(X(), (5, 10, 20), s.w, "log"), 20)
    return rounded(df.drop("close"), 6)


@register(
    "velocity_pct",
    f"""WITH {_PADDED} SELECT ticker, d, {', '.join(r(f"(c / NULLIF(lag(c, {k}) {W}, 0) - 1) / {k}", f"velocidad_pct_{k}", 6) for k in (5, 10, 20))} FROM p""",
)
def _(spark, sf):
    df = gappy(spark, sf)
    out = _frames(df, lambda s: rolling.velocity(X(), (5, 10, 20), s.w, "pct"), 20, pad=("close",))
    return rounded(out.drop("close"), 6)


def _fit(name, method, ws, sql):
    @register(name, f"WITH {ROWS} SELECT ticker, d, {', '.join(sql)} FROM x")
    def _(spark, sf):
        df = _frames(
            closes(spark, sf), lambda s: rolling.velocity(X(), ws, s.w, method, s.pos), max(ws)
        )
        return rounded(df.drop("close"), 6 if method == "logslope" else 4)


_V = (3, 5, 10, 20)


def _centred(x: str, n: int) -> str:
    """Least-squares slope written out: sum of centred positions times values."""
    terms = " + ".join(
        f"({i} - {(n - 1) / 2}) * lag({x}, {n - 1 - i}) {W}" if i < n - 1 else f"({i} - {(n - 1) / 2}) * {x}"
        for i in range(n)
    )
    return f"({terms}) / {n * (n * n - 1) / 12.0}"


_fit("velocity_slope", "slope", _V, [r(f"CASE WHEN rn > {n} THEN {_centred('close', n)} END", f"velocidad_lineal_{n}") for n in _V])
_fit(
    "velocity_logslope",
    "logslope",
    _V,
    [r(f"CASE WHEN rn > {n} AND min(close) {last(n)} > 0 THEN {_centred('ln(close)', n)} END", f"velocidad_log_{n}", 6) for n in _V],
)


def _quad(n: int) -> str:
    """End-point derivative of a quadratic fit: slope plus curvature times (n - 1)."""
    u = [i - (n - 1) / 2 for i in range(n)]
    s2 = sum(v * v for v in u)
    s4 = sum(v**4 for v in u)
    scale = s4 - s2 * s2 / n
    terms = []
    for i, v in enumerate(u):
        weight = v / s2 + (n - 1) * (v * v - s2 / n) / scale
        value = "close" if i == n - 1 else f"lag(close, {n - 1 - i}) {W}"
        terms.append(f"({weight!r}::DOUBLE) * {value}")
    return " + ".join(terms)


_fit("velocity_quadratic", "quadratic", _V, [r(f"CASE WHEN rn > {n} THEN {_quad(n)} END", f"velocidad_polinomial_{n}") for n in _V])


@register("first_diff", over_bars([r(f"close - lag(close, 1) {W}", "target_diff"), r(f"close - lag(close, 5) {W}", "diff_5")]))
def _(spark, sf):
    df = _frames(
        closes(spark, sf),
        lambda s: {"target_diff": X() - F.lag(X(), 1).over(s.w), "diff_5": X() - F.lag(X(), 5).over(s.w)},
        5,
    )
    return rounded(df.drop("close"))


@register(
    "forward_target",
    f"""WITH {GAPPY}, f AS (SELECT ticker, d, close, lead(close, 30) {W} AS target_30 FROM g),
k AS (SELECT * FROM f WHERE target_30 IS NOT NULL), q AS (SELECT ticker, d, target_30, lag(close) {W} - target_30 AS diff_30 FROM k)
SELECT ticker, d, target_30, {r("diff_30", "diff_30")} FROM q WHERE diff_30 IS NOT NULL""",
)
def _(spark, sf):
    return rounded(features.forward_target(gappy(spark, sf), 30, "close", CUT).drop("close"))


@register(
    "daily_return",
    f"""WITH {_PADDED} SELECT ticker, d, {r(f"c / NULLIF(lag(c) {W}, 0) - 1", "daily_return", 6)} FROM p""",
)
def _(spark, sf):
    return rounded(returns.daily_return(gappy(spark, sf), "close", CUT).drop("close"), 6)


@register(
    "reconstruct_level",
    f"""WITH {ROWS}, f AS (SELECT ticker, d, rn, close, close - lag(close) {W} AS dif, coalesce(lag(close, 1) {W} - lag(close, 2) {W}, 0) AS pred FROM x),
b AS (SELECT ticker, arg_max(close, d) AS base FROM bars WHERE d < DATE '{TEST_START}' GROUP BY 1)
SELECT ticker, d, {r("base + sum(dif) OVER (PARTITION BY ticker ORDER BY d ROWS UNBOUNDED PRECEDING)", "actual", 3)},
{r("base + sum(pred) OVER (PARTITION BY ticker ORDER BY d ROWS UNBOUNDED PRECEDING)", "predicted", 3)} FROM f JOIN b USING (ticker) WHERE d >= DATE '{TEST_START}'""",
)
def _(spark, sf):
    """Levels from true and predicted differences after the training end."""
    df = closes(spark, sf)
    diffs = _frames(
        df,
        lambda s: {
            "dif": X() - F.lag(X(), 1).over(s.w),
            "pred": F.coalesce(F.lag(X(), 1).over(s.w) - F.lag(X(), 2).over(s.w), F.lit(0.0)),
        },
        2,
    )
    start = F.lit(TEST_START).cast("date")
    base = df.where(F.col("d") < start).groupBy("ticker").agg(F.max_by("close", "d").alias("base"))
    test = diffs.where(F.col("d") >= start)
    out = features.reconstruct_level(test, base, {"dif": "actual", "pred": "predicted"}, CUT)
    return rounded(out.select("ticker", "d", "actual", "predicted"), 3)


@register(
    "sequences",
    f"""WITH {ROWS}, f AS (SELECT ticker, d, rn, lag(close, 2) {W} AS x1, lag(close, 1) {W} AS x2, close AS y FROM x)
SELECT ticker, d, x1, x2, y FROM f WHERE rn > 2""",
)
def _(spark, sf):
    return sequences.flat_sequences(sequences.sequences(closes(spark, sf), ["close"], "close", 2, CUT), 2)


# ---- wide frames --------------------------------------------------------------


def library_sql_columns() -> list[str]:
    cols = sql_lags(rolling.LAGS) + sql_partial("avg", "ma", rolling.MEAN_WINDOWS)
    cols += sql_partial("stddev_samp", "std", rolling.STD_WINDOWS) + sql_minmax(rolling.STAT_WINDOWS)
    cols += sql_moment("skewness", "roll_skew", rolling.STAT_WINDOWS)
    cols += sql_moment("kurtosis", "roll_kurt", rolling.STAT_WINDOWS)
    cols += sql_cross("diff") + sql_cross("ratio")
    cols += [columns_sql(LIBRARY)]
    cols += sql_momentum((5, 10, 20)) + sql_velocity((5, 10, 20))
    cols += [r(f"close - lag(close) {W}", "target_diff")]
    return cols


LIB_CFG = FeatureConfig.library()
SIX = [f"ma_ratio_{s}_{n}" for s in (5, 10) for n in (20, 50)] + [f"momentum_{k}" for k in (5, 10, 20)]
SIX += [c for c in LIBRARY if c.startswith(("sin_", "cos_"))]


def round_library(df):
    names = [f for f, t in df.dtypes if t == "double" and f not in SIX]
    return rounded(rounded(df, 6, [c for c in SIX if c in df.columns]), 4, names)


FULL_SQL = f"WITH {BARS} SELECT ticker, d, close AS target, {', '.join(library_sql_columns())} FROM bars"


@register("full_features", FULL_SQL)
def _(spark, sf):
    return round_library(features.build_features(closes(spark, sf), LIB_CFG, layout=CUT))


@register("full_features_plain", FULL_SQL)
def _(spark, sf):
    """The same frame with uncut series, for inputs known to be short."""
    return round_library(
        features.build_features(closes(spark, sf), LIB_CFG, layout=Layout(mode="plain"))
    )


@register(
    "full_features_nations",
    FULL_SQL.replace(BARS, NATBARS).replace("FROM bars", "FROM natbars"),
)
def _(spark, sf):
    return round_library(features.build_features(natbars(spark, sf), LIB_CFG, layout=CUT))


@register(
    "full_features_one_series",
    FULL_SQL.replace(BARS, MKT).replace("FROM bars", "FROM mkt"),
)
def _(spark, sf):
    """One long series, which only the cut windows can spread over tasks."""
    df = mkt(spark, sf).select("ticker", "d", "close")
    return round_library(features.build_features(df, LIB_CFG, layout=Layout(rows=300)))


NB_CFG = FeatureConfig.notebook()


def notebook_sql() -> str:
    ws = rolling.STAT_WINDOWS
    base = sql_lags(rolling.LAGS) + sql_full("avg", "ma", NB_CFG.means, 5)
    base += sql_full("stddev_samp", "std", NB_CFG.stds) + sql_quantiles(ws)
    base += sql_rsi((14, 30)) + sql_bollinger(NB_CFG.shorts)
    md = [r("macd", "macd"), r("macd_signal", "macd_signal"), r("macd - macd_signal", "macd_histogram")]
    # Frames see all rows; the first 50 are cut afterwards.
    return f"""WITH RECURSIVE {RSI_SQL}, {MACD_CTES}, f AS (SELECT ticker, d, rn, close AS target, {', '.join(base)} FROM gl)
SELECT f.* EXCLUDE (rn), {', '.join(md)} FROM f JOIN md USING (ticker, rn) WHERE f.rn > 50"""


@register("full_features_nb", notebook_sql())
def _(spark, sf):
    out = features.build_features(closes(spark, sf), NB_CFG, layout=CUT, target_diff=False)
    five = [c for c in out.columns if c.startswith(("ma_", "roll_"))]
    six = [c for c in out.columns if c.startswith("rsi_")]
    rest = [f for f, t in out.dtypes if t == "double" and f not in {*five, *six}]
    return rounded(rounded(rounded(out, 5, five), 6, six), 4, rest)


LEAK_COLS = re.findall(r'AS "?([^\W\d]\w*)"?(?:,|$)', ", ".join(library_sql_columns()))
# Unrounded, so that the correlations can be compared to six digits.
_EXACT = [re.sub(r"ROUND\((.*?) \+ [0-9.e-]+, \d+\) \+ 0\.0 AS", r"(\1) AS", c, flags=re.S) for c in library_sql_columns()]


@register(
    "leakage_corr",
    f"""WITH {ROWS}, f AS (SELECT ticker, d, lead(close) {W} AS nxt, {', '.join(_EXACT)} FROM x)
SELECT * FROM ({' UNION ALL '.join(f"SELECT ticker, '{c}' AS feature, {rnd(f"corr(CAST({c} AS DOUBLE), nxt)", 6)} AS future_corr FROM f GROUP BY 1" for c in LEAK_COLS)})
WHERE future_corr IS NOT NULL AND NOT isnan(future_corr)""",
)
def _(spark, sf):
    df = features.build_features(closes(spark, sf), LIB_CFG, layout=CUT, ahead=1)
    return rounded(quality.leakage_corr(df, LEAK_COLS, layout=CUT, per_series=True), 6)


_RECHECK = [f"lag_{k}" for k in rolling.LAGS] + [f"ma_{n}" for n in rolling.MEAN_WINDOWS]


@register(
    "leakage_recheck",
    f"""WITH {ROWS}, f AS (SELECT ticker, rn, close, {', '.join(sql_lags(rolling.LAGS) + sql_partial("avg", "ma", rolling.MEAN_WINDOWS, 9))} FROM x)
{' UNION ALL '.join(
    [f"SELECT 'lag_{k}' AS feature, count(*) FILTER (abs(f.lag_{k} - p.close) >= 1e-6 OR (f.lag_{k} IS NULL) <> (p.close IS NULL)) AS violations FROM f LEFT JOIN x p ON p.ticker = f.ticker AND p.rn = f.rn - {k}" for k in rolling.LAGS]
    + [f"SELECT 'ma_{n}', count(*) FILTER ((f.ma_{n} IS NULL) <> (m.v IS NULL) OR abs(f.ma_{n} - m.v) >= 1e-6) FROM f LEFT JOIN (SELECT a.ticker, a.rn, avg(b.close) AS v FROM x a JOIN x b ON b.ticker = a.ticker AND b.rn >= a.rn - {n} AND b.rn < a.rn GROUP BY 1, 2) m ON m.ticker = f.ticker AND m.rn = f.rn" for n in rolling.MEAN_WINDOWS])}""",
)
def _(spark, sf):
    """All rows of every lag and mean, recomputed another way: no row may disagree."""
    df = features.build_features(closes(spark, sf), LIB_CFG, layout=CUT, keep_pos=True)
    return quality.leakage_recheck(df, rolling.LAGS, rolling.MEAN_WINDOWS, layout=CUT)


# ---- model-ready datasets -----------------------------------------------------------

ML_CFG = FeatureConfig.library()


@register(
    "ml_dataset",
    f"""WITH {BARS}, f AS (SELECT ticker, d, close AS label, {', '.join(library_sql_columns()[:-1])} FROM bars),
c AS (SELECT * FROM f WHERE momentum_20 IS NOT NULL AND ma_ratio_5_50 IS NOT NULL AND std_5 IS NOT NULL AND roll_kurt_5 IS NOT NULL)
SELECT *, 'train' AS split FROM c WHERE d BETWEEN DATE '{TRAIN[0]}' AND DATE '{TRAIN[1]}' UNION ALL SELECT *, 'test' FROM c WHERE d >= DATE '{TEST_START}'""",
)
def _(spark, sf):
    df = datasets.ml_dataset(closes(spark, sf), *TRAIN, TEST_START, cfg=ML_CFG, layout=CUT)
    return round_library(df)


def ml_sql(label: str) -> str:
    """The library features with another label; complete rows, split by dates."""
    return f"""WITH {BARS}, f AS (SELECT ticker, d, {label} AS label, {', '.join(library_sql_columns()[:-1])} FROM bars),
c AS (SELECT * FROM f WHERE label IS NOT NULL AND momentum_20 IS NOT NULL AND ma_ratio_5_50 IS NOT NULL AND std_5 IS NOT NULL AND roll_kurt_5 IS NOT NULL)
SELECT *, 'train' AS split FROM c WHERE d BETWEEN DATE '{TRAIN[0]}' AND DATE '{TRAIN[1]}' UNION ALL SELECT *, 'test' FROM c WHERE d >= DATE '{TEST_START}'"""


@register("ml_dataset_diff", ml_sql(rnd(f"close - lag(close) {W}")))
def _(spark, sf):
    df = datasets.ml_dataset(
        closes(spark, sf), *TRAIN, TEST_START, target="diff", cfg=ML_CFG, layout=CUT
    )
    return rounded(round_library(df), 4, ["label"])


@register("ml_dataset_h30", ml_sql(f"lead(close, 30) {W}"))
def _(spark, sf):
    df = datasets.ml_dataset(
        closes(spark, sf), *TRAIN, TEST_START, target="h30", cfg=ML_CFG, layout=CUT
    )
    return round_library(df)


@register(
    "additive_input",
    f"""WITH {BARS} SELECT ticker, d::TIMESTAMP AS ds, close AS y, {', '.join(f"CAST(d BETWEEN DATE '{a}' AND DATE '{b}' AS INTEGER) AS event_{i}" for i, (a, b) in enumerate(EVENTS, 1))} FROM bars""",
)
def _(spark, sf):
    return datasets.additive_input(closes(spark, sf), EVENTS)


@register(
    "sequence_dataset",
    f"""WITH {ROWS}, v AS (SELECT x.*, volume FROM x JOIN bars USING (ticker, d)), s AS (SELECT ticker, min(close) AS lo, max(close) AS hi, min(volume) AS vlo, max(volume) AS vhi FROM bars GROUP BY 1),
z AS (SELECT ticker, d, rn, n, (close - lo) / CASE WHEN hi = lo THEN 1 ELSE hi - lo END AS y, (volume - vlo) / CASE WHEN vhi = vlo THEN 1.0 ELSE vhi - vlo END AS v FROM v JOIN s USING (ticker))
SELECT ticker, d, {r("lag(v, 3) " + W, "x1", 6)}, {r("lag(v, 2) " + W, "x2", 6)}, {r("lag(v, 1) " + W, "x3", 6)}, {r("y", "y", 6)},
CASE WHEN rn - 1 - 3 < floor((n - 3) * 0.8) THEN 'train' ELSE 'test' END AS split FROM z QUALIFY rn > 3""",
)
def _(spark, sf):
    df = bars(spark, sf).select("ticker", "d", "volume", "close")
    seq = sequences.sequence_dataset(df, 3, 0.8, layout=CUT)
    return rounded(sequences.flat_sequences(seq, 3), 6)


_EVENT = "OVER (PARTITION BY event_type ORDER BY ts, event_id)"


@register(
    "busy_ticks",
    f"""SELECT event_type AS ticker, ts, event_id, row_number() {_EVENT} - 1 AS pos, {r(f"lag(value, 3) {_EVENT}", "lag_3")},
 {r(f"avg(value) OVER (PARTITION BY event_type ORDER BY ts, event_id ROWS BETWEEN 20 PRECEDING AND 1 PRECEDING)", "ma_20")} FROM events""",
)
def _(spark, sf):
    """Positions, a lag and a mean of raw ticks, with slices of at most 500 rows."""
    layout = Layout(ts="ts", tie=("event_id",), rows=1000, slice_days=1024, slice_rows=500)
    df = table(spark, sf, "events").select(F.col("event_type").alias("ticker"), "ts", "event_id", "value")
    laid = lay_out(df, layout, back=20)
    x = F.col("value")
    cols = rolling.lags(x, (3,), laid.w) | rolling.rolling_mean(x, (20,), laid.w)
    out = laid.with_columns(cols).close(keep_pos=True).withColumnRenamed(POS, "pos")
    return rounded(out.drop("value"))


@register(
    "ticks_features",
    f"""WITH {TICKS} SELECT ticker, h, {', '.join(
        [f"lag(close, {k}) OVER (PARTITION BY ticker ORDER BY h) AS lag_{k}" for k in (1, 24)]
        + [r(f"avg(close) {prev(24, 'h')}", "ma_24", 6), r(f"stddev_samp(close) {prev(24, 'h')}", "std_24", 6)]
    )} FROM ticks""",
)
def _(spark, sf):
    """Hourly series: the same columns on a timestamp order."""
    hourly = Layout(ts="h", rows=200)
    df = frame_features(
        ticks(spark, sf).drop("n"),
        lambda s: rolling.lags(X(), (1, 24), s.w)
        | rolling.rolling_mean(X(), [24], s.w)
        | rolling.rolling_std(X(), [24], s.w),
        24,
        hourly,
    )
    return rounded(df.drop("close"), 6, ["ma_24", "std_24"])
