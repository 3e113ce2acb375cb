"""Decomposition, autocorrelation and stationarity queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from seriesloom.catalog.base import CUT, ROWS, W, closes, mkt, r, register, rounded
from seriesloom.operators import autocorr, datasets
from seriesloom.operators.decomposition import decompose
from seriesloom.operators.stationarity import adf_test, stationarity_report
from seriesloom.plans.groupstats import attach
from seriesloom.plans.layout import with_positions

PERIOD = 252
_H = PERIOD // 2
DECOMP = f"""{ROWS}, t AS (SELECT *, CASE WHEN rn > {_H} AND rn <= n - {_H} THEN
 (sum(close) OVER (PARTITION BY ticker ORDER BY d ROWS BETWEEN {_H - 1} PRECEDING AND {_H - 1} FOLLOWING)
  + (lag(close, {_H}) {W} + lead(close, {_H}) {W}) / 2) / {PERIOD} END AS trend FROM x),
ph AS (SELECT ticker, (rn - 1) % {PERIOD} AS phase, avg(close - trend) AS m FROM t GROUP BY 1, 2),
se AS (SELECT ticker, phase, m - avg(m) OVER (PARTITION BY ticker) AS seasonal FROM ph),
dc AS (SELECT t.ticker, d, close, CASE WHEN n >= {2 * PERIOD} THEN trend END AS trend,
 CASE WHEN n >= {2 * PERIOD} THEN seasonal END AS seasonal FROM t JOIN se ON se.ticker = t.ticker AND se.phase = (rn - 1) % {PERIOD})"""


def _decomposed(name: str, sql: str):
    @register(f"decompose_{name}", f"WITH {DECOMP} SELECT ticker, d, {sql} FROM dc")
    def _(spark, sf):
        out = decompose(closes(spark, sf), PERIOD, layout=CUT)
        return rounded(out.select("ticker", "d", name))


_decomposed("trend", r("trend", "trend"))
_decomposed("seasonal", r("seasonal", "seasonal"))
_decomposed("resid", r("close - trend - seasonal", "resid"))


@register(
    "decompose_multiplicative",
    f"""WITH {DECOMP.replace("avg(close - trend)", "avg(close / trend)").replace("m - avg(m)", "m / avg(m)")}
SELECT ticker, d, {r("trend", "trend")}, {r("seasonal", "seasonal", 6)}, {r("close / (trend * seasonal)", "resid", 6)} FROM dc""",
)
def _(spark, sf):
    out = decompose(closes(spark, sf), PERIOD, "multiplicative", layout=CUT).drop("close")
    return rounded(rounded(out, 4, ["trend"]), 6, ["seasonal", "resid"])


_K = 20


@register(
    "acf",
    f"""WITH {ROWS}, c AS (SELECT ticker, rn, n, close - avg(close) OVER (PARTITION BY ticker) AS c FROM x), k AS (SELECT unnest(range(0, {_K + 1})) AS k),
s AS (SELECT a.ticker, k, any_value(a.n) AS n, sum(a.c * b.c) AS s FROM c a JOIN k ON true JOIN c b ON b.ticker = a.ticker AND b.rn = a.rn - k GROUP BY 1, 2)
SELECT ticker, CAST(k AS INTEGER) AS lag, {r("s / first_value(s) OVER (PARTITION BY ticker ORDER BY k)", "acf", 6)}, {r("1.959963984540054 / sqrt(n)", "band", 6)} FROM s""",
)
def _(spark, sf):
    return rounded(autocorr.acf(closes(spark, sf), _K, layout=CUT), 6)


def _levinson(k: int, divisor: str) -> str:
    """SQL of the partial autocorrelations ``phi`` of lags 0..k, one lag after another."""
    return f"""WITH RECURSIVE {ROWS}, c AS (SELECT ticker, rn, n, close - avg(close) OVER (PARTITION BY ticker) AS c FROM x),
k AS (SELECT unnest(range(0, {k + 1})) AS k),
s AS (SELECT a.ticker, k, any_value(a.n) AS n, sum(a.c * b.c) / {divisor} AS s FROM c a JOIN k ON true JOIN c b ON b.ticker = a.ticker AND b.rn = a.rn - k GROUP BY 1, 2),
q AS (SELECT *, s / first_value(s) OVER (PARTITION BY ticker ORDER BY k) AS q FROM s),
ac AS (SELECT ticker, any_value(n) AS n, list(q ORDER BY k) AS q FROM q GROUP BY 1),
lev AS (SELECT ticker, n, q, 0 AS k, CAST([] AS DOUBLE[]) AS coef, CAST(1 AS DOUBLE) AS err, CAST(1 AS DOUBLE) AS phi FROM ac
UNION ALL SELECT ticker, n, q, k + 1, list_append(list_transform(range(1, k + 1), lambda j: coef[j] - p * coef[k + 1 - j]), p), err * (1 - p * p), p
FROM (SELECT *, (q[k + 2] - coalesce(list_sum(list_transform(range(1, k + 1), lambda j: coef[j] * q[k + 2 - j])), 0)) / err AS p FROM lev WHERE k < {k}))"""


_BAND = "1.959963984540054 / sqrt(n)"


@register(
    "pacf",
    f"""{_levinson(_K, "any_value(a.n)")} SELECT ticker, CAST(k AS INTEGER) AS lag, {r("phi", "pacf", 6)}, {r(_BAND, "band", 6)} FROM lev""",
)
def _(spark, sf):
    return rounded(autocorr.pacf(closes(spark, sf), _K, layout=CUT), 6)


@register(
    "pacf_order",
    f"""{_levinson(25, "(any_value(a.n) - k)")} SELECT ticker,
coalesce(string_agg(CAST(k AS VARCHAR), ',' ORDER BY k) FILTER (WHERE k > 0 AND abs(phi) > {_BAND}), '') AS significant_lags,
coalesce(max(CAST(k AS INTEGER)) FILTER (WHERE k > 0 AND abs(phi) > {_BAND}), 0) AS ar_order FROM lev GROUP BY 1""",
)
def _(spark, sf):
    out = autocorr.suggest_ar_order(closes(spark, sf), 25, layout=CUT)
    lags = F.array_join(F.col("significant_lags").cast("array<string>"), ",")
    return out.withColumn("significant_lags", lags)


@register("adf_test")
def _(spark, sf):
    return adf_test(closes(spark, sf).unionByName(mkt(spark, sf).drop("volume")), layout=CUT)


@register(
    "adf_test_plain",
    f"""WITH {ROWS}, l AS (SELECT ticker, n, lag(close) {W} AS p, close - lag(close) {W} AS dy FROM x),
g AS (SELECT ticker, any_value(n) AS n_rows, count(dy) AS n_obs, regr_slope(dy, p) AS b, regr_sxx(dy, p) AS sxx,
 regr_syy(dy, p) - regr_sxy(dy, p) * regr_sxy(dy, p) / regr_sxx(dy, p) AS ssr FROM l WHERE p IS NOT NULL GROUP BY 1)
SELECT ticker, n_rows, {r("b / sqrt(ssr / (n_obs - 2) / sxx)", "statistic", 6)}, CAST(0 AS INTEGER) AS used_lag, n_obs,
 {r("-2.86154 - 2.8903 / n_obs - 4.234 / n_obs ** 2 - 40.040 / n_obs ** 3", "crit_5", 6)} FROM g""",
)
def _(spark, sf):
    """The unit-root test without lagged differences."""
    out = adf_test(closes(spark, sf), 0, layout=CUT)
    return rounded(out.select("ticker", "n_rows", "statistic", "used_lag", "n_obs", "crit_5"), 6)


@register("stationarize")
def _(spark, sf):
    """Input of the autoregressive models: a start date, then differencing where needed."""
    df = closes(spark, sf).unionByName(running_total(spark, sf))
    return datasets.arima_input(df, "1996-01-01", layout=CUT)


@register("stationarity_report")
def _(spark, sf):
    """Both tests of the autoregressive models' input: before and after differencing."""
    df = closes(spark, sf).unionByName(running_total(spark, sf))
    return stationarity_report(df, "1996-01-01", layout=CUT)


def running_total(spark, sf):
    """Cumulated centred closes of one segment: a series that needs differencing."""
    df = closes(spark, sf).where(F.col("ticker") == "BUILDING")
    mean = df.groupBy("ticker").agg(F.avg("close").alias("m"))
    centred = attach(df, mean, ["ticker"]).withColumn("c", F.col("close") - F.col("m"))
    summed = with_positions(centred, CUT, running={"total": F.col("c")})
    return summed.select(F.lit("BUILDING_SUM").alias("ticker"), "d", F.col("total").alias("close"))
