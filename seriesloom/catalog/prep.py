"""Sources, filters, joins, aggregates, sorts and general preparation."""

from __future__ import annotations

import uuid
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from seriesloom.catalog.base import (
    BARS,
    CUT,
    EVENTS,
    GAPPY,
    ROWS,
    TEST_START,
    TRAIN,
    W,
    bars,
    closes,
    gappy,
    r,
    register,
    rnd,
    rounded,
    table,
)
from seriesloom.functions.rolling import lags, rolling_mean
from seriesloom.operators import filters, joins, ledger, metrics, profiling, quality, returns, scaling
from seriesloom.operators.features import forward_target
from seriesloom.plans.layout import POS, lay_out, with_positions
from seriesloom.session import ensure_checkpoint_dir
from seriesloom.sources import bars as bar_source
from seriesloom.sources import readers, sinks, snapshots


def scratch(spark: SparkSession) -> str:
    """A new folder for one round trip, below the shared folder that the cluster names."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{uuid.uuid4()}"


# ---- sources and sinks -------------------------------------------------------


@register(
    "ohlcv_bars",
    f"WITH {BARS} SELECT ticker, d, open, high, low, close, volume FROM bars",
)
def _(spark, sf):
    return bars(spark, sf)


@register(
    "trailing_period",
    f"""WITH {BARS}, m AS (SELECT ticker, max(d) AS last_d FROM bars GROUP BY 1)
SELECT b.ticker, b.d, b.close FROM bars b JOIN m USING (ticker)
WHERE b.d >= m.last_d - INTERVAL 1 YEAR""",
)
def _(spark, sf):
    return bar_source.trailing_period(closes(spark, sf), "1y")


@register(
    "load_series",
    "SELECT o_orderdate AS \"Date\", o_totalprice AS \"Close\", o_orderkey AS id FROM orders",
)
def _(spark, sf):
    """Saved history in a parquet file whose time column is named by the index."""
    df = readers.load_series(spark, f"{sf}/orders.parquet", index="o_orderdate")
    return df.select("Date", F.col("o_totalprice").alias("Close"), F.col("o_orderkey").alias("id"))


@register(
    "latest_snapshot",
    """WITH f AS (SELECT user_id, event_type || '/' || CAST(event_id AS VARCHAR) AS key, ts AS modified FROM events),
a AS (SELECT user_id, key, modified, key LIKE 'p%' AS own FROM f),
k AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY own DESC, modified DESC, key) AS rn FROM a)
SELECT user_id, key, modified FROM k WHERE rn = 1""",
)
def _(spark, sf):
    """Newest object per owner, preferring keys that begin with the wanted name."""
    files = table(spark, sf, "events").select(
        "user_id",
        F.concat_ws("/", "event_type", F.col("event_id").cast("string")).alias("key"),
        F.col("ts").alias("modified"),
    )
    wanted = files.where(F.col("key").startswith("p"))
    own = snapshots.latest_snapshot(wanted, by=["user_id"]).withColumn("pref", F.lit(0))
    other = snapshots.latest_snapshot(files, by=["user_id"]).withColumn("pref", F.lit(1))
    return profiling.dedupe_key(own.unionByName(other), ["user_id"], ["pref"]).drop("pref")


@register(
    "latest_snapshot_ticker",
    """WITH f AS (SELECT user_id, 'x/' || replace(event_type, 'error', 'error_') || '_' || CAST(event_id AS VARCHAR) AS key, ts AS modified FROM events),
k AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY starts_with(key, 'x/signup_') DESC, modified DESC, key) AS rn FROM f)
SELECT user_id, key, modified FROM k WHERE rn = 1""",
)
def _(spark, sf):
    files = table(spark, sf, "events").select(
        "user_id",
        F.concat(
            F.lit("x/"),
            F.replace("event_type", F.lit("error"), F.lit("error_")),
            F.lit("_"),
            F.col("event_id").cast("string"),
        ).alias("key"),
        F.col("ts").alias("modified"),
    )
    return snapshots.latest_snapshot(files, "x/", ticker="SIGNUP", by=["user_id"])


@register(
    "latest_by_suffix",
    """WITH f AS (SELECT 'm/' || CAST(event_id AS VARCHAR) || '_' || event_type AS key, ts AS modified FROM events)
SELECT key, modified FROM f WHERE key LIKE 'm/%' AND key LIKE '%\\_purchase' ESCAPE '\\'
ORDER BY modified DESC, key LIMIT 1""",
)
def _(spark, sf):
    files = table(spark, sf, "events").select(
        F.concat(F.lit("m/"), F.col("event_id").cast("string"), F.lit("_"), F.col("event_type")).alias("key"),
        F.col("ts").alias("modified"),
    )
    return snapshots.latest_snapshot(files, "m/", suffix="_purchase")


@register(
    "load_monthly_csv",
    """SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS "Date", max(o_totalprice) AS "Price"
FROM orders GROUP BY 1""",
)
def _(spark, sf):
    """Monthly prices written as CSV and loaded again."""
    monthly = (
        table(spark, sf, "orders")
        .groupBy(F.trunc("o_orderdate", "month").alias("Date"))
        .agg(F.max("o_totalprice").alias("Price"))
    )
    path = f"{scratch(spark)}/monthly"
    sinks.write_csv(monthly, path)
    return readers.load_monthly_csv(spark, path)


MONTHLY_SQL = """p AS (SELECT ticker, d, last_value(close IGNORE NULLS) OVER (PARTITION BY ticker ORDER BY d ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS c FROM bars),
q AS (SELECT ticker, d, c / NULLIF(lag(c) OVER (PARTITION BY ticker ORDER BY d), 0) AS g FROM p),
m AS (SELECT ticker, last_day(d) AS month_end, product(g) AS g FROM q GROUP BY 1, 2),
s AS (SELECT ticker, last_day(CAST(unnest(generate_series(date_trunc('month', min(month_end)), date_trunc('month', max(month_end)), INTERVAL 1 MONTH)) AS DATE)) AS month_end FROM m GROUP BY ticker)"""


@register(
    "monthly_returns",
    f"""WITH {BARS}, {MONTHLY_SQL}
SELECT ticker, month_end, {rnd("coalesce(g, 1.0) - 1", 6)} AS monthly_return FROM s LEFT JOIN m USING (ticker, month_end)""",
)
def _(spark, sf):
    return rounded(returns.monthly_returns(closes(spark, sf)), 6)


@register(
    "raw_and_agg_sink",
    f"""WITH {BARS}, {MONTHLY_SQL}, a AS (SELECT ticker, month_end, coalesce(g, 1.0) - 1 AS x FROM s LEFT JOIN m USING (ticker, month_end))
SELECT 'raw' AS part, ticker, count(*) AS n_rows, max(close) AS largest FROM bars GROUP BY 2
UNION ALL SELECT 'agg', ticker, count(*), ROUND(max(x), 4) FROM a GROUP BY 2""",
)
def _(spark, sf):
    """Daily bars and monthly returns written, then read back and summarised."""
    folder = scratch(spark)
    sinks.write_raw_and_agg(bars(spark, sf), f"{folder}/raw", f"{folder}/agg")
    raw = spark.read.parquet(f"{folder}/raw").groupBy("ticker").agg(
        F.count(F.lit(1)).alias("n_rows"), F.max("close").alias("largest")
    )
    agg = spark.read.parquet(f"{folder}/agg").groupBy("ticker").agg(
        F.count(F.lit(1)).alias("n_rows"), F.round(F.max("monthly_return"), 4).alias("largest")
    )
    return raw.withColumn("part", F.lit("raw")).unionByName(agg.withColumn("part", F.lit("agg")))


@register(
    "csv_sink",
    f"""WITH {BARS} SELECT d AS "Date", ticker, close AS "Close", volume AS "Volume" FROM bars""",
)
def _(spark, sf):
    path = sinks.snapshot_path(f"{scratch(spark)}/stock_data", "ALL", datetime(2024, 1, 2, 3, 4, 5))
    out = bars(spark, sf).select(
        F.col("d").alias("Date"), "ticker", F.col("close").alias("Close"), F.col("volume").alias("Volume")
    )
    sinks.write_csv(out, path)
    schema = "Date string, ticker string, Close double, Volume bigint"
    back = readers.load_series(spark, path, T._parse_datatype_string(schema))
    return back.withColumn("Date", F.to_date("Date"))


# Three simple forecasts of every test day; the third model skips Mondays.
FORECAST_SQL = f"""{ROWS},
f0 AS (SELECT ticker, d, rn, close AS y, lag(close) {W} AS naive,
  avg(close) OVER (PARTITION BY ticker ORDER BY d ROWS BETWEEN 5 PRECEDING AND 1 PRECEDING) AS mean5,
  max(close) OVER (PARTITION BY ticker ORDER BY d ROWS BETWEEN 5 PRECEDING AND 1 PRECEDING) AS peak5 FROM x),
f1 AS (SELECT *, row_number() OVER (PARTITION BY ticker ORDER BY d) AS step FROM f0 WHERE d >= DATE '{TEST_START}'),
fc AS (SELECT ticker, 'naive' AS model, step, d, y, naive AS yhat, naive - 1 AS lower, naive + 1 AS upper FROM f1
UNION ALL SELECT ticker, 'mean5', step, d, y, mean5, mean5 - 1, mean5 + 1 FROM f1
UNION ALL SELECT ticker, 'peak5', step, d, y, peak5, peak5 - 1, peak5 + 1 FROM f1 WHERE isodow(d) <> 1)"""


def simple_forecasts(spark: SparkSession, sf: str) -> DataFrame:
    """Long forecast table of three naive models over the test days."""
    laid = lay_out(closes(spark, sf), CUT, back=5)
    f = laid.w.rowsBetween(-5, -1)
    wide = laid.with_columns(
        {
            "naive": F.lag("close", 1).over(laid.w),
            "mean5": F.avg("close").over(f),
            "peak5": F.max("close").over(f),
        }
    ).close()
    test = filters.between_ts(wide, TEST_START, None)
    placed = with_positions(test, CUT)
    models = F.array(
        *(
            F.struct(F.lit(m).alias("model"), F.col(m).alias("yhat"))
            for m in ("naive", "mean5", "peak5")
        )
    )
    long = placed.select(
        "ticker",
        "d",
        (F.col(POS) + 1).alias("step"),
        F.col("close").alias("y"),
        F.explode(models).alias("m"),
    ).select("ticker", "m.model", "step", "d", "y", "m.yhat")
    return long.where((F.col("model") != "peak5") | (F.weekday("d") != 0)).withColumns(
        {"lower": F.col("yhat") - 1, "upper": F.col("yhat") + 1}
    )


@register(
    "predictions_wide",
    f"""WITH {FORECAST_SQL}
SELECT ticker, d, {r("max(yhat) FILTER (model = 'naive')", "naive_prediction")},
{r("max(yhat) FILTER (model = 'mean5')", "mean5_prediction")}, {r("max(lower) FILTER (model = 'mean5')", "mean5_lower")},
{r("max(upper) FILTER (model = 'mean5')", "mean5_upper")}, {r("max(yhat) FILTER (model = 'peak5')", "peak5_prediction")}
FROM fc GROUP BY 1, 2""",
)
def _(spark, sf):
    fc = simple_forecasts(spark, sf)
    return rounded(sinks.predictions_wide(fc, ["naive", "mean5", "peak5"], bounds=["mean5"]))


# ---- filters and projections ---------------------------------------------------


@register(
    "date_range_filter",
    """SELECT event_id, ts, value FROM events
WHERE ts >= TIMESTAMP '2024-01-05' AND ts <= TIMESTAMP '2024-01-20'""",
)
def _(spark, sf):
    df = table(spark, sf, "events").select("event_id", "ts", "value")
    return filters.between_ts(df, "2024-01-05", "2024-01-20", "ts")


@register(
    "start_filter",
    "SELECT o_orderkey, o_orderdate, o_totalprice FROM orders WHERE o_orderdate >= TIMESTAMP '2000-01-01'",
)
def _(spark, sf):
    df = table(spark, sf, "orders").select("o_orderkey", "o_orderdate", "o_totalprice")
    return filters.between_ts(df, "2000-01-01", None, "o_orderdate")


@register(
    "day_slice",
    """SELECT event_id, ts, value FROM events
WHERE ts >= TIMESTAMP '2024-01-05' AND ts < TIMESTAMP '2024-01-21'""",
)
def _(spark, sf):
    df = table(spark, sf, "events").select("event_id", "ts", "value")
    return filters.day_slice(df, "2024-01-05", "2024-01-20", "ts")


@register(
    "train_test_dates",
    f"""WITH {BARS} SELECT ticker, d, close, 'train' AS split FROM bars WHERE d BETWEEN DATE '1996-01-01' AND DATE '2000-01-03'
UNION ALL SELECT ticker, d, close, 'test' FROM bars WHERE d >= DATE '2000-01-03'""",
)
def _(spark, sf):
    return filters.split_dates(closes(spark, sf), "1996-01-01", "2000-01-03", "2000-01-03")


@register(
    "train_test_ratio",
    f"WITH {ROWS} SELECT ticker, d, close, CASE WHEN rn - 1 < floor(n * 0.8) THEN 'train' ELSE 'test' END AS split FROM x",
)
def _(spark, sf):
    return filters.split_ratio(closes(spark, sf), 0.8, CUT)


@register(
    "complete_cases",
    f"""WITH {GAPPY}, f AS (SELECT ticker, d, close, lag(close, 1) {W} AS lag_1, lag(close, 2) {W} AS lag_2, lag(close, 3) {W} AS lag_3 FROM g)
SELECT * FROM f WHERE close IS NOT NULL AND lag_1 IS NOT NULL AND lag_2 IS NOT NULL AND lag_3 IS NOT NULL""",
)
def _(spark, sf):
    laid = lay_out(gappy(spark, sf), CUT, back=3)
    cols = lags(F.col("close"), 3, laid.w)
    return filters.complete_cases(laid.with_columns(cols).close(), ["close", *cols])


@register(
    "warmup_trim",
    f"""WITH {ROWS}, f AS (SELECT ticker, d, rn, close, lag(close, 5) {W} AS lag_5 FROM x),
t AS (SELECT ticker, bool_or(lag_5 IS NULL) AS has_null FROM f GROUP BY 1)
SELECT ticker, d, close, lag_5 FROM f JOIN t USING (ticker) WHERE rn > 20 OR NOT has_null""",
)
def _(spark, sf):
    laid = lay_out(closes(spark, sf), CUT, back=5)
    df = laid.with_columns(lags(F.col("close"), [5], laid.w)).close(keep_pos=True)
    return filters.warmup_trim(df, 20, ["lag_5"], CUT)


@register(
    "feature_target_split",
    f"""WITH {BARS} SELECT ticker, d, open, high, low, volume, close AS label FROM bars""",
)
def _(spark, sf):
    return filters.features_target(bars(spark, sf), "close", ["close"])


@register(
    "cast_features",
    f"""WITH {BARS} SELECT ticker, d, CAST(volume AS DOUBLE) AS volume, CAST(close > open AS INTEGER)::DOUBLE AS up FROM bars""",
)
def _(spark, sf):
    df = bars(spark, sf).select("ticker", "d", "volume", (F.col("close") > F.col("open")).alias("up"))
    return filters.cast_features(df, ["volume", "up"])


@register(
    "drop_duplicate_columns",
    f"""WITH {BARS} SELECT ticker, d, close, (isodow(d) = 1) AS es_lunes, CAST(isodow(d) - 1 AS BIGINT) AS dow, volume FROM bars""",
)
def _(spark, sf):
    monday = F.weekday("d") == 0
    df = bars(spark, sf).select(
        "ticker",
        "d",
        "close",
        monday.alias("es_lunes"),
        F.weekday("d").cast("bigint").alias("dow"),
        "volume",
        monday.cast("int").alias("es_lunes_trading"),
        F.col("close").alias("close_again"),
        monday.cast("double").alias("monday_float"),
    )
    return filters.drop_duplicate_columns(df, ["ticker", "d"])


@register(
    "window_predictions",
    f"""WITH {FORECAST_SQL}, k AS (SELECT ticker, d, yhat, row_number() OVER (PARTITION BY ticker ORDER BY d) AS rn
FROM fc WHERE model = 'naive' AND d BETWEEN DATE '2000-02-01' AND DATE '2000-06-30')
SELECT ticker, d, yhat FROM k WHERE rn <= 40""",
)
def _(spark, sf):
    fc = simple_forecasts(spark, sf).where(F.col("model") == "naive").select("ticker", "d", "yhat")
    return filters.window_predictions(fc, "2000-02-01", "2000-06-30", 40, CUT)


# ---- joins -----------------------------------------------------------------------


@register(
    "join_forecast_feature",
    f"""WITH {FORECAST_SQL} SELECT b.ticker, b.d, b.close, f.yhat FROM bars b
LEFT JOIN (SELECT ticker, d, yhat FROM fc WHERE model = 'peak5') f USING (ticker, d)""",
)
def _(spark, sf):
    fc = simple_forecasts(spark, sf).where(F.col("model") == "peak5")
    return joins.attach(closes(spark, sf), filters.to_day(fc, "d", "yhat", "yhat"))


@register(
    "align_exogenous",
    f"""WITH {BARS} SELECT ticker, d, close, CAST(0 AS INTEGER) AS event_1, CAST(1 AS INTEGER) AS busy FROM bars
WHERE volume > 1 AND isodow(d) <> 7 AND NOT (d BETWEEN DATE '1996-02-01' AND DATE '1996-04-01')
UNION ALL SELECT ticker, d, close, 1, 1 FROM bars
WHERE volume > 1 AND isodow(d) <> 7 AND d BETWEEN DATE '1996-02-01' AND DATE '1996-04-01'""",
)
def _(spark, sf):
    b = bars(spark, sf)
    exog = joins.event_flags(
        b.where(F.col("volume") > 1).select("ticker", "d"), EVENTS[:1], per_event=True
    ).withColumn("busy", F.lit(1))
    return joins.align(b.where(F.weekday("d") != 6).select("ticker", "d", "close"), exog)


_IN = " OR ".join(f"d BETWEEN DATE '{a}' AND DATE '{b}'" for a, b in EVENTS)


@register(
    "event_flags",
    f"WITH {BARS} SELECT ticker, d, close, CAST({_IN} AS INTEGER) AS event FROM bars",
)
def _(spark, sf):
    return joins.event_flags(closes(spark, sf), EVENTS)


@register(
    "event_flags_intraday",
    """SELECT event_id, ts,
CAST((ts >= TIMESTAMP '2024-01-03' AND ts < TIMESTAMP '2024-01-06') OR (ts >= TIMESTAMP '2024-01-20' AND ts < TIMESTAMP '2024-01-21') AS INTEGER) AS event,
CAST((ts >= TIMESTAMP '2024-01-03' AND ts <= TIMESTAMP '2024-01-05') OR ts = TIMESTAMP '2024-01-20' AS INTEGER) AS event_instant FROM events""",
)
def _(spark, sf):
    """Day-granular flags keep the whole last day; instant bounds stop at midnight."""
    df = table(spark, sf, "events").select("event_id", "ts")
    events = [("2024-01-03", "2024-01-05"), "2024-01-20"]
    df = joins.event_flags(df, events, "ts")
    return joins.event_flags(df, events, "ts", day_granular=False, name="event_instant")


_MULTI = ", ".join(
    f"CAST(d BETWEEN DATE '{a}' AND DATE '{b}' AS INTEGER) AS event_{i}"
    for i, (a, b) in enumerate([*EVENTS, ("1997-12-01", "1997-12-31")], 1)
)


@register("event_flags_multi", f"WITH {BARS} SELECT ticker, d, {_MULTI} FROM bars")
def _(spark, sf):
    df = closes(spark, sf).drop("close")
    return joins.event_flags(df, [*EVENTS, "1997-12"], per_event=True)


@register(
    "event_flags_table",
    f"""WITH {BARS} SELECT ticker, d, CAST(isodow(d) = 1 OR EXISTS (SELECT 1 FROM generate_series(1995, 2001) t(y)
WHERE d BETWEEN make_date(y, 3, 1) AND make_date(y, 3, 20)) AS INTEGER) AS event FROM bars""",
)
def _(spark, sf):
    """A calendar table of many periods, derived from the days of the data."""
    df = closes(spark, sf).drop("close")
    days = df.select("d").distinct()
    mondays = days.where(F.weekday("d") == 0).select(F.col("d").alias("start"), F.col("d").alias("end"))
    march = days.select(
        F.make_date(F.year("d"), F.lit(3), F.lit(1)).alias("start"),
        F.make_date(F.year("d"), F.lit(3), F.lit(20)).alias("end"),
    ).distinct()
    return joins.event_flags_table(df, mondays.unionByName(march))


_COV = " UNION ALL ".join(
    f"""SELECT ticker, {i} AS event_no, DATE '{a}' AS start_d, DATE '{b}' AS end_d,
NOT (DATE '{a}' > max(d) OR DATE '{b}' < min(d)) AS in_range, count(*) FILTER (d BETWEEN DATE '{a}' AND DATE '{b}') AS marked FROM bars GROUP BY 1"""
    for i, (a, b) in enumerate(EVENTS, 1)
)


@register("event_coverage", f"WITH {BARS} {_COV}")
def _(spark, sf):
    return joins.event_coverage(closes(spark, sf), EVENTS)


@register(
    "positional_align",
    f"""WITH {ROWS}, v AS (SELECT ticker, rn AS step, close AS yhat FROM x ),
t AS (SELECT ticker, d, row_number() OVER (PARTITION BY ticker ORDER BY d) AS step FROM bars WHERE d >= DATE '{TEST_START}')
SELECT ticker, CAST(step AS INTEGER) AS step, yhat, d FROM v JOIN t USING (ticker, step)""",
)
def _(spark, sf):
    values = with_positions(closes(spark, sf), CUT).select(
        "ticker", (F.col(POS) + 1).cast("int").alias("step"), F.col("close").alias("yhat")
    )
    dates = filters.between_ts(closes(spark, sf), TEST_START, None).select("ticker", "d")
    return joins.positional_align(values, dates, CUT)


# ---- aggregates and checks ----------------------------------------------------------


@register(
    "series_span",
    f"WITH {BARS} SELECT ticker, min(d) AS first_d, max(d) AS last_d, count(*) AS n_rows FROM bars GROUP BY 1",
)
def _(spark, sf):
    return quality.series_span(closes(spark, sf))


@register(
    "null_counts",
    f"""WITH {GAPPY}, f AS (SELECT close, lag(close, 1) {W} AS lag_1, lag(close, 20) {W} AS lag_20 FROM g)
SELECT 'close' AS "column", count(*) FILTER (close IS NULL) AS nulls FROM f
UNION ALL SELECT 'lag_1', count(*) FILTER (lag_1 IS NULL) FROM f
UNION ALL SELECT 'lag_20', count(*) FILTER (lag_20 IS NULL) FROM f""",
)
def _(spark, sf):
    laid = lay_out(gappy(spark, sf), CUT, back=20)
    df = laid.with_columns(lags(F.col("close"), [1, 20], laid.w)).close()
    return quality.null_counts(df, ["close", "lag_1", "lag_20"])


@register(
    "forecast_metrics",
    f"""WITH {FORECAST_SQL} SELECT ticker, model, {r("avg(abs(y - yhat))", "mae", 3)}, {r("avg(power(y - yhat, 2)) / 1e6", "mse_millions", 3)},
{r("sqrt(avg(power(y - yhat, 2)))", "rmse", 3)}, {r("avg(abs((y - yhat) / NULLIF(y, 0))) * 100", "mape", 3)} FROM fc GROUP BY 1, 2""",
)
def _(spark, sf):
    m = metrics.forecast_metrics(simple_forecasts(spark, sf), "y", "yhat", ["ticker", "model"])
    m = m.withColumn("mse_millions", F.col("mse") / 1e6).drop("mse")
    return rounded(m, 3)


@register(
    "training_checks",
    f"""WITH {BARS} SELECT ticker, count(*) AS n_rows, count(close) AS n_target, coalesce(min(close) < max(close), false) AS varies,
CASE WHEN count(close) = 0 THEN 'all targets null' WHEN NOT coalesce(min(close) < max(close), false) THEN 'fewer than two values' ELSE 'ok' END AS status
FROM bars GROUP BY 1""",
)
def _(spark, sf):
    return quality.training_checks(closes(spark, sf), "close")


_LEDGER = """runs AS (SELECT CAST(user_id AS VARCHAR) AS job_id, event_type AS model,
CASE WHEN event_type = 'error' THEN 'failed' WHEN event_type = 'view' THEN 'pending' ELSE 'success' END AS status, value AS seconds FROM events)"""


def run_ledger(spark: SparkSession, sf: str) -> DataFrame:
    """Events read as a run ledger: a user is a job, an event one trained model."""
    kind = F.col("event_type")
    return table(spark, sf, "events").select(
        F.col("user_id").cast("string").alias("job_id"),
        kind.alias("model"),
        F.when(kind == "error", "failed").when(kind == "view", "pending").otherwise("success").alias("status"),
        F.col("value").alias("seconds"),
    )


@register(
    "run_summary",
    f"""WITH {_LEDGER} SELECT job_id, count(*) AS total, count(*) FILTER (status = 'success') AS successful,
count(*) FILTER (status = 'failed') AS failed,
{r("100.0 * count(*) FILTER (status IN ('success', 'failed')) / count(*)", "progress")}, {r("sum(seconds)", "total_seconds", 2)},
CASE WHEN count(*) FILTER (status IN ('success', 'failed')) = count(*) THEN 'completed' ELSE 'running' END AS status FROM runs GROUP BY 1""",
)
def _(spark, sf):
    s = ledger.run_summary(run_ledger(spark, sf))
    return rounded(rounded(s, 4, ["progress"]), 2, ["total_seconds"])


_SCALE = f"""{BARS}, s AS (SELECT ticker, min(close) AS lo, max(close) AS hi, min(volume) AS vlo, max(volume) AS vhi FROM bars GROUP BY 1)"""


@register(
    "minmax_scale",
    f"""WITH {_SCALE} SELECT ticker, d, {r("(close - lo) / CASE WHEN hi = lo THEN 1 ELSE hi - lo END", "close", 6)},
{r("(volume - vlo) / CASE WHEN vhi = vlo THEN 1.0 ELSE vhi - vlo END", "volume", 6)}, 0.0::DOUBLE AS flat FROM bars JOIN s USING (ticker)""",
)
def _(spark, sf):
    df = bars(spark, sf).select("ticker", "d", "close", "volume", F.lit(7.0).alias("flat"))
    cols = ["close", "volume", "flat"]
    return rounded(scaling.minmax_scale(df, scaling.fit_minmax(df, cols), cols), 6)


@register(
    "minmax_inverse",
    f"""WITH {BARS} SELECT ticker, d, {r("close", "close")} FROM bars""",
)
def _(spark, sf):
    """Scaled with training rows only, then back to prices."""
    df = closes(spark, sf)
    stats = scaling.fit_minmax(df, ["close"], fit_on=F.col("d") <= F.lit(TRAIN[1]).cast("date"))
    there = scaling.minmax_scale(df, stats, ["close"])
    return rounded(scaling.minmax_inverse(there, stats, {"close": "close"}))


# ---- sorts, limits, set operations ----------------------------------------------------


@register(
    "head_tail",
    f"""WITH {ROWS} SELECT ticker, d, close, 'head' AS part FROM x WHERE rn <= 5
UNION ALL SELECT ticker, d, close, 'tail' FROM x WHERE rn > n - 5""",
)
def _(spark, sf):
    df = closes(spark, sf)
    head = filters.top_rows(df, [F.col("d")], 5, ["ticker"]).withColumn("part", F.lit("head"))
    tail = filters.top_rows(df, [F.col("d").desc()], 5, ["ticker"]).withColumn("part", F.lit("tail"))
    return head.unionByName(tail)


@register("top_rows", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 10")
def _(spark, sf):
    df = table(spark, sf, "orders").select("o_orderkey", "o_totalprice")
    return filters.top_rows(df, [F.col("o_totalprice").desc(), F.col("o_orderkey")], 10)


@register(
    "union_predictions",
    f"""WITH {ROWS}, f AS (SELECT ticker, d, lag(close) {W} AS yhat FROM x)
SELECT ticker, d, yhat FROM f WHERE d < DATE '{TEST_START}' UNION ALL SELECT ticker, d, yhat FROM f WHERE d >= DATE '{TEST_START}'""",
)
def _(spark, sf):
    laid = lay_out(closes(spark, sf), CUT, back=1)
    fc = laid.with_columns({"yhat": F.lag("close", 1).over(laid.w)}).close().drop("close")
    train = fc.where(F.col("d") < F.lit(TEST_START).cast("date"))
    return joins.union_predictions(train, filters.between_ts(fc, TEST_START, None))


# ---- general preparation -----------------------------------------------------------------


@register(
    "profile_schema",
    """SELECT CAST(position AS INTEGER) AS position, "column", type, n_rows FROM (VALUES (0, 'c_custkey', 'bigint'), (1, 'c_name', 'string'),
(2, 'c_nationkey', 'int'), (3, 'c_acctbal', 'double'), (4, 'c_mktsegment', 'string')) v(position, "column", type)
CROSS JOIN (SELECT count(*) AS n_rows FROM customer)""",
)
def _(spark, sf):
    return profiling.profile_schema(table(spark, sf, "customer"))


def _describe_sql(c: str) -> str:
    return f"""SELECT '{c}' AS "column", count({c}) AS n, {r(f"avg({c})", "mean")}, {r(f"stddev_samp({c})", "std")}, {r(f"min({c})::DOUBLE", "min")},
{r(f"quantile_cont({c}, 0.25)", "q25")}, {r(f"quantile_cont({c}, 0.5)", "median")}, {r(f"quantile_cont({c}, 0.75)", "q75")}, {r(f"max({c})::DOUBLE", "max")} FROM customer"""


@register("describe", " UNION ALL ".join(map(_describe_sql, ("c_acctbal", "c_custkey", "c_nationkey"))))
def _(spark, sf):
    return rounded(profiling.describe(table(spark, sf, "customer"), ["c_acctbal", "c_custkey", "c_nationkey"]))


@register(
    "impute_median",
    """WITH h AS (SELECT event_id, CASE WHEN event_id % 7 <> 0 THEN value END AS value FROM events)
SELECT event_id, """ + rnd("coalesce(value, (SELECT quantile_cont(value, 0.5) FROM h))") + " AS value FROM h",
)
def _(spark, sf):
    holes = table(spark, sf, "events").select(
        "event_id", F.when(F.col("event_id") % 7 != 0, F.col("value")).alias("value")
    )
    return rounded(profiling.impute_median(holes, ["value"]))


@register(
    "standardize_text",
    "SELECT c_custkey, trim(lower(c_name)) AS c_name, trim(lower('  ' || c_mktsegment || ' ')) AS c_mktsegment FROM customer",
)
def _(spark, sf):
    df = table(spark, sf, "customer").select(
        "c_custkey", "c_name", F.concat(F.lit("  "), "c_mktsegment", F.lit(" ")).alias("c_mktsegment")
    )
    return profiling.standardize_text(df, ["c_name", "c_mktsegment"])


@register(
    "dedupe_key",
    """SELECT o_custkey, o_orderdate, o_orderkey, o_totalprice FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS rn FROM orders) WHERE rn = 1""",
)
def _(spark, sf):
    df = table(spark, sf, "orders").select("o_custkey", "o_orderdate", "o_orderkey", "o_totalprice")
    return profiling.dedupe_key(df, ["o_custkey"], ["o_orderdate", "o_orderkey"])


@register(
    "binary_rate",
    f"SELECT {rnd('avg(quality::DOUBLE)', 6)} AS rate FROM labels",
)
def _(spark, sf):
    return rounded(profiling.binary_rate(table(spark, sf, "labels"), "quality"), 6)


@register(
    "derived_ratio",
    f"""SELECT l_orderkey, l_linenumber, {r("l_extendedprice / NULLIF(l_quantity, 0)", "unit_price")}, {r("l_quantity / 30", "months", 6)} FROM lineitem""",
)
def _(spark, sf):
    df = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_extendedprice", "l_quantity")
    df = profiling.derived_ratio(df, "unit_price", F.col("l_extendedprice"), F.col("l_quantity"))
    df = profiling.derived_ratio(df, "months", F.col("l_quantity"), F.lit(30)).drop("l_extendedprice", "l_quantity")
    return rounded(rounded(df, 4, ["unit_price"]), 6, ["months"])


@register(
    "rolling3",
    f"""WITH {BARS} SELECT ticker, d, {r("CASE WHEN count(close) OVER w = 3 THEN avg(close) OVER w END", "avg_3", 5)} FROM bars
WINDOW w AS (PARTITION BY ticker ORDER BY d ROWS BETWEEN 2 PRECEDING AND CURRENT ROW)""",
)
def _(spark, sf):
    return rounded(profiling.rolling3(closes(spark, sf), "close", CUT).drop("close"), 5)


@register(
    "confusion_matrix",
    """SELECT quality AS label, count(*) FILTER (1 - toxic = 0) AS pred_0, count(*) FILTER (1 - toxic = 1) AS pred_1 FROM labels GROUP BY 1""",
)
def _(spark, sf):
    df = table(spark, sf, "labels").select("quality", (1 - F.col("toxic")).alias("pred"))
    return profiling.confusion_matrix(df, "quality", "pred", [0, 1])


def _report_sql(c: int) -> str:
    t, p = f"quality = {c}", f"1 - toxic = {c}"
    both = f"count(*) FILTER ({t} AND {p})"
    return f"""SELECT {c} AS "class", {r(f"coalesce({both}::DOUBLE / NULLIF(count(*) FILTER ({p}), 0), 0)", "precision", 6)},
{r(f"coalesce({both}::DOUBLE / NULLIF(count(*) FILTER ({t}), 0), 0)", "recall", 6)},
{r(f"coalesce(2.0 * {both} / NULLIF(count(*) FILTER ({t}) + count(*) FILTER ({p}), 0), 0)", "f1", 6)}, count(*) FILTER ({t}) AS support FROM labels"""


@register("classification_report", _report_sql(0) + " UNION ALL " + _report_sql(1))
def _(spark, sf):
    df = table(spark, sf, "labels").select("quality", (1 - F.col("toxic")).alias("pred"))
    return rounded(profiling.classification_report(df, "quality", "pred", [0, 1]), 6)
