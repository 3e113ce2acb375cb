"""Forecasting queries: fits, forecasts, scores, ensembles."""

from __future__ import annotations

from pyspark.sql import functions as F

from seriesloom.catalog.base import (
    BARS,
    CUT,
    EVENTS,
    TEST_START,
    TRAIN,
    closes,
    r,
    register,
    rounded,
    table,
)
from seriesloom.catalog.features import ML_CFG
from seriesloom.catalog.prep import FORECAST_SQL, scratch, simple_forecasts
from seriesloom.operators import (
    additive,
    arima,
    calendars,
    datasets,
    filters,
    forecasting,
    joins,
    ledger,
    metrics,
    sequences,
    trees,
)
from seriesloom.operators.features import feature_names
from seriesloom.plans.layout import POS, Layout, with_positions
from seriesloom.session import cut_lineage

SOLVED = ["ticker", "p", "d", "q", "const", "ar", "ma", "exog", "sigma2", "n_obs", "aic", "bic", "status"]
SMALL_EVENTS = additive.events_of(EVENTS[:3])
ADDITIVE = additive.AdditiveConfig(events=SMALL_EVENTS)


def training(spark, sf):
    return filters.between_ts(closes(spark, sf), *TRAIN)


@register("arima_fit")
def _(spark, sf):
    return arima.arima_fit(training(spark, sf), (1, 2, 5), layout=CUT).select(*SOLVED)


AR1 = f"""WITH {BARS}, t AS (SELECT ticker, d, close, lag(close) OVER (PARTITION BY ticker ORDER BY d) AS p FROM bars
 WHERE d BETWEEN DATE '{TRAIN[0]}' AND DATE '{TRAIN[1]}'),
m AS (SELECT ticker, avg(close) AS m, stddev_samp(close) AS s, arg_max(close, d) AS last, regr_slope(close, p) AS phi,
 regr_intercept(close, p) AS a, count(p) AS n_obs,
 (regr_syy(close, p) - regr_sxy(close, p) * regr_sxy(close, p) / regr_sxx(close, p)) / count(p) AS v FROM t GROUP BY 1)"""


@register(
    "arima_fit_ar1",
    f"""{AR1} SELECT ticker, {r("(a + (phi - 1) * m) / s", "const", 6)}, {r("phi", "phi", 6)},
 {r("v / (s * s)", "variance", 6)}, n_obs, 'success' AS status FROM m""",
)
def _(spark, sf):
    """First-order autoregression; the variance is in the standardised scale."""
    fit = arima.arima_fit(training(spark, sf), (1, 0, 0), layout=CUT)
    variance = (F.col("sigma2") / (F.col("scale") * F.col("scale"))).alias("variance")
    phi = F.get("ar", F.lit(0)).alias("phi")
    return rounded(fit.select("ticker", "const", phi, variance, "n_obs", "status"), 6)


@register(
    "arima_forecast_ar1",
    f"""{AR1} SELECT ticker, CAST(h AS INTEGER) AS step,
 {r("a * (1 - phi ** h) / (1 - phi) + phi ** h * last", "yhat", 2)},
 {r("1.959963984540054 * sqrt(v * (1 - phi ** (2 * h)) / (1 - phi * phi))", "half_width", 2)}
FROM m CROSS JOIN (SELECT unnest(range(1, 11)) AS h)""",
)
def _(spark, sf):
    """Ten steps ahead of a first-order autoregression."""
    fit = arima.arima_fit(training(spark, sf), (1, 0, 0), layout=CUT)
    half = ((F.col("upper") - F.col("lower")) / 2).alias("half_width")
    return rounded(arima.arima_forecast(fit, 10).select("ticker", "step", "yhat", half), 2)


@register("arima_grid")
def _(spark, sf):
    return arima.arima_grid(training(spark, sf), 5, 2, 5, layout=CUT)


def flagged(spark, sf):
    return joins.event_flags(training(spark, sf), SMALL_EVENTS[:2], per_event=True)


FLAGS = ["event_1", "event_2"]


@register("arimax_fit")
def _(spark, sf):
    return arima.arimax_fit(flagged(spark, sf), FLAGS, layout=CUT).select(*SOLVED)


@register("arimax_coefs")
def _(spark, sf):
    fit = arima.arima_fit(flagged(spark, sf), (2, 0, 2), layout=CUT, exog=FLAGS)
    return arima.arimax_coefs(fit, FLAGS)


@register("arima_forecast")
def _(spark, sf):
    fit = arima.arima_fit(training(spark, sf), (1, 2, 5), layout=CUT)
    return arima.arima_forecast(fit, 30)


@register("additive_fit")
def _(spark, sf):
    fit = additive.additive_fit(training(spark, sf), ADDITIVE, layout=CUT)
    return additive.named_coefficients(fit, ADDITIVE)


@register("additive_forecast")
def _(spark, sf):
    """Thirty days ahead together with the fitted history."""
    df = training(spark, sf)
    fit = additive.additive_fit(df, ADDITIVE, layout=CUT)
    return additive.additive_forecast(fit, 30, history=df, cfg=ADDITIVE)


def _ml(spark, sf, cfg=ML_CFG):
    return datasets.ml_dataset(closes(spark, sf), *TRAIN, TEST_START, cfg=cfg, layout=CUT)


def _labelled(spark, sf):
    """The labelled feature table, stored once: a fit and its scores read it several times."""
    return cut_lineage(_ml(spark, sf))


@register("gbt_fit_score")
def _(spark, sf):
    """Boosted trees of each series on the training years, scored on the test years."""
    data, cols = _labelled(spark, sf), feature_names(ML_CFG)
    model = trees.gbt_fit(data.where(F.col("split") == "train"), cols)
    scored = trees.gbt_score(model, data.where(F.col("split") == "test"), cols)
    return scored.select("ticker", "d", F.col("label").alias("y"), "yhat")


def _importances(spark, sf):
    data, cols = _labelled(spark, sf), feature_names(ML_CFG)
    model = trees.gbt_fit(data.where(F.col("split") == "train"), cols)
    return trees.feature_importance(model, cols, 10)


@register("feature_importance")
def _(spark, sf):
    """The ten strongest features of each series."""
    return _importances(spark, sf)


@register("training_summary")
def _(spark, sf):
    """Scores of each series' autoregressive grid winner and its strongest tree features."""
    best = arima.arima_grid(training(spark, sf), 5, 2, 5, layout=CUT).where("best")
    runs = best.select(
        F.concat(F.lit("arima_"), F.lower("ticker")).alias("model"), "aic", "bic"
    ).unionByName(
        best.select(
            F.concat(F.lit("trees_"), F.lower("ticker")).alias("model"),
            F.lit(None).cast("double").alias("aic"),
            F.lit(None).cast("double").alias("bic"),
        )
    )
    strongest = _importances(spark, sf).select(
        F.concat(F.lit("trees_"), F.lower("ticker")).alias("model"), "feature", "importance"
    )
    return ledger.training_summary(runs, strongest)


LENGTH = 5


def _sequence_model(spark, sf):
    df = training(spark, sf)
    flat = sequences.flat_sequences(sequences.sequences(df, ["close"], "close", LENGTH, CUT), LENGTH)
    cols = [f"x{i + 1}" for i in range(LENGTH)]
    return trees.gbt_fit(flat, cols, "y"), trees.last_windows(df, LENGTH, "close", CUT)


@register("recursive_forecast")
def _(spark, sf):
    model, state = _sequence_model(spark, sf)
    return trees.recursive_forecast(model, state, LENGTH)


@register("next_step")
def _(spark, sf):
    model, state = _sequence_model(spark, sf)
    return trees.next_step(model, state, LENGTH)


@register(
    "recursive_linear",
    f"""WITH RECURSIVE {FORECAST_SQL}, t AS (SELECT ticker, d, close, row_number() OVER (PARTITION BY ticker ORDER BY d DESC) AS k FROM bars),
p AS (SELECT ticker, 0 AS step, max(close) FILTER (k = 3) AS a, max(close) FILTER (k = 2) AS b, max(close) FILTER (k = 1) AS c FROM t GROUP BY 1
UNION ALL SELECT ticker, step + 1, b, c, 0.2::DOUBLE * a + 0.3::DOUBLE * b + 0.4::DOUBLE * c + 1000 FROM p WHERE step < 15)
SELECT ticker, CAST(step AS INTEGER) AS step, {r("c", "yhat")} FROM p WHERE step > 0""",
)
def _(spark, sf):
    """A fixed linear rule rolled forward from the last three closes of each series."""
    state = trees.last_windows(closes(spark, sf), 3, "close", CUT).drop("last_d")
    coefs = F.array(F.lit(0.2), F.lit(0.3), F.lit(0.4))
    return rounded(trees.recursive_linear(state, coefs, F.lit(1000.0), 3, 15))


def _ensemble(name, method, weights, sql):
    @register(
        name,
        f"""WITH {FORECAST_SQL}, l AS (SELECT ticker, model, max(step) AS n FROM fcs GROUP BY 1, 2), s AS (SELECT ticker, min(n) AS n FROM l GROUP BY 1)
SELECT ticker, step, {r(sql, "yhat", 5)} FROM fcs JOIN s USING (ticker) WHERE step <= n GROUP BY 1, 2""".replace(
            "fc AS (", "fc0 AS ("
        ).replace(
            "WHERE isodow(d) <> 1)",
            "WHERE isodow(d) <> 1),\nfcs AS (SELECT ticker, model, yhat, row_number() OVER (PARTITION BY ticker, model ORDER BY d) AS step FROM fc0)",
        ),
    )
    def _(spark, sf):
        return rounded(metrics.ensemble(numbered(spark, sf), method, weights), 5)


def numbered(spark, sf):
    """The simple forecasts with steps counted within each model, so lengths differ."""
    fc = simple_forecasts(spark, sf).withColumn("series", F.concat_ws("|", "ticker", "model"))
    placed = with_positions(fc, Layout(key="series", rows=1000))
    return placed.select("ticker", "model", (F.col(POS) + 1).alias("step"), "yhat")


WEIGHTS = {"naive": 2.0, "mean5": 0.5}
_ensemble("ensemble", "mean", None, "avg(yhat)")
_ensemble("ensemble_median", "median", None, "median(yhat)")
_ensemble(
    "ensemble_weighted",
    "weighted",
    WEIGHTS,
    "sum(yhat * CASE model WHEN 'naive' THEN 2.0 WHEN 'mean5' THEN 0.5 ELSE 1.0 END) / sum(CASE model WHEN 'naive' THEN 2.0 WHEN 'mean5' THEN 0.5 ELSE 1.0 END)",
)


@register("forecast_all")
def _(spark, sf):
    """Every model family over the requested range, with its ledger status."""
    fc, runs = forecasting.forecast_all(closes(spark, sf), 30, layout=CUT, start=TRAIN[0], end=TRAIN[1])
    return fc.join(runs.select("model", "status"), "model")


CUTS = ("1998-01-01", "1999-01-01", "2000-01-01")
CUT_ROWS = ", ".join(f"('{c}')" for c in CUTS)


@register(
    "backtest_naive",
    f"""WITH {BARS}, cuts AS (SELECT * FROM (VALUES {CUT_ROWS}) AS v(cut)),
l AS (SELECT ticker, cut, max_by(close, d) AS yhat FROM bars, cuts WHERE d < CAST(cut AS DATE) GROUP BY 1, 2),
a AS (SELECT ticker, cut, close AS y, row_number() OVER (PARTITION BY ticker, cut ORDER BY d) AS step FROM bars, cuts WHERE d >= CAST(cut AS DATE))
SELECT ticker, 'naive' AS model, cut, {r("avg(abs(y - yhat))", "mae", 4)}, {r("avg((y - yhat) * (y - yhat))", "mse", 2)}, {r("sqrt(avg((y - yhat) * (y - yhat)))", "rmse", 4)}, {r("avg(abs((y - yhat) / y)) * 100", "mape", 4)}
FROM a JOIN l USING (ticker, cut) WHERE step <= 30 GROUP BY 1, 3""",
)
def _(spark, sf):
    """Held-out errors of the last value, thirty rows after each of three dates."""
    models = {"naive": forecasting.naive_model()}
    got = forecasting.backtest(closes(spark, sf), CUTS, 30, models, layout=CUT, by_cut=True)
    return got.select(
        "ticker", "model", "cut", F.round("mae", 4).alias("mae"), F.round("mse", 2).alias("mse"),
        F.round("rmse", 4).alias("rmse"), F.round("mape", 4).alias("mape"),
    )


@register("backtest_models")
def _(spark, sf):
    """Held-out errors of every model family over three cut dates."""
    models = {"naive": forecasting.naive_model(), **forecasting.default_models()}
    return forecasting.backtest(closes(spark, sf), CUTS, 30, models, layout=CUT)


@register("arimax_forecast")
def _(spark, sf):
    """Thirty days ahead with the events that fall into them."""
    fit = arima.arima_fit(flagged(spark, sf), (2, 0, 2), layout=CUT, exog=FLAGS)
    ahead = arima.future_events(fit, 30, AHEAD)
    return arima.arima_forecast(fit, 30, ahead)


#: The flags' events as they stand after training: the first recurs, the second does not.
AHEAD = (("2000-01-10", "2000-01-20"), ("1998-03-01", "1998-05-01"))


@register(
    "calendar_align",
    f"""WITH {FORECAST_SQL}, b AS (SELECT CAST(x AS DATE) AS d, row_number() OVER (ORDER BY x) AS step FROM (SELECT unnest(generate_series(DATE '2002-01-01', DATE '2002-03-31', INTERVAL 1 DAY)) AS x) WHERE isodow(x) <= 5)
SELECT ticker, step, b.d, yhat FROM fc JOIN b USING (step) WHERE model = 'naive'""",
)
def _(spark, sf):
    fc = simple_forecasts(spark, sf).where(F.col("model") == "naive").select("ticker", "step", "yhat")
    return calendars.calendar_align(fc, "2002-01-01", "2002-03-31")


@register("rf_cv")
def _(spark, sf):
    return trees.rf_cv(_documents(spark, sf), DOC_COLS, "quality")


@register("rf_score")
def _(spark, sf):
    """A forest fitted on the labelled documents, saved, loaded and applied to every document."""
    docs = _counted(spark, sf)
    path = f"{scratch(spark)}/forest"
    trees.rf_fit(_documents(spark, sf), DOC_COLS, "quality").write().overwrite().save(path)
    return trees.rf_score(path, docs, DOC_COLS, ["doc_id"])


DOC_COLS = ["n_chars", "n_words", "n_lines", "digit_share"]


def _documents(spark, sf):
    """The labelled documents with their label."""
    labels = table(spark, sf, "labels").select("doc_id", "quality")
    return _counted(spark, sf).join(labels, "doc_id")


def _counted(spark, sf):
    """All documents with counts over their whole text."""
    text = F.col("text")
    docs = table(spark, sf, "documents").select(
        "doc_id",
        "n_chars",
        F.size(F.split(text, r"\s+")).alias("n_words"),
        F.size(F.split(text, "\n")).alias("n_lines"),
        F.try_divide(
            F.length(F.regexp_replace(text, "[^0-9]", "")), F.length(text)
        ).alias("digit_share"),
    )
    return docs.na.fill(0.0, ["digit_share"])
