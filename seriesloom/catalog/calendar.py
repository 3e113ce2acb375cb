"""Calendar columns over the days of the bars, and calendars derived from the data."""

from __future__ import annotations

from pyspark.sql import functions as F

from seriesloom.catalog.base import BARS, bars, closes, register, rnd, rounded, table
from seriesloom.functions import calendar as cal
from seriesloom.operators import calendars

MONTH, DAY, DOW, QUARTER = "month(d)", "day(d)", "(isodow(d) - 1)", "quarter(d)"
M_END = "(d = last_day(d))"


def flag(cond: str) -> str:
    return f"CAST(({cond}) AS INTEGER)"


def i32(expr: str) -> str:
    return f"CAST({expr} AS INTEGER)"


def wave(fn: str, value: str, period: str) -> str:
    return rnd(f"{fn}(2 * pi() * {value} / {period})", 6)


BASIC = {
    "year": i32("year(d)"),
    "month": i32(MONTH),
    "day": i32(DAY),
    "dayofweek": i32(DOW),
    "quarter": i32(QUARTER),
    "is_weekend": flag(f"{DOW} >= 5"),
    "is_month_start": flag(f"{DAY} = 1"),
    "is_month_end": flag(M_END),
    "is_quarter_start": flag(f"{DAY} = 1 AND {MONTH} IN (1, 4, 7, 10)"),
    "is_quarter_end": flag(f"{M_END} AND {MONTH} IN (3, 6, 9, 12)"),
    "is_year_start": flag("dayofyear(d) = 1"),
    "is_year_end": flag(f"{MONTH} = 12 AND {DAY} = 31"),
}
SPECIAL = {
    "es_lunes": flag(f"{DOW} = 0"),
    "es_viernes": flag(f"{DOW} = 4"),
    "dias_desde_lunes": i32(DOW),
    "dias_hasta_viernes": i32(f"4 - {DOW}"),
}
CYCLIC = {
    f"{fn}_{name}": wave(fn, value, period)
    for name, value, period in (("month", MONTH, "12"), ("day", DAY, "31"), ("dayofweek", DOW, "7"))
    for fn in ("sin", "cos")
}
MARKET = {
    "es_inicio_mes": BASIC["is_month_start"],
    "es_fin_mes": BASIC["is_month_end"],
    "es_inicio_trimestre": BASIC["is_quarter_start"],
    "es_fin_trimestre": BASIC["is_quarter_end"],
    "es_inicio_año": BASIC["is_year_start"],
    "es_fin_año": BASIC["is_year_end"],
    "semana_del_mes": i32(f"({DAY} - 1) // 7 + 1"),
}
EXTRA = {
    "dia_año": i32("dayofyear(d)"),
    "semana_año": i32("weekofyear(d)"),
    "es_diciembre": flag(f"{MONTH} = 12"),
    "es_enero": flag(f"{MONTH} = 1"),
    "es_q4": flag(f"{MONTH} >= 10"),
    "es_q1": flag(f"{MONTH} <= 3"),
    "temporada_navidena": flag(f"{MONTH} >= 11"),
    "fin_año_fiscal": flag(f"{MONTH} = 12 AND {DAY} >= 25"),
    "inicio_año_fiscal": flag(f"{MONTH} = 1 AND {DAY} <= 10"),
}
NAVIDAD = "make_date(year(d) + CASE WHEN MONTH(d) = 12 AND DAY(d) > 25 THEN 1 ELSE 0 END, 12, 25)"
NOV1 = "make_date(year(d), 11, 1)"
FOURTH_FRIDAY = f"({NOV1} + CAST((12 - isodow({NOV1})) % 7 + 21 AS INTEGER))"


def near(month: int, day: int) -> str:
    return f"abs(date_diff('day', make_date(year(d), {month}, {day}), d)) <= 1"


HOLIDAYS = {
    "semanas_hasta_navidad": rnd(f"date_diff('day', d, {NAVIDAD}) / 7", 6),
    "semanas_hasta_año_nuevo": rnd("date_diff('day', d, make_date(year(d) + 1, 1, 1)) / 7", 6),
    "cerca_black_friday": flag(f"{MONTH} = 11 AND abs(date_diff('day', {FOURTH_FRIDAY}, d)) <= 3"),
    "fin_de_mes": M_END,
    "fin_de_trimestre": f"({M_END} AND {MONTH} IN (3, 6, 9, 12))",
    "primeros_5_dias_mes": flag(f"{DAY} <= 5"),
    "ultimos_5_dias_mes": "(day(d + 5) = 1)",
    "periodo_earnings": flag(f"{MONTH} IN (1, 4, 7, 10)"),
    "cerca_festivo_bursatil": f"({near(1, 1)} OR {near(7, 4)} OR {near(12, 25)})",
}
BIM = f"(({MONTH} - 1) // 2 + 1)"
SEASONS = {
    "es_invierno": flag(f"{MONTH} IN (12, 1, 2)"),
    "es_primavera": flag(f"{MONTH} BETWEEN 3 AND 5"),
    "es_verano": flag(f"{MONTH} BETWEEN 6 AND 8"),
    "es_otoño": flag(f"{MONTH} BETWEEN 9 AND 11"),
    "estacion_sin": wave("sin", "dayofyear(d)", "365.25"),
    "estacion_cos": wave("cos", "dayofyear(d)", "365.25"),
    "bimestre": i32(BIM),
    "bimestre_sin": wave("sin", BIM, "6"),
    "bimestre_cos": wave("cos", BIM, "6"),
}
TRADING = {
    "es_lunes_trading": SPECIAL["es_lunes"],
    "es_viernes_trading": SPECIAL["es_viernes"],
}
BASIC_NB = {
    "año": BASIC["year"],
    "mes": BASIC["month"],
    "dia": BASIC["day"],
    "dia_semana": BASIC["dayofweek"],
    "dia_año": EXTRA["dia_año"],
    "semana_año": EXTRA["semana_año"],
    "trimestre": BASIC["quarter"],
    "es_fin_semana": BASIC["is_weekend"],
    "es_lunes": SPECIAL["es_lunes"],
    "es_viernes": SPECIAL["es_viernes"],
    "mes_sin": CYCLIC["sin_month"],
    "mes_cos": CYCLIC["cos_month"],
    "dia_semana_sin": CYCLIC["sin_dayofweek"],
    "dia_semana_cos": CYCLIC["cos_dayofweek"],
}
LIBRARY = BASIC | SPECIAL | CYCLIC | MARKET
NOTEBOOK = BASIC_NB | EXTRA | HOLIDAYS | SEASONS | TRADING


def columns_sql(cols: dict[str, str]) -> str:
    return ", ".join(f'{e} AS "{n}"' for n, e in cols.items())


def block_sql(cols: dict[str, str]) -> str:
    return f"WITH {BARS} SELECT ticker, d, {columns_sql(cols)} FROM bars"


def _block(name, build, cols):
    @register(name, block_sql(cols))
    def _(spark, sf):
        days = closes(spark, sf).drop("close")
        return rounded(days.withColumns(build(F.col("d"))), 6)


_block("cal_basic", cal.cal_basic, BASIC)
_block("cal_special", cal.cal_special, SPECIAL)
_block("cal_cyclic", cal.cal_cyclic, CYCLIC)
_block("cal_market", cal.cal_market, MARKET)
_block("cal_extra", cal.cal_extra, EXTRA)
_block("cal_holidays", cal.cal_holidays, HOLIDAYS)
_block("cal_seasons", cal.cal_seasons, SEASONS)
_block("cal_trading", cal.cal_trading, TRADING)
_block("calendar_features", lambda d: cal.calendar_columns(d, "library"), LIBRARY)
_block("calendar_features_nb", lambda d: cal.calendar_columns(d, "notebook"), NOTEBOOK)


@register(
    "calendar_local_time",
    """SELECT event_id, CAST(t AS DATE) AS local_d, CAST(isodow(t) - 1 AS INTEGER) AS dayofweek, CAST(day(t) AS INTEGER) AS day
FROM (SELECT event_id, ts - INTERVAL 5 HOUR AS t FROM events)""",
)
def _(spark, sf):
    """Weekday and day in the series' own zone (five hours behind UTC in January)."""
    local = calendars.local_time(table(spark, sf, "events"), "ts", "America/New_York", "local_ts")
    d = F.col("local_ts").cast("date")
    return local.select(
        "event_id", d.alias("local_d"), F.weekday(d).alias("dayofweek"), F.dayofmonth(d).alias("day")
    )


@register(
    "business_days",
    f"""WITH {BARS}, s AS (SELECT ticker, min(d) AS a, max(d) AS b FROM bars GROUP BY 1),
e AS (SELECT ticker, CAST(unnest(generate_series(a, b, INTERVAL 1 DAY)) AS DATE) AS d FROM s)
SELECT ticker, d, CAST(row_number() OVER (PARTITION BY ticker ORDER BY d) AS INTEGER) AS step,
CAST(count(*) OVER (PARTITION BY ticker) AS INTEGER) AS n_days FROM e WHERE isodow(d) <= 5""",
)
def _(spark, sf):
    """Business days between the first and last day of each series."""
    spans = bars(spark, sf).groupBy("ticker").agg(F.min("d").alias("start"), F.max("d").alias("end"))
    return calendars.business_days_between(spans)


@register(
    "future_calendar",
    f"""WITH {BARS}, s AS (SELECT ticker, max(d) AS b FROM bars GROUP BY 1), k AS (SELECT unnest(range(1, 13)) AS k)
SELECT ticker, 'D' AS freq, CAST(k AS INTEGER) AS step, CAST(b + CAST(k AS INTEGER) AS DATE) AS d FROM s, k
UNION ALL SELECT ticker, 'W', CAST(k AS INTEGER), CAST(b + CAST(8 - isodow(b + 1) AS INTEGER) + 7 * CAST(k - 1 AS INTEGER) AS DATE) FROM s, k
UNION ALL SELECT ticker, 'M', CAST(k AS INTEGER), last_day(CAST(date_trunc('month', b + 1) + to_months(CAST(k - 1 AS INTEGER)) AS DATE)) FROM s, k""",
)
def _(spark, sf):
    df = closes(spark, sf)
    parts = [
        calendars.future_calendar(df, 12, f).withColumn("freq", F.lit(f)) for f in ("D", "W", "M")
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])
