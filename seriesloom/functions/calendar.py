"""Calendar columns. ``d`` is a date (or timestamp) Column in local time.

Weekday numbers run Monday = 0 .. Sunday = 6. Blocks return ``{name: Column}``.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

TWO_PI = 2.0 * math.pi

# month/day of the market holidays looked at.
MARKET_HOLIDAYS = ((1, 1), (7, 4), (12, 25))
# Months in which results are reported.
EARNINGS_MONTHS = (1, 4, 7, 10)
# Northern seasons; autumn is every other month.
SEASON_MONTHS = {
    "es_invierno": (12, 1, 2),
    "es_primavera": (3, 4, 5),
    "es_verano": (6, 7, 8),
    "es_otoño": (9, 10, 11),
}


def _flag(cond: Column) -> Column:
    return cond.cast("int")


def _wave(value: Column, period: float) -> tuple[Column, Column]:
    angle = F.lit(TWO_PI) * value / F.lit(float(period))
    return F.sin(angle), F.cos(angle)


def _month_end(d: Column) -> Column:
    return d == F.last_day(d)


def _day(d: Column) -> Column:
    return d.cast("date")


def cal_basic(d: Column) -> dict[str, Column]:
    d = _day(d)
    month, day, weekday = F.month(d), F.dayofmonth(d), F.weekday(d)
    return {
        "year": F.year(d),
        "month": month,
        "day": day,
        "dayofweek": weekday,
        "quarter": F.quarter(d),
        "is_weekend": _flag(weekday >= 5),
        "is_month_start": _flag(day == 1),
        "is_month_end": _flag(_month_end(d)),
        "is_quarter_start": _flag(d == F.trunc(d, "quarter")),
        "is_quarter_end": _flag((month % 3 == 0) & _month_end(d)),
        "is_year_start": _flag((month == 1) & (day == 1)),
        "is_year_end": _flag((month == 12) & (day == 31)),
    }


def cal_special(d: Column) -> dict[str, Column]:
    weekday = F.weekday(_day(d))
    return {
        "es_lunes": _flag(weekday == 0),
        "es_viernes": _flag(weekday == 4),
        "dias_desde_lunes": weekday,
        "dias_hasta_viernes": F.lit(4) - weekday,
    }


def cal_cyclic(d: Column) -> dict[str, Column]:
    d = _day(d)
    out: dict[str, Column] = {}
    for name, value, period in (
        ("month", F.month(d), 12),
        ("day", F.dayofmonth(d), 31),
        ("dayofweek", F.weekday(d), 7),
    ):
        out[f"sin_{name}"], out[f"cos_{name}"] = _wave(value, period)
    return out


def cal_market(d: Column) -> dict[str, Column]:
    d = _day(d)
    basic = cal_basic(d)
    return {
        "es_inicio_mes": basic["is_month_start"],
        "es_fin_mes": basic["is_month_end"],
        "es_inicio_trimestre": basic["is_quarter_start"],
        "es_fin_trimestre": basic["is_quarter_end"],
        "es_inicio_año": basic["is_year_start"],
        "es_fin_año": basic["is_year_end"],
        "semana_del_mes": (F.floor((F.dayofmonth(d) - 1) / 7) + 1).cast("int"),
    }


def cal_basic_nb(d: Column) -> dict[str, Column]:
    """Basic block of the notebook profile."""
    d = _day(d)
    weekday = F.weekday(d)
    out = {
        "año": F.year(d),
        "mes": F.month(d),
        "dia": F.dayofmonth(d),
        "dia_semana": weekday,
        "dia_año": F.dayofyear(d),
        "semana_año": F.weekofyear(d),
        "trimestre": F.quarter(d),
        "es_fin_semana": _flag(weekday >= 5),
        "es_lunes": _flag(weekday == 0),
        "es_viernes": _flag(weekday == 4),
    }
    out["mes_sin"], out["mes_cos"] = _wave(F.month(d), 12)
    out["dia_semana_sin"], out["dia_semana_cos"] = _wave(weekday, 7)
    return out


def cal_extra(d: Column) -> dict[str, Column]:
    """Day and week of year, month and quarter flags, fiscal year ends."""
    d = _day(d)
    month, day, quarter = F.month(d), F.dayofmonth(d), F.quarter(d)
    return {
        "dia_año": F.dayofyear(d),
        "semana_año": F.weekofyear(d),
        "es_diciembre": _flag(month == 12),
        "es_enero": _flag(month == 1),
        "es_q4": _flag(quarter == 4),
        "es_q1": _flag(quarter == 1),
        "temporada_navidena": _flag(month.isin(11, 12)),
        "fin_año_fiscal": _flag((month == 12) & (day >= 25)),
        "inicio_año_fiscal": _flag((month == 1) & (day <= 10)),
    }


def weeks_to_christmas(d: Column) -> Column:
    d = _day(d)
    this_year = F.make_date(F.year(d), F.lit(12), F.lit(25))
    next_year = F.make_date(F.year(d) + 1, F.lit(12), F.lit(25))
    return F.datediff(F.when(d > this_year, next_year).otherwise(this_year), d) / 7


def weeks_to_new_year(d: Column) -> Column:
    d = _day(d)
    return F.datediff(F.make_date(F.year(d) + 1, F.lit(1), F.lit(1)), d) / 7


def near_black_friday(d: Column) -> Column:
    """November days within three days of the fourth Friday."""
    d = _day(d)
    october_end = F.make_date(F.year(d), F.lit(10), F.lit(31))
    fourth = F.date_add(F.next_day(october_end, "FRI"), 21)
    return (F.month(d) == 11) & (F.abs(F.datediff(d, fourth)) <= 3)


def near_market_holiday(d: Column) -> Column:
    """Within a day of a fixed holiday of the same year (31 December is not)."""
    d = _day(d)
    near = F.lit(False)
    for month, day in MARKET_HOLIDAYS:
        holiday = F.make_date(F.year(d), F.lit(month), F.lit(day))
        near = near | (F.abs(F.datediff(d, holiday)) <= 1)
    return near


def cal_holidays(d: Column) -> dict[str, Column]:
    d = _day(d)
    return {
        "semanas_hasta_navidad": weeks_to_christmas(d),
        "semanas_hasta_año_nuevo": weeks_to_new_year(d),
        "cerca_black_friday": _flag(near_black_friday(d)),
        "fin_de_mes": _month_end(d),
        "fin_de_trimestre": (F.month(d) % 3 == 0) & _month_end(d),
        "primeros_5_dias_mes": _flag(F.dayofmonth(d) <= 5),
        # True only when the day four days later ends its month.
        "ultimos_5_dias_mes": _month_end(F.date_add(d, 4)),
        "periodo_earnings": _flag(F.month(d).isin(*EARNINGS_MONTHS)),
        "cerca_festivo_bursatil": near_market_holiday(d),
    }


def cal_seasons(d: Column) -> dict[str, Column]:
    d = _day(d)
    month = F.month(d)
    out = {name: _flag(month.isin(*months)) for name, months in SEASON_MONTHS.items()}
    out["estacion_sin"], out["estacion_cos"] = _wave(F.dayofyear(d) / 365.25, 1)
    two_months = (F.floor((month - 1) / 2) + 1).cast("int")
    out["bimestre"] = two_months
    out["bimestre_sin"], out["bimestre_cos"] = _wave(two_months, 6)
    return out


def cal_trading(d: Column) -> dict[str, Column]:
    weekday = F.weekday(_day(d))
    return {
        "es_lunes_trading": _flag(weekday == 0),
        "es_viernes_trading": _flag(weekday == 4),
    }


_MARKET_NB = (
    "fin_de_mes",
    "fin_de_trimestre",
    "primeros_5_dias_mes",
    "ultimos_5_dias_mes",
    "periodo_earnings",
    "cerca_festivo_bursatil",
)


def calendar_columns(
    d: Column, profile: str = "library", market: bool = True
) -> dict[str, Column]:
    """All calendar columns of a profile, each name once."""
    if profile == "library":
        return cal_basic(d) | cal_special(d) | cal_cyclic(d) | cal_market(d)
    if profile != "notebook":
        raise ValueError(f"unknown calendar profile: {profile}")
    holidays = cal_holidays(d)
    out = cal_basic_nb(d) | cal_extra(d)
    out |= {k: v for k, v in holidays.items() if k not in _MARKET_NB}
    out |= cal_seasons(d)
    if market:
        out |= cal_trading(d)
        out |= {k: holidays[k] for k in _MARKET_NB}
    return out
