"""Date, calendar and period helpers.

Period arithmetic works on parameters (a handful of dates chosen by the user), so it runs on the driver and
reaches Spark as literals or as a tiny periods table; row dates are only touched by Column builders.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from bizlens.functions.common import col_of

# Fixed values that must equal the source behaviour.
# Day names by Spark dayofweek-1 (Sunday = 0), pt-BR.
WEEKDAY_NAMES_SUNDAY_FIRST = ["Domingo", "Segunda-feira", "Terça-feira", "Quarta-feira", "Quinta-feira",
                              "Sexta-feira", "Sábado"]
# Short day names by Monday = 0.
WEEKDAY_SHORT_MONDAY_FIRST = ["Seg", "Ter", "Qua", "Qui", "Sex", "Sáb", "Dom"]
# Month abbreviations 1..12, pt-BR.
MONTH_ABBR_PT = ["jan", "fev", "mar", "abr", "mai", "jun", "jul", "ago", "set", "out", "nov", "dez"]
# English month names 1..12 (calendar ``nome_mes``).
MONTH_NAMES_EN = ["January", "February", "March", "April", "May", "June", "July", "August", "September",
                  "October", "November", "December"]
# Calendar bounds and dashboard presets.
CALENDAR_START = dt.date(2023, 1, 1)
CALENDAR_END = dt.date(2030, 12, 31)
HISTORY_START = dt.date(2023, 8, 1)
MANAGEMENT_CUTOVER = dt.date(2025, 8, 17)
PRESET_DAYS = {"30 dias": 30, "3 meses": 90, "6 meses": 180, "1 ano": 365}
# Granularity thresholds on (end - start) days.
DAILY_MAX_SPAN = 60
WEEKLY_MAX_SPAN = 180
YOY_SHIFT_DAYS = 365


# ---------------------------------------------------------------------------------------------- periods
@dataclass(frozen=True)
class Period:
    name: str
    start: dt.date
    end: dt.date


def previous_period(start: dt.date, end: dt.date) -> tuple[dt.date, dt.date]:
    """Same length, ending the day before ``start``."""
    length = end - start + dt.timedelta(days=1)
    return start - length, start - dt.timedelta(days=1)


def same_period_last_year(start: dt.date, end: dt.date) -> tuple[dt.date, dt.date]:
    """Shift by 365 days (not one calendar year)."""
    shift = dt.timedelta(days=YOY_SHIFT_DAYS)
    return start - shift, end - shift


def comparison_periods(start: dt.date, end: dt.date) -> list[Period]:
    return [Period("atual", start, end), Period("anterior", *previous_period(start, end)),
            Period("ano_anterior", *same_period_last_year(start, end))]


def periods_frame(spark: SparkSession, periods: list[Period]) -> DataFrame:
    """The periods as a tiny DataFrame (one row each, ordinal kept for sorting)."""
    rows = [(i, p.name, p.start, p.end, (p.end - p.start).days + 1) for i, p in enumerate(periods)]
    return spark.createDataFrame(rows, "ordem int, periodo string, inicio date, fim date, dias int")


def period_tags(day, periods: list[Period]) -> Column:
    """Array of the names of the periods containing ``day`` (periods may overlap)."""
    d = col_of(day)
    return F.array_compact(F.array(*[F.when(d.between(F.lit(p.start), F.lit(p.end)), F.lit(p.name))
                                     for p in periods]))


def any_period(day, periods: list[Period]) -> Column:
    d = col_of(day)
    cond = None
    for p in periods:
        c = d.between(F.lit(p.start), F.lit(p.end))
        cond = c if cond is None else cond | c
    return cond


# ---------------------------------------------------------------------------------------------- granularity
def granularity(start: dt.date, end: dt.date) -> str:
    """``D`` up to 60 days, ``W`` (weeks ending Monday) up to 180, else ``M`` (month start)."""
    span = (end - start).days
    if span <= DAILY_MAX_SPAN:
        return "D"
    if span <= WEEKLY_MAX_SPAN:
        return "W"
    return "M"


def bucket(day, grain: str) -> Column:
    d = col_of(day)
    if grain == "D":
        return d
    if grain == "W":
        return week_ending_monday(d)
    if grain == "M":
        return F.trunc(d, "MM")
    raise ValueError(f"unknown granularity {grain!r}")


def bucket_step(grain: str) -> Column:
    return {"D": F.expr("INTERVAL 1 DAY"), "W": F.expr("INTERVAL 7 DAYS"), "M": F.expr("INTERVAL 1 MONTH")}[grain]


def week_ending_monday(day) -> Column:
    """Right-closed weekly bucket labelled by its Monday: Tue..Mon -> that Monday."""
    d = col_of(day)
    return F.date_add(d, (F.lit(9) - F.dayofweek(d)) % 7)


def bucket_label(bucket_col, grain: str) -> Column:
    """``dd/MM`` for daily/weekly buckets, ``mmm/yyyy`` (pt-BR month) for monthly ones."""
    b = col_of(bucket_col)
    if grain == "M":
        return F.concat(month_abbr_pt(F.month(b)), F.lit("/"), F.year(b).cast("string"))
    return F.date_format(b, "dd/MM")


def month_abbr_pt(month_col) -> Column:
    return F.element_at(F.array(*[F.lit(m) for m in MONTH_ABBR_PT]), col_of(month_col))


# ---------------------------------------------------------------------------------------------- calendar
def weekday_sunday0(day) -> Column:
    return F.dayofweek(col_of(day)) - 1


def weekday_monday0(day) -> Column:
    return F.weekday(col_of(day))


def weekday_name_pt(day) -> Column:
    return F.element_at(F.array(*[F.lit(n) for n in WEEKDAY_NAMES_SUNDAY_FIRST]), F.dayofweek(col_of(day)))


def weekday_short_pt(monday0) -> Column:
    return F.element_at(F.array(*[F.lit(n) for n in WEEKDAY_SHORT_MONDAY_FIRST]), (col_of(monday0) + 1).cast("int"))


def month_name_en(day) -> Column:
    return F.element_at(F.array(*[F.lit(n) for n in MONTH_NAMES_EN]), F.month(col_of(day)))


def calendar_columns(day) -> list[Column]:
    d = col_of(day)
    return [
        d.alias("data"),
        F.year(d).cast("bigint").alias("ano"),
        F.month(d).cast("bigint").alias("mes"),
        F.dayofmonth(d).cast("bigint").alias("dia"),
        weekday_name_pt(d).alias("dia_semana"),
        month_name_en(d).alias("nome_mes"),
        F.quarter(d).cast("bigint").alias("trimestre"),
        F.date_format(d, "yyyyMM").cast("int").alias("ano_mes"),
    ]


def date_spine(bounds: DataFrame, start_col: str, end_col: str, step: Column, name: str = "data") -> DataFrame:
    """One row per step between each row's bounds (inclusive), via ``sequence`` + ``explode``."""
    return bounds.select(F.explode(F.sequence(F.col(start_col), F.col(end_col), step)).alias(name))


def month_spine(bounds: DataFrame, start_col: str, end_col: str, name: str = "data_competencia") -> DataFrame:
    """Inclusive month starts between two dates (both truncated to day 1)."""
    return bounds.select(F.explode(F.sequence(F.trunc(F.col(start_col), "MM"), F.trunc(F.col(end_col), "MM"),
                                              F.expr("INTERVAL 1 MONTH"))).alias(name))
