"""Calendar columns and the sliding extract window."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

# Month names used by the time dimension.
MONTH_NAMES = (
    "Janeiro", "Fevereiro", "Março", "Abril", "Maio", "Junho",
    "Julho", "Agosto", "Setembro", "Outubro", "Novembro", "Dezembro",
)

# Runs up to this day of the month also re-read the whole previous month.
WINDOW_CUTOFF_DAY = 10


def run_date(text: str) -> dt.date:
    """Parse a ``YYYY-MM-DD`` run date; anything else raises ValueError."""
    return dt.datetime.strptime(text, "%Y-%m-%d").date()


def extract_window(day: dt.date) -> tuple[dt.date, dt.date]:
    """First and last day (both inclusive) a run on ``day`` re-reads."""
    first = day.replace(day=1)
    if day.day <= WINDOW_CUTOFF_DAY:
        first = (first - dt.timedelta(days=1)).replace(day=1)
    return first, day


def extract_window_start(day: Column) -> Column:
    """``extract_window`` start as a column, for many run dates at once."""
    month = F.trunc(day, "month")
    return F.when(
        F.dayofmonth(day) <= WINDOW_CUTOFF_DAY, F.add_months(month, -1)
    ).otherwise(month)


def hour_key(day: Column, hour: Column) -> Column:
    """``yyyyMMddHH`` as a long. Widened first: an int product overflows."""
    return (
        F.year(day).cast("long") * 1000000
        + F.month(day) * 10000
        + F.dayofmonth(day) * 100
        + hour
    )


def hour_key_of(ts: Column) -> Column:
    """Hour key of a timestamp, in the session time zone (pinned to UTC).

    Arithmetic on date parts stays in generated code; formatting to text and
    parsing it back costs several times as much per row.
    """
    return hour_key(ts, F.hour(ts))


def month_name(day: Column) -> Column:
    return F.element_at(F.array(*[F.lit(m) for m in MONTH_NAMES]), F.month(day))


def calendar_columns(day: Column, hour: Column) -> list[Column]:
    """The attributes of one hour of one day."""
    return [
        hour_key(day, hour).alias("date_key"),
        day.alias("data"),
        hour.cast("int").alias("hora"),
        F.dayofweek(day).alias("dia_semana"),
        F.weekofyear(day).alias("semana_ano"),
        F.month(day).alias("mes"),
        F.quarter(day).alias("trimestre"),
        F.year(day).alias("ano"),
        month_name(day).alias("nome_mes"),
    ]
