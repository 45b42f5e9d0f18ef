"""Calendar attributes, all as built-in expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Calendar names of the date dimension.
MONTH_NAMES = (
    "Enero", "Febrero", "Marzo", "Abril", "Mayo", "Junio",
    "Julio", "Agosto", "Septiembre", "Octubre", "Noviembre", "Diciembre",
)
WEEKDAY_NAMES = ("Lunes", "Martes", "Miércoles", "Jueves", "Viernes", "Sábado", "Domingo")


def iso_date(text: Column) -> Column:
    """ISO text to date, NULL when it is not one."""
    return F.try_to_date(text, "yyyy-MM-dd")


def date_key(date: Column) -> Column:
    """20240303 for 2024-03-03, by arithmetic."""
    return (F.year(date) * 10000 + F.month(date) * 100 + F.dayofmonth(date)).cast("int")


def decade_of(year: Column) -> Column:
    return (year - F.pmod(year, F.lit(10))).cast("int")


def year_of_key(date_id: Column) -> Column:
    """The year inside a YYYYMMDD key."""
    return F.floor(date_id / 10000).cast("int")


def _nth(names: tuple[str, ...], position: Column) -> Column:
    return F.element_at(F.array(*[F.lit(n) for n in names]), position)


def date_attributes(date: Column) -> dict[str, Column]:
    """Every column of the date dimension, derived from one date column."""
    return {
        "date_id": date_key(date),
        "date": date,
        "year": F.year(date),
        "month": F.month(date),
        "day": F.dayofmonth(date),
        "quarter": F.quarter(date),
        "decade": decade_of(F.year(date)),
        "month_name": _nth(MONTH_NAMES, F.month(date)),
        # weekday(): Monday is 0
        "weekday_name": _nth(WEEKDAY_NAMES, F.weekday(date) + 1),
        "is_weekend": F.weekday(date) >= 5,
    }
