"""Dates and their parts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T


def to_day(df: DataFrame, column: str) -> Column:
    """The date of ``column``. Text that is no date gives NULL, also in ANSI mode,
    where ``to_date`` would raise."""
    if isinstance(df.schema[column].dataType, T.StringType):
        return F.try_to_date(F.col(column))
    return F.to_date(F.col(column))


def calendar_columns(day: str) -> dict[str, Column]:
    """Output name -> date part of column ``day``. Weekdays count from Sunday = 1."""
    date = F.col(day)
    return {
        "anio": F.year(date),
        "mes": F.month(date),
        "dia": F.dayofmonth(date),
        "trimestre": F.quarter(date),
        "nombre_mes": F.date_format(date, "MMMM"),
        "nombre_dia": F.date_format(date, "EEEE"),
        "numero_dia_semana": F.dayofweek(date),
    }
