"""Calendar attributes of a date column (ISO weeks and weekdays)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from spendlake import fixed_values as FV


def _name_of(index: Column, names: list[str]) -> Column:
    out = None
    for i, name in enumerate(names, start=1):
        out = (F.when(index == i, F.lit(name)) if out is None else out.when(index == i, F.lit(name)))
    return out


def calendar_columns(d: Column) -> dict[str, Column]:
    """All calendar attributes of ``d`` as named columns, in output order."""
    iso_dow = F.extract(F.lit("DAYOFWEEK_ISO"), d).cast("int")
    month = F.month(d)
    quarter = F.quarter(d)
    return {
        "date_key": d,
        "date_day": d,
        "year": F.year(d),
        "quarter": quarter,
        "month": month,
        "week_of_year": F.weekofyear(d),
        "day_of_month": F.dayofmonth(d),
        "day_of_year": F.dayofyear(d),
        "day_of_week": iso_dow,
        "day_name": _name_of(iso_dow, FV.DAY_NAMES),
        "is_weekend": iso_dow.isin(6, 7),
        "month_name": _name_of(month, FV.MONTH_NAMES),
        "year_month": F.date_format(d, "yyyy-MM"),
        "year_quarter": F.concat(F.date_format(d, "yyyy"), F.lit("-Q"), quarter.cast("string")),
        "is_first_day_of_month": d == F.trunc(d, "month"),
        "is_last_day_of_month": d == F.last_day(d),
    }
