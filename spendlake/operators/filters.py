"""Report filters: date range, category and type lists, calendar slicers."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def date_range(frame: DataFrame, start: dt.date | str | None = None, end: dt.date | str | None = None,
               default_days: int = 90) -> DataFrame:
    """Inclusive range on ``date_day``.  Without bounds the default is the
    last ``default_days`` days up to the latest date; the bound is a scalar
    subquery planned by Catalyst, nothing is collected.

    A row's ``date_day`` is its ``date_key``, so the same bounds go on the key
    and, for a stored fact, on its month partitions: files outside are not read."""
    day = F.col("date_day")
    if start is None and end is None:
        latest = frame.select(F.max("date_day")).scalar()
        lo, hi = F.date_sub(latest, default_days), latest
    else:
        lo = None if start is None else F.lit(start).cast("date")
        hi = None if end is None else F.lit(end).cast("date")
    cond = day.isNotNull()
    days = [day] + [F.col("date_key")] * ("date_key" in frame.columns)
    for c in days:
        if lo is not None:
            cond = cond & (c >= lo)
        if hi is not None:
            cond = cond & (c <= hi)
    if "month_start" in frame.columns:
        if lo is not None:
            cond = cond & (F.col("month_start") >= F.trunc(lo, "month"))
        if hi is not None:
            cond = cond & (F.col("month_start") <= F.trunc(hi, "month"))
    return frame.filter(cond)


def categories(frame: DataFrame, names: Sequence[str] | None) -> DataFrame:
    """Category IN-list; no filter when the list is empty or holds ``All``."""
    if not names or "All" in names:
        return frame
    return frame.filter(F.col("category_name").isin(list(names)))


def transaction_types(frame: DataFrame, types: Sequence[str] = ("credit", "debit")) -> DataFrame:
    """Type IN-list; an empty list keeps no rows."""
    if not types:
        return frame.filter(F.lit(False))
    return frame.filter(F.col("transaction_type").isin(list(types)))


def slicers(frame: DataFrame, year: int | None = None, quarter: int | None = None,
            month: int | None = None, account: str | None = None) -> DataFrame:
    """Calendar and account slicers on dimension columns."""
    conds = []
    if year is not None:
        conds.append(F.col("year") == year)
    if quarter is not None:
        conds.append(F.col("quarter") == quarter)
    if month is not None:
        conds.append(F.col("month") == month)
    if account is not None:
        conds.append(F.col("account_number") == account)
    for c in conds:
        frame = frame.filter(c)
    return frame


def dashboard(frame: DataFrame, start=None, end=None, names=None, types=("credit", "debit")) -> DataFrame:
    """The three sidebar filters in their order: dates, categories, types."""
    return transaction_types(categories(date_range(frame, start, end), names), types)
