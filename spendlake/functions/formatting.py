"""Display texts for report values."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from spendlake import fixed_values as FV


def money_text(c: Column, unit: str = FV.DEFAULT_CURRENCY) -> Column:
    """``12,345.60 DKK``: thousands separators, two decimals, unit suffix."""
    return F.concat(F.format_number(c, 2), F.lit(" " + unit))


def int_text(c: Column) -> Column:
    """``12,345``."""
    return F.format_number(c, 0)


def percent_share(part: Column, whole: Column, digits: int = 1) -> Column:
    """Percentage with ``digits`` decimals; NULL when the whole is zero."""
    return F.round(F.try_divide(part * F.lit(100.0), whole.cast("double")), digits)
