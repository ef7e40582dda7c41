"""Text expressions used by the load path and the search report."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from spendlake import fixed_values as FV
from spendlake.schemas import MONEY


def empty_to_null(c: Column) -> Column:
    return F.nullif(c, F.lit(""))


def parse_locale_decimal(c: Column) -> Column:
    """``-1.234,56`` -> -1234.56: every ``.`` is a thousands mark, ``,`` the
    decimal mark; empty -> NULL.  A malformed number fails the cast (ANSI)."""
    cleaned = F.replace(F.replace(c, F.lit("."), F.lit("")), F.lit(","), F.lit("."))
    return empty_to_null(cleaned).cast(MONEY)


def pending_to_null(c: Column, marker: str = FV.PENDING_MARKER) -> Column:
    """Pending rows carry a marker (or nothing) instead of a date."""
    return F.nullif(empty_to_null(c), F.lit(marker))


def amount_hash_text(amount: Column) -> Column:
    """Text of a two-decimal amount as a shortest float would print it:
    100.00 -> ``100.0``, 12.50 -> ``12.5``, 12.34 -> ``12.34``."""
    return F.regexp_replace(amount.cast(MONEY).cast("string"), F.lit("0$"), F.lit(""))


def row_hash(date_text: Column, amount: Column, description: Column, name: Column,
             sender: Column, recipient: Column) -> Column:
    """Stable row key: MD5 over the bar-joined texts, NULL as empty."""
    parts = [date_text, amount_hash_text(amount), description, name, sender, recipient]
    return F.md5(F.concat_ws("|", *[F.coalesce(p, F.lit("")) for p in parts]))


def decode_file_name(c: Column) -> Column:
    """``_metadata.file_name`` is URL-encoded; a literal ``+`` must survive."""
    return F.url_decode(F.replace(c, F.lit("+"), F.lit("%2B")))


def account_from_file_name(c: Column, prefix: str = FV.ACCOUNT_FILE_PREFIX,
                           separator: str = FV.ACCOUNT_FILE_SEPARATOR) -> Column:
    """``Konto 0718 - 2024-02-01 08.00.00.csv`` -> ``Konto 0718``; a name
    without the prefix is its own account."""
    return F.when(c.startswith(prefix), F.substring_index(c, separator, 1)).otherwise(c)


def search_mask(term: str, *cols: Column, literal: bool = False) -> Column:
    """Case-insensitive search over several text columns, NULL -> false.

    By default the term is a regular expression (Unicode case folding);
    ``literal=True`` matches it as plain text."""
    if literal:
        needle = F.lower(F.lit(term))
        hits = [F.coalesce(F.contains(F.lower(c), needle), F.lit(False)) for c in cols]
    else:
        pattern = "(?iu)" + term
        hits = [F.coalesce(c.rlike(pattern), F.lit(False)) for c in cols]
    out = hits[0]
    for h in hits[1:]:
        out = out | h
    return out
