"""Column expressions (all JVM-side built-ins, no Python UDF)."""

from spendlake.functions.calendar import calendar_columns
from spendlake.functions.formatting import int_text, money_text, percent_share
from spendlake.functions.text import (
    account_from_file_name,
    amount_hash_text,
    decode_file_name,
    empty_to_null,
    parse_locale_decimal,
    pending_to_null,
    row_hash,
    search_mask,
)

__all__ = [
    "account_from_file_name",
    "amount_hash_text",
    "calendar_columns",
    "decode_file_name",
    "empty_to_null",
    "int_text",
    "money_text",
    "parse_locale_decimal",
    "pending_to_null",
    "percent_share",
    "row_hash",
    "search_mask",
]
