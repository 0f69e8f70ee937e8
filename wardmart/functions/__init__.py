"""Column-level functions (JVM-side expressions only)."""

from .dates import calendar_columns, date_key
from .keys import NULL_TOKEN, dealt_packed, surrogate_key
from .text import col_of, pad_id, quote, squash_upper, strip_ws
from .values import (US_DATE, guarded_ratio, known_and_different, parse_date, range_flag,
                     ratio, sentinel_to_null, stable_round, sum_parts)

__all__ = [
    "calendar_columns", "date_key", "NULL_TOKEN", "dealt_packed", "surrogate_key", "col_of", "pad_id",
    "quote", "squash_upper", "strip_ws", "US_DATE", "guarded_ratio", "known_and_different",
    "parse_date", "range_flag", "ratio", "sentinel_to_null", "stable_round", "sum_parts",
]
