"""Value rules: sentinels, dates, ratios and three-valued flags."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import col_of

# Day-first-free US date text as filed (month/day/year); one-digit month or
# day is accepted as well as two.
US_DATE = "M/d/yyyy"


def sentinel_to_null(c, sentinel: str, to_type: str | None = None) -> Column:
    """NULL where the value equals ``sentinel``; optional strict cast.

    With ANSI mode on, any other non-castable text raises, as intended.
    """
    out = F.nullif(col_of(c), F.lit(sentinel))
    return out.cast(to_type) if to_type else out


def parse_date(c, fmt: str = US_DATE, lenient: bool = False) -> Column:
    """Text date to DateType. Bad text raises unless ``lenient``."""
    c = col_of(c)
    return F.try_to_date(c, F.lit(fmt)) if lenient else F.to_date(c, fmt)


def sum_parts(*cols) -> Column:
    """Plain sum of columns; NULL if any part is NULL (no coalesce)."""
    return reduce(lambda a, b: a + b, [col_of(c) for c in cols])


def ratio(num, den) -> Column:
    """Unguarded fractional ratio: raises on a zero denominator (ANSI)."""
    return col_of(num).cast("double") / col_of(den).cast("double")


def guarded_ratio(num, den) -> Column:
    """num / den when den > 0, else NULL (also NULL when den is NULL)."""
    den = col_of(den)
    return F.when(den > 0, col_of(num).cast("double") / den.cast("double"))


def range_flag(c, lo: float = 0.0, hi: float = 1.0) -> Column:
    """NULL when the value is unknown, else whether it lies outside [lo, hi]."""
    c = col_of(c)
    return F.when(c.isNotNull(), (c < lo) | (c > hi))


def known_and_different(a, b) -> Column:
    """NULL unless both sides are known; then whether they differ."""
    a, b = col_of(a), col_of(b)
    return F.when(a.isNotNull() & b.isNotNull(), ~a.eqNullSafe(b))


def stable_round(c, digits: int = 6) -> Column:
    """Round half up to ``digits`` decimals as plain IEEE arithmetic,
    ``floor(x * 10^d + 0.5) / 10^d``, and fold -0.0 into 0.0. NULL and NaN
    stay, and so does a value too large to have that many decimals in a
    double.

    Unlike an engine's decimal ``round`` this is the same bit-for-bit
    computation everywhere. It serves comparisons; stored results keep
    their full values.
    """
    scale = float(10 ** digits)
    x = col_of(c).cast("double")
    rounded = F.floor(x * F.lit(scale) + F.lit(0.5)).cast("double") / F.lit(scale) + F.lit(0.0)
    return F.when(F.abs(x) < F.lit(2.0 ** 53 / scale), rounded).otherwise(x)
