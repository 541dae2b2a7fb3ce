"""Numeric coercion and formatting."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from telemetra.constants import TRUE_WORDS

# A plain decimal literal: sign, digits with an optional fraction, optional exponent.
# Guards try_cast, which also accepts Java suffixes (1.0d, 1.0f) and hex floats (0x1p3).
DECIMAL_TEXT = r"^\s*[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?\s*$"


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def is_nan(x) -> Column:
    """NaN (NULL stays NULL)."""
    x = _c(x)
    return F.when(x.isNotNull(), F.isnan(x))


def is_inf(x) -> Column:
    """±Infinity (NULL stays NULL)."""
    return F.abs(_c(x)) == F.lit(float("inf"))


def is_nan_or_inf(x) -> Column:
    """NaN or ±Infinity (NULL stays NULL)."""
    return is_nan(x) | is_inf(x)


def is_finite(x) -> Column:
    """Non-null, not NaN, not infinite."""
    x = _c(x)
    return x.isNotNull() & ~is_nan_or_inf(x)


def decimal_double(text) -> Column:
    """Text (or number) → DOUBLE when it is a decimal number, which may be too large to be finite."""
    t = _c(text).cast("string")
    return F.when(t.rlike(DECIMAL_TEXT), F.trim(t).try_cast("double"))


def finite_double(text) -> Column:
    """Text (or number) → DOUBLE when it is a finite decimal number, else NULL."""
    v = decimal_double(text)
    return F.when(is_finite(v), v)


def bool_text(text, default: bool = False) -> Column:
    """'1'/'true'/'yes'/'sim' (any case, trimmed) → true; NULL → default."""
    t = _c(text)
    return F.when(t.isNull(), F.lit(default)).otherwise(
        F.lower(F.trim(t.cast("string"))).isin(*TRUE_WORDS))


def safe_rate(rows, seconds) -> Column:
    """rows / seconds, 0 when seconds is not positive."""
    rows, seconds = _c(rows), _c(seconds)
    return F.when(seconds > 0, rows.cast("double") / seconds.cast("double")).otherwise(F.lit(0.0))


def thousands(n) -> Column:
    """integer with ',' thousands separators, e.g. 1234567 → '1,234,567'."""
    return F.format_number(_c(n).cast("long"), 0)
