"""Timestamp parsing, shifting and labelling.

Convention: every timestamp the library produces is TIMESTAMP_NTZ holding UTC wall-clock
time. Parsing goes through TIMESTAMP (session zone UTC, see ``session.configure``) so that
offsets such as ``+02:00`` or ``Z`` are converted to UTC before the zone is dropped.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from telemetra.constants import EXPORT_TS_FORMAT, PERIOD_FORMATS


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def parse_utc(text) -> Column:
    """Text → UTC TIMESTAMP_NTZ.

    Accepts minutes-only and seconds precision in the same column, fractions, ``T``/space,
    ``Z`` and numeric offsets (converted to UTC); naive text is taken as UTC. NULL when the
    text is not a timestamp. An already-typed timestamp column passes through.
    """
    c = _c(text)
    return c.cast("string").try_cast("timestamp").cast("timestamp_ntz")


def shift_hours(ts, hours) -> Column:
    """fixed clock shift by a (per-row) number of hours — arithmetic, not a zone change."""
    h = hours if isinstance(hours, Column) else F.lit(int(hours))
    return _c(ts) + F.make_dt_interval(hours=h.cast("int"))


def cutoff(now, hours) -> Column:
    """F16: now − hours."""
    return shift_hours(now, -hours if isinstance(hours, int) else -hours)


def month_key(ts) -> Column:
    """``yyyyMM`` partition key."""
    return F.date_format(_c(ts), "yyyyMM")


def month_dash(ts) -> Column:
    """``yyyy-MM`` folder label."""
    return F.date_format(_c(ts), "yyyy-MM")


def minute_label(ts) -> Column:
    """``yyyy-MM-dd HH:mm`` (seconds truncated only in the text)."""
    return F.date_format(_c(ts), EXPORT_TS_FORMAT)


def month_series(now, days_back: int) -> Column:
    """array of month starts (TIMESTAMP_NTZ) from the month of (now − days) up to now."""
    n = _c(now)
    first = F.trunc(F.to_date(n - F.make_dt_interval(days=F.lit(days_back))), "MM")
    months = F.sequence(first, F.to_date(n), F.expr("INTERVAL 1 MONTH"))
    return F.transform(months, lambda d: d.cast("timestamp_ntz"))


def parse_period_bound(text) -> Column:
    """first of the accepted formats that parses, as TIMESTAMP_NTZ; NULL if none."""
    t = F.trim(_c(text).cast("string"))
    return F.coalesce(*[F.try_to_timestamp(t, F.lit(f)) for f in PERIOD_FORMATS]).cast("timestamp_ntz")


def clamp_end(end, now) -> Column:
    """end clamped to now."""
    return F.least(_c(end), _c(now))


def period_error(start, end, now) -> Column:
    """validation message for a period, NULL when valid."""
    s, e, n = _c(start), _c(end), _c(now)
    return (F.when(s.isNull(), F.lit("invalid_start"))
             .when(e.isNull(), F.lit("invalid_end"))
             .when(s > e, F.lit("start_after_end"))
             .when(s > n, F.lit("start_in_future")))


def midpoint(start, end) -> Column:
    """start + (end − start)/2 at microsecond precision, halves rounded to even."""
    a = F.unix_micros(_c(start).cast("timestamp"))
    b = F.unix_micros(_c(end).cast("timestamp"))
    half = F.bround((b - a).cast("double") / 2.0).cast("long")
    return F.timestamp_micros(a + half).cast("timestamp_ntz")
