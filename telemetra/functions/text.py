"""String helpers: ids, paths and output names."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from telemetra.constants import (
    CSV_NAME_PATTERN, CSV_PART_NAME, CSV_SINGLE_NAME, EXPORT_NAME, EXPORT_NAME_STAMP, PERIOD_LABEL_FORMAT,
    PERIOD_LABEL_SEP,
)


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def normalise_id(x) -> Column:
    """drop hyphens, lower-case."""
    return F.lower(F.replace(_c(x).cast("string"), F.lit("-"), F.lit("")))


def to_str(x) -> Column:
    """string rendering of ids and tag names."""
    return _c(x).cast("string")


def blank_to_null(x) -> Column:
    """trimmed text, NULL when empty."""
    return F.nullif(F.trim(_c(x)), F.lit(""))


def base_name(path) -> Column:
    """last path component."""
    return F.element_at(F.split(_c(path), "/"), -1)


def parent_dir(path) -> Column:
    """name of the folder holding the file (e.g. the month folder)."""
    return F.element_at(F.split(_c(path), "/"), -2)


def has_prefix(x, prefix: str) -> Column:
    """prefix test."""
    return _c(x).startswith(prefix)


def parse_csv_name_process(path) -> Column:
    """process id from ``processo_<id>[-parteN].csv``; the whole base name when no match."""
    b = base_name(path)
    return F.coalesce(F.nullif(F.regexp_extract(b, CSV_NAME_PATTERN, 1), F.lit("")), b)


def parse_csv_name_part(path) -> Column:
    """part number from ``-parteN``; 0 when absent."""
    b = base_name(path)
    p = F.regexp_extract(b, CSV_NAME_PATTERN, 2)
    return F.when(p == "", F.lit(0)).otherwise(p.cast("int"))


def csv_part_name(process_id, part, parts) -> Column:
    """``processo_<id>.csv`` for a single chunk, ``processo_<id>-parte<i>.csv`` otherwise."""
    return F.when(_c(parts) <= 1, F.format_string(CSV_SINGLE_NAME, _c(process_id))).otherwise(
        F.format_string(CSV_PART_NAME, _c(process_id), _c(part)))


def export_file_name(company_id, start, end) -> Column:
    """``<company>_<yyyy-MM-dd_HHmmss>_a_<yyyy-MM-dd_HHmmss>.csv``."""
    return F.format_string(EXPORT_NAME, _c(company_id),
                           F.date_format(_c(start), EXPORT_NAME_STAMP),
                           F.date_format(_c(end), EXPORT_NAME_STAMP))


def period_label(start, end) -> Column:
    """``<start> → <end>`` with second precision."""
    return F.concat_ws(PERIOD_LABEL_SEP, F.date_format(_c(start), PERIOD_LABEL_FORMAT),
                       F.date_format(_c(end), PERIOD_LABEL_FORMAT))
