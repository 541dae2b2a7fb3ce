"""Scalar Column builders. Every function returns a ``pyspark.sql.Column`` made only of
built-in expressions, so it stays inside whole-stage code generation."""

from telemetra.functions.numbers import (  # noqa: F401
    bool_text, finite_double, is_finite, is_nan_or_inf, safe_rate, thousands,
)
from telemetra.functions.text import (  # noqa: F401
    base_name, blank_to_null, csv_part_name, export_file_name, has_prefix, normalise_id,
    parent_dir, parse_csv_name_part, parse_csv_name_process, period_label, to_str,
)
from telemetra.functions.timefmt import (  # noqa: F401
    cutoff, midpoint, minute_label, month_dash, month_key, month_series, parse_period_bound,
    parse_utc, period_error, shift_hours, clamp_end,
)
