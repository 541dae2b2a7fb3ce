"""Row filters and projections."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from telemetra.functions.timefmt import month_key

# Tag lists longer than this become a semi-join instead of an IN list.
IN_LIST_MAX = 500


def _ts(v):
    return F.lit(v).cast("timestamp_ntz") if not hasattr(v, "alias") else v


def company_filter(df: DataFrame, company_id: str, col: str = "company_id") -> DataFrame:
    """``company_id = ?`` (prunes the company partition when stored partitioned)."""
    return df.where(F.col(col) == F.lit(company_id))


def period_inclusive(df: DataFrame, start, end, ts: str = "ts", month_col: str | None = None) -> DataFrame:
    """``start <= ts <= end``. With ``month_col`` the yyyyMM bounds are added too, so a
    table partitioned by month is pruned (a ts predicate alone cannot prune a derived column)."""
    s, e = _ts(start), _ts(end)
    out = df.where((F.col(ts) >= s) & (F.col(ts) <= e))
    if month_col:
        out = out.where((F.col(month_col) >= month_key(s)) & (F.col(month_col) <= month_key(e)))
    return out


def period_half_open(df: DataFrame, start, end, ts: str = "ts") -> DataFrame:
    """P10: ``start <= ts < end``."""
    return df.where((F.col(ts) >= _ts(start)) & (F.col(ts) < _ts(end)))


def last_n_days(df: DataFrame, now, days: int, ts: str = "ts") -> DataFrame:
    """``ts >= now − N days``."""
    return df.where(F.col(ts) >= _ts(now) - F.make_dt_interval(days=F.lit(days)))


def tag_in_list(df: DataFrame, tags, col: str = "tag_id") -> DataFrame:
    """Optional tag restriction. ``None``/empty = all tags. A long list (or a DataFrame
    of tags) becomes a semi-join, whose strategy the planner picks by the table's bytes."""
    if tags is None:
        return df
    if isinstance(tags, DataFrame):
        return df.join(tags.select(F.col(tags.columns[0]).alias(col)).distinct(), col, "left_semi")
    tags = list(tags)
    if not tags:
        return df
    if len(tags) <= IN_LIST_MAX:
        return df.where(F.col(col).isin(*tags))
    t = df.sparkSession.createDataFrame([(x,) for x in sorted(set(tags))], [col])
    return df.join(t, col, "left_semi")


def active_of_type(df: DataFrame, config_type: str) -> DataFrame:
    """``active = true AND type = ?``."""
    return df.where(F.col("active") & (F.col("type") == F.lit(config_type)))


def process_filter(df: DataFrame, process_id: str | None, col: str = "process_id") -> DataFrame:
    """Optional equality on process_id."""
    return df if process_id is None else df.where(F.col(col) == F.lit(process_id))


def project_rename(df: DataFrame, mapping: dict[str, str]) -> DataFrame:
    """Select and rename, e.g. ``{"timestamp": "ts", "tagId": "tag_id", "value": "value"}``."""
    return df.select(*[F.col(src).alias(dst) for src, dst in mapping.items()])


def changed(resolved: str = "resolved_unit_id", stored: str = "unit_id"):
    """Stored value differs from the resolved one (NULL counts as different)."""
    return ~F.col(stored).eqNullSafe(F.col(resolved))


def drop_null_ids(df: DataFrame, col: str = "process_id") -> DataFrame:
    """Ignore NULL ids, cast the rest to string."""
    return df.where(F.col(col).isNotNull()).withColumn(col, F.col(col).cast("string"))
