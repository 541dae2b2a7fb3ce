"""Wide ↔ long reshapes (R1 fixed columns, R2, A7, O2)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from telemetra.constants import EXPORT_TS_COLUMN
from telemetra.functions.timefmt import minute_label


def unpivot_columns(df: DataFrame, ids: list[str], measures: list[str],
                    tag_col: str = "tag_id", value_col: str = "value") -> DataFrame:
    """R1 (fixed columns): one row per (id, measure) with a non-null, finite value."""
    cast = df.select(*ids, *[F.col(m).cast("double").alias(m) for m in measures])
    long = cast.unpivot(ids, measures, tag_col, value_col)
    v = F.col(value_col)
    return long.where(v.isNotNull() & ~F.isnan(v) & (F.abs(v) != F.lit(float("inf"))))


def first_non_null_cells(long: DataFrame, order_col: str | None = None,
                         keys=("ts", "tag_id"), value_col: str = "value") -> DataFrame:
    """One value per (ts, tag): the first non-null one.

    With ``order_col`` (an ingest sequence) "first" is the lowest sequence — deterministic
    and computed as a two-phase ``min_by`` aggregate, so a hot (ts, tag) pair is combined
    map-side before the shuffle. Without it, ``first(ignorenulls)`` is used.
    """
    nn = long.where(F.col(value_col).isNotNull())
    if order_col:
        agg = F.min_by(F.col(value_col), F.col(order_col))
    else:
        agg = F.first(F.col(value_col), ignorenulls=True)
    return nn.groupBy(*keys).agg(agg.alias(value_col))


def pivot_wide(long: DataFrame, tags: list[str] | None = None, order_col: str | None = None,
               ts_col: str = "ts", tag_col: str = "tag_id", value_col: str = "value") -> DataFrame:
    """R2: one row per ts, one column per tag (sorted by name), cell = first non-null value.

    All-null tags and all-null timestamps vanish because NULL values are removed before the
    pivot; so do requested tags without any value. The tags present are listed first and
    given to the pivot, so their number has no limit but that of a frame's columns; for a
    wide file of any number of tags see ``wide_lines``.
    """
    cells = first_non_null_cells(long, order_col, (ts_col, tag_col), value_col)
    listed = cells if tags is None else cells.where(F.col(tag_col).isin(*sorted(set(tags))) if tags else F.lit(False))
    present = sorted(r[0] for r in listed.select(tag_col).where(F.col(tag_col).isNotNull()).distinct().collect())  # column names
    if not present:
        return cells.select(ts_col).where(F.lit(False))
    wide = cells.groupBy(ts_col).pivot(tag_col, present).agg(F.first(value_col))
    return wide.select(ts_col, *[F.col(f"`{t.replace('`', '``')}`") for t in present])


def export_counts(long: DataFrame, by=("company_id",)) -> DataFrame:
    """Points read and periods (rows of the wide file) of an export's long rows."""
    return long.groupBy(*by).agg(F.count(F.lit(1)).alias("points"),
                                 F.count_distinct(F.when(F.col("value").isNotNull(), F.col("ts"))).alias("periods"))


def wide_lines(cells: DataFrame, tags: list[str], sep: str = ";", ts_col: str = "ts",
               tag_col: str = "tag_id", value_col: str = "value") -> DataFrame:
    """R2 + O2 + F12 as text: one ``(ts, line)`` per timestamp, for any number of tags.

    ``cells`` has one non-null value a (ts, tag); ``tags`` are the columns in order. A row
    is kept sparse, as its (position, text) pairs; the separators of the gaps between them
    are put in when the line is rendered, so a line costs what it holds.
    """
    places = cells.sparkSession.createDataFrame([(t, i) for i, t in enumerate(tags, 1)], f"{tag_col} string, _at int")
    pair = F.struct("_at", F.col(value_col).cast("string").alias("text"))
    rows = cells.join(places, tag_col).groupBy(ts_col).agg(F.array_sort(F.collect_list(pair)).alias("_e"))
    e, at = F.col("_e"), lambda i: F.element_at("_e", i)["_at"]
    gap = F.transform(e, lambda x, i: F.concat(F.repeat(F.lit(sep), x["_at"] - F.when(i == 0, 0).otherwise(e[i - 1]["_at"])), x["text"]))
    rest = F.repeat(F.lit(sep), F.lit(len(tags)) - at(-1))
    return rows.select(ts_col, F.concat(minute_label(F.col(ts_col)), F.array_join(gap, ""), rest).alias("line"))


def wide_export_frame(wide: DataFrame, ts_col: str = "ts") -> DataFrame:
    """O2 + F12: rows ordered by ts, first column ``TIMESTAMP`` as ``yyyy-MM-dd HH:mm``."""
    tags = [c for c in wide.columns if c != ts_col]
    return (wide.orderBy(ts_col)
                .select(minute_label(F.col(ts_col)).alias(EXPORT_TS_COLUMN),
                        *[F.col(f"`{t.replace('`', '``')}`") for t in tags]))
