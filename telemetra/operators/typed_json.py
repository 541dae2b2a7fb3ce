"""Typed-JSON items → rows.

An *item* is a JSON object whose values are one-key typed attributes
(``{"S": "x"}``, ``{"N": "1.5"}``, ``{"BOOL": true}``, ``{"NULL": true}``, lists, maps, sets,
binary), optionally wrapped as ``{"Item": {...}}``. Items are parsed with ``from_json`` into
``MAP<STRING, STRUCT<S, N, BOOL, NULL, L, M, SS, NS, BS, B>>``; list/map/set/binary values
land as raw JSON text and never become numbers. Everything below is built-in expressions
(``map_filter``/``transform``/``filter`` + ``explode``), no Python per row.

Input frames are *line frames*: ``file STRING, pos BIGINT, value STRING`` where ``pos``
orders lines inside a file (see ``sources.typed_json_files``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from telemetra.constants import HEADER_KEYS, PREDICTIONS_COLUMNS, PROJECTIONS_COLUMNS, READINGS_COLUMNS
from telemetra.functions.numbers import finite_double
from telemetra.functions.timefmt import parse_utc
from telemetra.operators.clock import clock_shift

ATTR_DDL = ("STRUCT<S: STRING, N: STRING, BOOL: BOOLEAN, `NULL`: BOOLEAN, L: STRING, "
            "M: STRING, SS: STRING, NS: STRING, BS: STRING, B: STRING>")
ITEM_DDL = f"MAP<STRING, {ATTR_DDL}>"
WRAPPED_DDL = f"STRUCT<Item: {ITEM_DDL}>"
ROWS_TYPE = "array<struct<tag_id:string,value:double>>"


# --- attribute helpers (F21) ----------------------------------------------------------

def attr_num(a: Column) -> Column:
    """The plain value of a typed attribute as a finite DOUBLE, else NULL.

    N and S go through the decimal-text guard; BOOL is 1.0/0.0; everything else is NULL.
    """
    return (F.when(a["N"].isNotNull(), finite_double(a["N"]))
             .when(a["S"].isNotNull(), finite_double(a["S"]))
             .when(a["BOOL"].isNotNull(), F.when(a["BOOL"], F.lit(1.0)).otherwise(F.lit(0.0))))


def attr_str(a: Column) -> Column:
    """the string form of a typed attribute; NULL for a missing or NULL attribute."""
    return F.coalesce(a["S"], a["N"],
                      F.when(a["BOOL"], F.lit("True")).when(~a["BOOL"], F.lit("False")),
                      a["L"], a["M"], a["SS"], a["NS"], a["BS"], a["B"])


def attr_truthy(a: Column) -> Column:
    """True for a non-empty string, non-zero number or true boolean."""
    return F.coalesce((a["S"] != "") | (F.coalesce(finite_double(a["N"]), F.lit(0.0)) != 0)
                      | F.coalesce(a["BOOL"], F.lit(False)), F.lit(False))


# --- parsing (S1 body, P1, F22) ---------------------------------------------------------

def parse_items(lines: DataFrame, value_col: str = "value") -> DataFrame:
    """Add ``item`` (attribute map, ``Item`` unwrapped) and ``malformed``.

    Blank lines are removed first (they are not items). The wrapped form is parsed only
    for lines that mention ``"Item"``; a line that is not a JSON object has ``malformed``.
    """
    v = F.col(value_col)
    bare = F.from_json(v, ITEM_DDL)
    wrapped = F.from_json(v, WRAPPED_DDL)["Item"]
    item = F.when(F.instr(v, '"Item"') > 0, F.coalesce(wrapped, bare)).otherwise(bare)
    parsed = lines.where(F.trim(v) != "").select("*", F.inline(F.array(F.struct(item.alias("_parsed")))))
    # The parsed map is produced by a one-row generator: later filters and projections
    # then refer to it as a column instead of inlining (re-running) from_json per use.
    return (parsed.select("*", F.inline(F.array(F.struct(_last_keys(F.col("_parsed")).alias("item"))))).drop("_parsed")
                  .withColumn("malformed", F.col("item").isNull()))


def _last_keys(item: Column) -> Column:
    """A JSON object that repeats a key keeps the last value, as JSON readers do."""
    keys, n = F.map_keys(item), F.size(item)
    last = F.filter(F.map_entries(item), lambda e, i: ~F.array_contains(F.slice(keys, i + 2, n), e["key"]))
    return F.when(F.size(F.array_distinct(keys)) < n, F.map_from_entries(last)).otherwise(item)


def _get(key: str) -> Column:
    return F.col("item")[key]


def _has(key: str) -> Column:
    return F.coalesce(F.map_contains_key(F.col("item"), F.lit(key)), F.lit(False))


def raw_ts() -> Column:
    """``timestamp`` when the key exists (even if NULL), else ``ts``."""
    return F.when(_has("timestamp"), attr_str(_get("timestamp"))).otherwise(attr_str(_get("ts")))


def company(default_company: str) -> Column:
    """The item's company when truthy, else the configured default."""
    c = _get("company_id")
    return F.when(_has("company_id") & attr_truthy(c), attr_str(c)).otherwise(F.lit(default_company))


def required() -> Column:
    """The item names a process and has a timestamp."""
    return attr_str(_get("process_id")).isNotNull() & raw_ts().isNotNull()


def is_long() -> Column:
    """The item is one reading with its own tag_id and value, not a row of tags."""
    return _has("tag_id") & _has("value")


def tag_attributes(exclude=HEADER_KEYS) -> Column:
    """The item's attributes without the header's keys, as a map."""
    keys = F.array(*[F.lit(k) for k in exclude])
    return F.map_filter(F.col("item"), lambda k, _v: ~F.array_contains(keys, k))


def tag_rows(exclude=HEADER_KEYS) -> Column:
    """R1 + P15: ARRAY<STRUCT<tag_id, value>> of the numeric non-header attributes."""
    pairs = F.transform(F.map_entries(tag_attributes(exclude)),
                        lambda e: F.struct(e["key"].alias("tag_id"), attr_num(e["value"]).alias("value")))
    return F.filter(pairs, lambda p: p["value"].isNotNull())


def long_row() -> Column:
    """P16 long shape: one (tag_id, value) from the item's own tag_id/value attributes."""
    pair = F.struct(F.coalesce(attr_str(_get("tag_id")), F.lit("None")).alias("tag_id"),
                    attr_num(_get("value")).alias("value"))
    return F.filter(F.array(pair), lambda p: p["value"].isNotNull())


def _rows(items: DataFrame, default_company: str, dispatch: bool) -> DataFrame:
    dated = parse_utc(raw_ts()).isNotNull()
    shaped = F.when(is_long(), long_row()).otherwise(tag_rows()) if dispatch else tag_rows()
    return (items
            .withColumn("rows", F.when(~F.col("malformed") & required() & dated, shaped)
                                 .otherwise(F.array().cast(ROWS_TYPE)))
            .withColumn("process_id", attr_str(_get("process_id")))
            .withColumn("company_id", company(default_company))
            .withColumn("ts_text", raw_ts())
            .withColumn("bad_ts", F.coalesce(~F.col("malformed") & required() & ~dated, F.lit(False)))
            .withColumn("n_rows", F.size("rows")))


def item_rows(items: DataFrame, default_company: str, dispatch: bool = True) -> DataFrame:
    """Per item: ``rows`` array, ``n_rows``, ids and raw ts text (pre-explode frame for A2)."""
    return _rows(items, default_company, dispatch)


def explode_rows(per_item: DataFrame) -> DataFrame:
    """One output row per (item, numeric tag); ts parsed to UTC."""
    return (per_item
                    .select("file", "pos", "company_id", "process_id", "ts_text",
                            F.explode("rows").alias("r"))
                    .select("file", "pos", "company_id", "process_id",
                            F.col("r.tag_id").alias("tag_id"), F.col("r.value").alias("value"),
                            parse_utc(F.col("ts_text")).alias("ts")))


def projections(lines: DataFrame, default_company: str, overrides=None,
                keep_source: bool = False) -> DataFrame:
    """Projections flow: parse → dispatch long/wide → explode → shift.

    Output columns: company_id, process_id, tag_id, value, ts (+ file, pos if keep_source).
    Items whose ts text does not parse give no rows; ``quarantine`` keeps their lines.
    """
    return projection_rows(item_rows(parse_items(lines), default_company, dispatch=True), overrides, keep_source)


def projection_rows(per_item: DataFrame, overrides=None, keep_source: bool = False) -> DataFrame:
    """The rows of items that are parsed already."""
    rows = explode_rows(per_item)
    out = clock_shift(rows.where(F.col("ts").isNotNull()), overrides)
    cols = PROJECTIONS_COLUMNS + (["file", "pos"] if keep_source else [])
    return out.select(*cols)


def variables(lines: DataFrame, company_id: str, overrides=None, keep_source: bool = False) -> DataFrame:
    """Variables flow: like projections, but no long dispatch, company always the configured
    one and process_id used only for the shift, then dropped (P20)."""
    return variable_rows(item_rows(parse_items(lines), company_id, dispatch=False), company_id, overrides, keep_source)


def variable_rows(per_item: DataFrame, company_id: str, overrides=None, keep_source: bool = False) -> DataFrame:
    """The rows of items that are parsed already."""
    rows = explode_rows(per_item)
    out = (clock_shift(rows.where(F.col("ts").isNotNull()), overrides)
           .withColumn("company_id", F.lit(company_id)))
    cols = READINGS_COLUMNS + (["file", "pos"] if keep_source else [])
    return out.select(*cols)


def prediction_items(lines: DataFrame, default_company: str) -> DataFrame:
    """Predictions per item: ``valid`` flag plus the record fields."""
    items = parse_items(lines)
    idx, thr = attr_num(_get("index")), attr_num(_get("threshold"))
    required = (attr_str(_get("process_id")).isNotNull() & attr_str(_get("timestamp")).isNotNull()
                & attr_str(_get("index")).isNotNull() & attr_str(_get("threshold")).isNotNull())
    return (items.withColumn("index", idx).withColumn("threshold", thr)
                 .withColumn("bad_ts", F.coalesce(~F.col("malformed") & required
                                                  & parse_utc(attr_str(_get("timestamp"))).isNull(), F.lit(False)))
                 .withColumn("valid", ~F.col("malformed") & required & ~F.col("bad_ts")
                             & F.col("index").isNotNull() & F.col("threshold").isNotNull())
                 .withColumn("process_id", attr_str(_get("process_id")))
                 .withColumn("company_id", company(default_company))
                 .withColumn("ts_text", attr_str(_get("timestamp"))))


def predictions(lines: DataFrame, default_company: str, overrides=None,
                keep_source: bool = False) -> DataFrame:
    """Predictions flow: one row per valid item with two measures, shifted."""
    return prediction_rows(prediction_items(lines, default_company), overrides, keep_source)


def prediction_rows(per_item: DataFrame, overrides=None, keep_source: bool = False) -> DataFrame:
    """The rows of items that are parsed already."""
    rows = (per_item.where("valid").withColumn("ts", parse_utc(F.col("ts_text")))
                    .where(F.col("ts").isNotNull()))
    cols = PREDICTIONS_COLUMNS + (["file", "pos"] if keep_source else [])
    return clock_shift(rows, overrides).select(*cols)


def quarantine(per_item: DataFrame, value_col: str = "value") -> DataFrame:
    """(file, pos, line, reason) of the lines that can never become rows: not a JSON
    object (``malformed``) or a timestamp that is none (``bad_ts``)."""
    reason = F.when(F.col("malformed"), "malformed").when(F.col("bad_ts"), "bad_ts")
    return (per_item.withColumn("reason", reason).where("reason IS NOT NULL")
                    .select("file", "pos", F.col(value_col).alias("line"), "reason"))


def per_file_stats(per_item: DataFrame, rows_mode: bool = True) -> DataFrame:
    """A2: read / accepted / discarded per file (BIGINT).

    Long flows (``rows_mode``): read and discarded count items, accepted counts rows.
    Predictions (``rows_mode=False``, frame has ``valid``): all three count items.
    Malformed lines are counted as read and as discarded.
    """
    if rows_mode:
        acc = F.sum("n_rows").cast("long")
        disc = F.count_if(F.col("n_rows") == 0)
    else:
        acc = F.count_if(F.col("valid"))
        disc = F.count_if(~F.col("valid"))
    return per_item.groupBy("file").agg(F.count(F.lit(1)).alias("read"),
                                       acc.alias("accepted"), disc.alias("discarded"))
