"""Typed-JSON items (P1, P2, P3, P15–P18, R1, A2, E2) on the FIXTURES edge rows."""

import json

from telemetra.operators import typed_json as tj


def _lines(spark, items):
    rows = [("f1.json.gz", i, x if isinstance(x, str) else json.dumps(x)) for i, x in enumerate(items)]
    return spark.createDataFrame(rows, "file string, pos long, value string")


WIDE = {"Item": {"process_id": {"S": "AB-12"}, "timestamp": {"S": "2024-01-31 22:30"},
                 "T1": {"N": "1.5"}, "T2": {"S": "2.5"}, "ON": {"BOOL": True}, "BAD": {"S": "x"},
                 "NU": {"NULL": True}, "LL": {"L": [{"N": "1"}]}, "MM": {"M": {"a": {"N": "1"}}},
                 "SS": {"SS": ["a"]}, "NS": {"NS": ["1"]}, "model": {"S": "m"}, "company_id": {"S": ""}}}
LONG = {"process_id": {"S": "ab13"}, "ts": {"S": "2024-01-31 22:30:00"}, "tag_id": {"S": "T1"},
        "value": {"N": "7"}}


def _rows(df):
    return sorted((r.company_id, r.process_id, r.tag_id, r.value, str(r.ts)) for r in df.collect())


def test_wide_item_unpivots_numeric_tags_only(spark):
    out = _rows(tj.projections(_lines(spark, [WIDE]), "dflt", overrides=[]))
    assert out == [("dflt", "AB-12", "ON", 1.0, "2024-02-01 01:30:00"),
                   ("dflt", "AB-12", "T1", 1.5, "2024-02-01 01:30:00"),
                   ("dflt", "AB-12", "T2", 2.5, "2024-02-01 01:30:00")]


def test_long_item_dispatch_and_override_offset(spark):
    out = _rows(tj.projections(_lines(spark, [LONG]), "dflt", overrides=["AB-13"]))
    assert out == [("dflt", "ab13", "T1", 7.0, "2024-02-01 02:30:00")]  # +4 h, id normalised


def test_variables_has_no_dispatch(spark):
    out = [(r.tag_id, r.value) for r in tj.variables(_lines(spark, [LONG]), "acme", overrides=[]).collect()]
    assert out == [("value", 7.0)]
    assert tj.variables(_lines(spark, [LONG]), "acme").columns == ["company_id", "tag_id", "value", "ts"]


def test_required_fields_and_no_ts_fallback_on_explicit_null(spark):
    items = [
        {"timestamp": {"S": "2024-01-01 00:00"}, "T": {"N": "1"}},                     # no process_id
        {"process_id": {"S": "p"}, "timestamp": {"NULL": True}, "ts": {"S": "2024-01-01 00:00"},
         "T": {"N": "1"}},                                                             # explicit null
        {"process_id": {"S": "p"}, "ts": {"S": "2024-01-01 00:00"}, "T": {"N": "1"}},  # fallback ok
    ]
    out = _rows(tj.projections(_lines(spark, items), "d", overrides=[]))
    assert out == [("d", "p", "T", 1.0, "2024-01-01 03:00:00")]


def test_number_edge_values(spark):
    vals = ["NaN", "inf", "-Infinity", "1e400", "", "abc", "1.0d", "0x1p3", " 2.5 ", "44" * 22, "-3e2"]
    item = {"process_id": {"S": "p"}, "ts": {"S": "2024-01-01 00:00"}}
    for i, v in enumerate(vals):
        item[f"t{i}"] = {"S": v}
    out = {r.tag_id: r.value for r in tj.projections(_lines(spark, [item]), "d", overrides=[]).collect()}
    assert out == {"t8": 2.5, "t9": float("44" * 22), "t10": -300.0}


def test_company_default_and_item_company(spark):
    a = dict(LONG, company_id={"S": "co9"})
    b = dict(LONG, company_id={"S": ""})
    got = sorted(r.company_id for r in tj.projections(_lines(spark, [a, b]), "dflt", overrides=[]).collect())
    assert got == ["co9", "dflt"]


def test_blank_malformed_and_stats(spark):
    lines = _lines(spark, [WIDE, "", "   ", "not json", LONG, {"process_id": {"S": "p"}, "ts": {"S": "x"}}])
    per_item = tj.item_rows(tj.parse_items(lines), "d", dispatch=True)
    s = tj.per_file_stats(per_item).first()
    # blanks are not items; malformed and the item without numeric tags are discarded
    assert (s.read, s.accepted, s.discarded) == (4, 4, 2)


def test_predictions_need_both_measures(spark):
    ok = {"Item": {"process_id": {"S": "p"}, "timestamp": {"S": "2024-01-01T00:00:00Z"},
                   "index": {"N": "0.5"}, "threshold": {"N": "0.7"}, "model": {"S": "x"}}}
    no_thr = {"process_id": {"S": "p"}, "timestamp": {"S": "2024-01-01 00:00"}, "index": {"N": "1"}}
    ts_only = {"process_id": {"S": "p"}, "ts": {"S": "2024-01-01 00:00"}, "index": {"N": "1"},
               "threshold": {"N": "1"}}
    bad = {"process_id": {"S": "p"}, "timestamp": {"S": "2024-01-01 00:00"}, "index": {"S": "NaN"},
           "threshold": {"N": "1"}}
    df = tj.predictions(_lines(spark, [ok, no_thr, ts_only, bad]), "d", overrides=[])
    assert [(r["index"], r.threshold, str(r.ts)) for r in df.collect()] == [(0.5, 0.7, "2024-01-01 03:00:00")]
    stats = tj.per_file_stats(tj.prediction_items(_lines(spark, [ok, no_thr, ts_only, bad]), "d"),
                              rows_mode=False).first()
    assert (stats.read, stats.accepted, stats.discarded) == (4, 1, 3)


def test_mixed_precision_and_offsets_parse_to_utc(spark):
    items = [{"process_id": {"S": "p"}, "ts": {"S": s}, "T": {"N": "1"}}
             for s in ["2023-11-25 04:22", "2023-11-25 04:22:00", "2023-11-25T06:22:00+02:00",
                       "2023-11-25T04:22:00Z"]]
    got = {str(r.ts) for r in tj.projections(_lines(spark, items), "d", overrides=[]).collect()}
    assert got == {"2023-11-25 07:22:00"}
