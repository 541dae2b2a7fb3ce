"""R1/P2/P15–P18 property: projections of random typed-JSON items equal a plain-Python
model of the item rules (written from the SURVEY semantics)."""

import json
import math
import random
from datetime import datetime, timedelta

from telemetra.operators import typed_json as tj

HEADERS = {"process_id", "timestamp", "ts", "company_id", "model"}
TS = ["2024-01-31 22:30", "2024-02-01 00:00:00", "2024-03-05 10:11:12.5"]


def _plain(a):
    (k, v), = a.items()
    return {"S": v, "N": v, "BOOL": v, "NULL": None}.get(k, v)


def _num(a):
    (k, v), = a.items()
    if k in ("S", "N"):
        try:
            f = float(v)
        except ValueError:
            return None
        return None if math.isnan(f) or math.isinf(f) else f
    if k == "BOOL":
        return 1.0 if v else 0.0
    return None


def _str(a):
    (k, v), = a.items()
    return {"NULL": None, "BOOL": str(v)}.get(k, v)


def model(obj, default, overrides):
    item = obj["Item"] if "Item" in obj else obj
    pid = _str(item["process_id"]) if "process_id" in item else None
    ts = _str(item["timestamp"]) if "timestamp" in item else (_str(item["ts"]) if "ts" in item else None)
    if pid is None or ts is None:
        return []
    comp_attr = item.get("company_id")
    truthy = comp_attr is not None and bool(_plain(comp_attr)) and not (
        "N" in comp_attr and float(comp_attr["N"]) == 0)
    company = _str(comp_attr) if truthy else default
    when = datetime.fromisoformat(ts) + timedelta(hours=4 if pid.replace("-", "").lower() in overrides else 3)
    if "tag_id" in item and "value" in item:
        v = _num(item["value"])
        tag = _str(item["tag_id"])
        return [] if v is None else [(company, pid, "None" if tag is None else tag, v, when)]
    return [(company, pid, k, _num(a), when) for k, a in item.items() if k not in HEADERS and _num(a) is not None]


def _attr(rnd, kind=None):
    kind = kind or rnd.choice(["S", "S", "N", "N", "BOOL", "NULL", "L"])
    if kind == "S":
        return {"S": rnd.choice(["1.5", "-2", "x", "", " 3 ", "NaN", "1e400", "7e-3", "abc", "0"])}
    if kind == "N":
        return {"N": rnd.choice(["1", "0", "2.25", "-4", "1e3", "123456789012345678901234567890"])}
    if kind == "BOOL":
        return {"BOOL": rnd.random() < 0.5}
    if kind == "NULL":
        return {"NULL": True}
    return {"L": [{"N": "1"}]}


def _item(rnd):
    it = {}
    if rnd.random() < 0.9:
        it["process_id"] = rnd.choice([{"S": "P-1"}, {"S": "p2"}, {"S": ""}, {"N": "5"}, {"NULL": True}])
    r = rnd.random()
    if r < 0.5:
        it["timestamp"] = {"S": rnd.choice(TS)}
    elif r < 0.8:
        it["ts"] = {"S": rnd.choice(TS)}
    elif r < 0.9:
        it["timestamp"], it["ts"] = {"NULL": True}, {"S": rnd.choice(TS)}
    if rnd.random() < 0.5:
        it["company_id"] = rnd.choice([{"S": ""}, {"S": "co"}, {"N": "0"}, {"N": "7"}, {"BOOL": True},
                                       {"BOOL": False}, {"NULL": True}])
    if rnd.random() < 0.3:
        it["tag_id"] = rnd.choice([{"S": "T"}, {"N": "9"}, {"BOOL": False}, {"NULL": True}])
        if rnd.random() < 0.7:
            it["value"] = _attr(rnd)
    for k in rnd.sample(["A", "B-1", "c.d", "model", "#x"], rnd.randint(0, 5)):
        it[k] = _attr(rnd)
    return {"Item": it} if rnd.random() < 0.5 else it


def test_projections_match_model(spark):
    rnd = random.Random(5)
    objs = [_item(rnd) for _ in range(600)]
    lines = spark.createDataFrame([("f", i, json.dumps(o)) for i, o in enumerate(objs)],
                                  "file string, pos long, value string")
    got = sorted((r.company_id, r.process_id, r.tag_id, r.value, r.ts)
                 for r in tj.projections(lines, "dflt", overrides=["p1"]).collect())
    want = sorted(row for o in objs for row in model(o, "dflt", {"p1"}))
    assert got == want
