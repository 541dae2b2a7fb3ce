"""P3 property: Spark's finite_double equals Python float() + finite check on random text.

Strings with '_' are excluded (documented deviation: Python accepts digit separators)."""

import math
import random

from telemetra.functions.numbers import finite_double

ALPHABET = "0123456789+-.eE dxXpnaNfiI\t"


def _py(s: str):
    try:
        f = float(s)
    except (TypeError, ValueError):
        return None
    if math.isnan(f) or math.isinf(f):
        return None
    return f


def _samples(n=4000, seed=11):
    rnd = random.Random(seed)
    out = ["", " ", "1", "-1.5e3", ".5", "5.", "1e400", "-0", "0x1p3", "1.0d", "NaN", "inf", "Infinity",
           " 7 ", "+.5e-2", "1e", "e5", "--1", "1.2.3", "4" * 44]
    for _ in range(n):
        k = rnd.randint(1, 8)
        out.append("".join(rnd.choice(ALPHABET) for _ in range(k)))
    return out


def test_finite_double_matches_python_float(spark):
    vals = _samples()
    df = spark.createDataFrame([(i, s) for i, s in enumerate(vals)], "i int, s string")
    got = {r.i: r.v for r in df.select("i", finite_double("s").alias("v")).collect()}
    bad = [(vals[i], got[i], _py(vals[i])) for i in range(len(vals)) if got[i] != _py(vals[i])]
    assert not bad, bad[:10]
