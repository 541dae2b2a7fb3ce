"""Canonical digests: what counts as the same text and what does not."""

from telemetra.llm import licenses

MIT = licenses.MIT_TERMS


def scan(spark, rows, known=None):
    df = spark.createDataFrame([(i, t, "clash", "x") for i, t in rows], "doc_id long, text string, digest string, license_id string")
    return [(r.doc_id, r.license_id) for r in licenses.scan(df, known or licenses.known_texts(spark)).collect()]


def test_variants_of_one_text(spark):
    rows = [(1, "MIT License\n\nCopyright (c) 2020 A. Body\n\n" + MIT), (2, "Copyright 1999\n(c) 2001 me\nAll rights reserved.\n" + MIT.upper()),
            (3, MIT.replace("sublicense", "sub-license").replace("\n", " ").replace('"', "“")), (4, "  * © 2024 x\n" + MIT.replace(",", " ,")),
            (5, MIT + " extra"), (6, MIT[:-10]), (7, None), (8, ""), (9, "..."), (None, MIT), (1, MIT), (10, "Released under the MIT licence"),
            (11, "word " * 50000)]
    assert sorted(scan(spark, rows), key=str) == sorted([(1, "MIT"), (1, "MIT"), (2, "MIT"), (3, "MIT"), (4, "MIT"), (5, None), (6, None), (7, None),
                                                         (8, None), (9, None), (10, "MIT notice"), (11, None), (None, "MIT")], key=str)


HOLDERS = ("Copyright Jane Doe", "Copyright (c) 2019-2024, The X Authors. All rights reserved.", "COPYRIGHT (C) 1999 ACME", "  * Copyright: 2020 A. Body <a@b.c>",
           "Copyright <YEAR> [name]", "© 2024 x", "(c) 2001 me")


def test_every_licence_with_another_holder(spark):
    """Each known text after any holder's line, in another wrapping, is that licence; with a changed word it is none."""
    rows, want = [], []
    for i, (name, text) in enumerate(licenses.known_rows()):
        rows += [(i, HOLDERS[i % len(HOLDERS)] + "\n\n" + text), (1000 + i, text.replace("\n", "\r\n")), (2000 + i, text + " changed")]
        want += [(i, name), (1000 + i, name), (2000 + i, None)]
    assert sorted(scan(spark, rows)) == sorted(want)
    assert {"BSD-2-Clause", "BSD-3-Clause", "Apache-2.0", "MPL-2.0", "GPL-2.0", "GPL-3.0", "LGPL-2.1", "LGPL-3.0", "Unlicense"} <= {n for _, n in want}


def test_terms_that_start_with_the_word_stay(spark):
    terms = ["2. Grant of\nCopyright License. Subject to this", "the\ncopyright notice 2020 must", "THE\nCOPYRIGHT HOLDERS BE LIABLE", "Copyright Notice\nof terms"]
    known = spark.createDataFrame([(str(i), t.replace("\n", " ")) for i, t in enumerate(terms)], "license_id string, text string")
    assert sorted(scan(spark, list(enumerate(terms)), known)) == [(i, str(i)) for i in range(len(terms))]


def test_sql_of_the_same_forms(spark):
    import duckdb
    texts = [None, "", *("\n".join((h, "Terms of " + h, t)) for h in HOLDERS for t in ("Copyright Notice", "all rights reserved.", "Copyright Law x", MIT))]
    got = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string").select("doc_id", licenses.canonical("text").alias("form")).collect()
    con = duckdb.connect()
    con.execute("CREATE TABLE t (doc_id BIGINT, text VARCHAR)")
    con.executemany("INSERT INTO t VALUES (?, ?)", list(enumerate(texts)))
    assert sorted(map(tuple, got)) == con.execute(f"SELECT doc_id, {licenses._sql_form('text')} FROM t ORDER BY 1").fetchall()


def test_known_side(spark):
    known = spark.createDataFrame([("b", "Some terms."), ("a", "some TERMS"), (None, "other"), ("c", None), ("d", " . ")], "license_id string, text string")
    assert sorted(scan(spark, [(1, "some terms!"), (2, "other"), (3, None), (4, "")], known), key=str) == [(1, "a"), (2, None), (3, None), (4, None)]
    assert scan(spark, [(1, "x")], known.limit(0)) == [(1, None)]
    assert scan(spark, [], known) == []


def test_spellings_do_not_undo_each_other():
    text = " ".join(a for a, _ in licenses.EQUIVALENT)
    for _ in range(2):
        for a, b in licenses.EQUIVALENT:
            text = text.replace(a, b)
    again = text
    for a, b in licenses.EQUIVALENT:
        again = again.replace(a, b)
    assert again == text and len(licenses.EQUIVALENT) < 200
