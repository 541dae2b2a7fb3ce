"""Tables whose columns have the names of the stages' helper columns."""

from telemetra.llm import decontaminate, simhash, substring_dedup

NAMES = ["_keep_id", "_keep_row", "_keep_rows", "_doc", "_row", "_starts", "_leak_id", "__doc", "fp", "row", "root", "h"]


def test_stages_keep_clashing_columns(spark):
    names = NAMES
    words = " ".join(f"w{i}" for i in range(80))
    rows = [(1, words, *range(len(names))), (2, words + " end", *range(len(names))), (3, "short text", *range(len(names))), (3, "short text", *range(len(names)))]
    docs = spark.createDataFrame(rows, "doc_id long, text string, " + ", ".join(f"{n} int" for n in names))
    kept = simhash.keep_one(docs, shingle=3, distance=2)
    assert kept.columns == docs.columns and sorted(r["doc_id"] for r in kept.collect())[-1] == 3
    out = substring_dedup.remove_repeats(docs, window=50)
    got = {r["doc_id"]: r for r in out.collect()}
    assert out.columns == docs.columns and out.count() == 4 and got[2]["text"] == "end" and got[2]["_row"] == names.index("_row")
    items = spark.createDataFrame([(1, "short text")], "item_id long, text string")
    left = decontaminate.drop_leaking(docs, items)
    assert left.columns == docs.columns and sorted(r["doc_id"] for r in left.collect()) == [1, 2]
