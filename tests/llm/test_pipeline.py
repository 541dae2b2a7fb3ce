"""The pipeline's stages against plain versions, each on what the stage before it kept."""

import hashlib
import random

import public_tokenizers
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from telemetra.llm import queries
from tests.llm import test_decontaminate, test_simhash, test_substring_dedup


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    d = str(tmp_path_factory.mktemp("pipeline"))
    rnd = random.Random(7)
    word = lambda: "".join(rnd.choice("ab cd ef gé hi jo".split()) for _ in range(rnd.randrange(1, 4)))
    prose = lambda n: [word() for _ in range(n)]
    items = [(i, " ".join(prose(30))) for i in range(6)] + [(None, "x"), (9, None)]
    passage, docs, labels = prose(80), [], []
    for i in range(160):
        ws = prose(rnd.choice([30, 120, 400]))
        toxic = i % 5 == 1
        if toxic:
            for _ in range(4):
                ws.insert(rnd.randrange(len(ws)), rnd.choice(["nasty", "awful,", "Vile"]))
        if i % 7 == 0:
            ws[5:5] = passage
        if i % 11 == 0:
            ws[3:3] = items[i % 6][1].split()
        docs.append((i, " ".join(ws), "en", f"s{i % 3}", 1))
        labels.append((i, 1, int(toxic)))
        if i % 9 == 0:
            docs.append((1000 + i, " ".join(ws), "en", "copy", 1))
            ws[0] = "Changed"
            docs.append((2000 + i, " ".join(ws), "en", "near", 1))
    docs += [(5000, None, None, None, None), (5001, "", "en", "", 0), (None, "no id here", "en", "s", 10), (5002, "solo", "en", "s", 4)]
    spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{d}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{d}/labels.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{d}/benchmark.parquet")
    return d, items


def pairs(df):
    return [(r.doc_id, r.text) for r in df.collect()]


def test_stages(spark, tables):
    sf_dir, items = tables
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    columns = docs.columns
    model = queries.toxicity_model(spark, docs, sf_dir)
    stage = dict(corpus_pipeline.STAGES)
    same = lambda a, b: sorted(map(str, a)) == sorted(map(str, b))

    kept = [(i, t) for i, t in pairs(docs) if model.score((t or "").encode()) < 0.5]
    df = stage["toxicity"](spark, docs, sf_dir)
    assert df.columns == columns and same(pairs(df), kept)
    gone = {i for i, _ in pairs(docs)} - {i for i, _ in kept}
    assert {i for i in range(160) if i % 5 == 1} <= gone and len(gone) < 70

    alone = {i for i, _, c in test_simhash.brute(kept) if i is not None and i == c}
    df = stage["simhash"](spark, df, sf_dir)
    assert df.columns == columns and same([r for r in pairs(df) if r[0] is not None], [r for r in kept if r[0] in alone])
    kept = pairs(df)

    df = stage["substrings"](spark, df, sf_dir)
    want = {i: h for i, _, _, h in test_substring_dedup.brute(kept)}
    assert df.columns == columns and len(want) == len(kept)
    assert {i: hashlib.sha256(b" ".join((t or "").encode().split())).hexdigest() for i, t in pairs(df)} == want
    kept = pairs(df)

    bad = {x[0] for x in test_decontaminate.brute(kept, items)}
    df = stage["benchmark"](spark, df, sf_dir)
    assert bad and df.columns == columns and same(pairs(df), [r for r in kept if r[0] not in bad])
    kept = pairs(df)

    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    out = stage["tokens"](spark, df, sf_dir)
    assert out.columns == ["doc_id", "lang", "source", "n_chars", "n_tokens", "ids", "decoded_sha256"]
    ids = {i: library.encode(t or "", add_special_tokens=False).ids for i, t in kept}
    assert {r.doc_id: list(r.ids) for r in out.collect()} == ids
    assert all(r.n_tokens == len(r.ids) and r.decoded_sha256 == hashlib.sha256(library.decode(ids[r.doc_id], skip_special_tokens=False).encode()).hexdigest() for r in out.collect())

    whole = corpus_pipeline.run(spark, sf_dir)
    assert {r.doc_id: list(r.ids) for r in whole.collect()} == ids


def test_empty_tables(spark, tables, tmp_path):
    for name in ("documents", "labels", "benchmark"):
        spark.read.parquet(f"{tables[0]}/{name}.parquet").limit(0).write.parquet(f"{tmp_path}/{name}.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []
