"""BPE against the tokenizers library, which the operator itself does not use for merging."""

import hashlib
import random
import struct

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from telemetra.llm import bpe

PATH = public_tokenizers.path("word_bpe_49k.json")
ODD = ["", "  ", "Hello WORLD's don't I'LL 123 4.5 naïve café ΣΑΣ İstanbul <|endoftext|> x<|startoftext|>y <|ENDOFTEXT|>",
       "á é\u0085b c d\x1ce\x1f", "日本語テキスト 한국어 العربية 🎉🎉🎉👨‍👩‍👧 ​﻿", "ǅ ß ẞ ŉ ﬁ Ⅷ ² ½ ٣",
       "a" * 3000, "ab" * 1000 + "'s're", "x" * 20000, "</w> a</w>b <w>", "<|endoftext|><|endoftext|>", "' 's ''ll '",
       "\x00\x01 \x7f", "ΑΣ Σ ΣΑ", "  a b", "á ẹ̀"]


def texts(n=1500, seed=1):
    rnd = random.Random(seed)
    wide = lambda: rnd.choice([rnd.randrange(32, 127), rnd.randrange(128, 0x250), rnd.randrange(0x250, 0x3000), rnd.randrange(0x1F300, 0x1F700)])
    out = list(ODD)
    for _ in range(n):
        out.append("".join(chr(wide()) for _ in range(rnd.randrange(1, 60))))
        out.append("".join(rnd.choice("aabehinrst '") for _ in range(rnd.randrange(1, 80))))
    return out


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def test_ids_equal_the_library(library):
    rows = texts()
    enc = bpe.Encoder(bpe.WordBPE(PATH))
    got = [x.tolist() for i in range(0, len(rows), 64) for x in enc.texts([r.encode() for r in rows[i:i + 64]])]
    assert got == [e.ids for e in library.encode_batch(rows, add_special_tokens=False)]


def test_verification_finds_every_wrong_proposal():
    b = bpe.WordBPE(PATH)
    rnd = random.Random(2)
    words = ["".join(rnd.choice("aehinrst") for _ in range(rnd.randrange(1, 12))) for _ in range(4000)]
    words = [w[:-1] + chr(ord(w[-1]) + 256) for w in words]
    import numpy as np
    wrong = 0
    for w in words:
        p = b.proposed(w)
        ok = len(p) < 2 or bool(b.verified(np.array(p[:-1]), np.array(p[1:])).all())
        assert ok == (p == b.merged(w))
        wrong += not ok
    assert 0 < wrong < len(words)


def test_memory_is_bounded(library, monkeypatch):
    monkeypatch.setattr(bpe, "MEMORY_CHUNKS", 50)
    enc = bpe.Encoder(bpe.WordBPE(PATH))
    rows = texts(100)
    got = [x.tolist() for r in rows for x in enc.texts([r.encode()])]
    assert got == [e.ids for e in library.encode_batch(rows, add_special_tokens=False)]


def test_operator(spark, library):
    rows = [(i, t, "clash") for i, t in enumerate(texts(60))] + [(None, "no id", "x"), (3, None, None), (0, "same id", "y")]
    df = spark.createDataFrame(rows, "doc_id long, text string, ids string")
    got = {(r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in bpe.digests(df, PATH).collect()}
    want = set()
    for i, t, _ in rows:
        ids = library.encode(t or "", add_special_tokens=False).ids
        text = library.decode(ids, skip_special_tokens=False)
        want.add((i, len(ids), hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest(), hashlib.sha256(text.encode()).hexdigest()))
    assert got == want
    encoded = bpe.encode(df, PATH)
    back = {(r.doc_id, r.text) for r in bpe.decode(encoded, PATH).collect()}
    assert back == {(i, library.decode(library.encode(t or "", add_special_tokens=False).ids, skip_special_tokens=False)) for i, t, _ in rows}
    assert bpe.digests(df.limit(0), PATH).collect() == []
