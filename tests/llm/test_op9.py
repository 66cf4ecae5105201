import hashlib
import random

import numpy as np
import public_tokenizers
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from reviewops.llm.op9_bpe import bpe_decode, bpe_encode, bpe_round_trip, op9_bpe, vocabulary

LIB = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
ODD = ["", " ", "\n\n  x", "a b   c", "\x1c\x1d\x1f x\x85y​z", "don't I'LL we've 'S", "日本語テキスト、混ぜる", "😀👩‍👩‍👧 a😀",
       "<|endoftext|>", "a<|endoftext|><|endoftext|> b <|endoftext", "x" * 5000, "ab" * 3000 + "é" * 777, "0" * 3000 + "½²Ⅷ٣",
       "İßﬁ ́é", "퟿\U0010ffff\x00\x01", "\t\t\t\n \r\n", "=" * 999 + "-*/" * 400, "https://x.y/z?q=1&r=%20#f"]


def want(text):
    ids = LIB.encode(text or "", add_special_tokens=False).ids
    return ids, LIB.decode(ids, skip_special_tokens=False)


def test_vocabulary_equals_library_on_odd_and_random_texts():
    r = random.Random(3)
    letters = "aAeE zZ09 .,'\n\téß中Жا\U0001f600-_=/ "
    texts = ODD + ["".join(r.choice(letters) for _ in range(r.randrange(200))) for _ in range(400)]
    texts += ["".join(chr(r.choice([r.randrange(32, 0x2fff), r.randrange(128)])) for _ in range(50)) for _ in range(200)]
    v = vocabulary(None)
    for t in texts:
        ids, decoded = want(t)
        assert np.frombuffer(v.encode_all([t])[0], "<u4").tolist() == ids, t
        assert v.decode(np.array(ids, dtype="<u4")) == decoded


def test_no_token_reaches_across_a_forced_cut():
    v = vocabulary(None)
    assert v.forced.sum() > 0
    for t in ODD:
        data = t.encode()
        cut = [0, *(v.cuts(data).tolist() if data else []), len(data)]
        for a, b in zip(cut, cut[1:], strict=False):
            assert b"".join(v.token[i] for i in v.merged(data[a:b])) == data[a:b]
    # and whole pieces that hold such a cut encode as the fragments do
    assert any(len(v.cuts(t.encode())) for t in ODD if t)


def test_short_and_long_fragments_merge_alike():
    r = random.Random(8)
    v = vocabulary(None)
    for _ in range(300):
        data = bytes(r.choice(b"abest theing") for _ in range(r.randrange(1, 60)))
        assert v.merged(data) == v._merged_long([v.of_byte[b] for b in data])


def test_cache_bound_does_not_change_results(monkeypatch):
    from reviewops.llm import op9_bpe

    monkeypatch.setattr(op9_bpe, "KEEP_PIECES", 3)
    v = op9_bpe.Vocabulary(public_tokenizers.path("byte_bpe_50k.json"))
    assert [np.frombuffer(x, "<u4").tolist() for x in v.encode_all(ODD)] == [want(t)[0] for t in ODD]


def test_long_text(make_docs):
    text = "word été " * 200_000
    row = bpe_encode(make_docs([(1, text)])).first()
    assert np.frombuffer(row.ids, "<u4").tolist() == want(text)[0]


def test_operator_edges(make_docs):
    rows = [(k, t) for k, t in enumerate(ODD)] + [(None, None), (3, "same"), (3, "same")]
    docs = make_docs(rows).withColumn("ids", F.lit("clash")).withColumn("_id", F.lit(1))
    out = bpe_decode(bpe_encode(docs)).collect()
    have = sorted((str(r.doc_id), np.frombuffer(r.ids, "<u4").tolist(), r.decoded) for r in out)
    assert have == sorted((str(d), *want(t)) for d, t in rows)
    assert sorted(map(str, bpe_round_trip(docs).collect())) == sorted(map(str, out))
    assert bpe_decode(bpe_encode(make_docs([]))).collect() == []


def test_query(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").collect()
    have = sorted(tuple(r) for r in op9_bpe(spark, sf).collect())
    sha = lambda b: hashlib.sha256(b).hexdigest()
    assert have == sorted((d.doc_id, len(i := want(d.text)[0]), sha(np.array(i, "<u4").tobytes()), sha(want(d.text)[1].encode()))
                          for d in docs)
