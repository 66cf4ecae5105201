import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F
from sentencepiece import sentencepiece_model_pb2 as proto

from reviewops.llm import op12_sentencepiece as sp

PATH = public_tokenizers.path("piece_bpe_32k.model")
LIB = sentencepiece.SentencePieceProcessor(model_file=PATH)
ODD = ["", " ", "\n\n  x", "a  b   c    d", "▁a▁ b", "don't <s> </s> <unk> <0x41>", "日本語テキスト、混ぜる", "😀👩‍👩‍👧 a😀", "x" * 4000,
       "ab" * 2000 + "é" * 777, "İßﬁ ́é ½²Ⅷ٣ ｶﾞ", "퟿\U0010ffff\x00\x01\x7f", "\t\t\t\n \r\n　 ", "=" * 999 + "-*/" * 400, " lead", "trail  "]


def texts():
    r = random.Random(4)
    letters = "aAeE zZ09 .,'\n\téß中Жа\U0001f600-_=/ ▁"
    out = ODD + ["".join(r.choice(letters) for _ in range(r.randrange(200))) for _ in range(300)]
    return out + ["".join(chr(r.choice([r.randrange(1, 0x2fff), r.randrange(32, 128)])) for _ in range(60)) for _ in range(200)]


def variant(**spec):
    """The installed model with other normalisation settings (and the library's own compiled maps)."""
    m = proto.ModelProto()
    with open(PATH, "rb") as f:
        m.ParseFromString(f.read())
    rule = spec.pop("rule", None)
    if rule:
        other = proto.ModelProto()
        other.ParseFromString(sentencepiece.SentencePieceNormalizer(rule_name=rule).serialized_model_proto())
        m.normalizer_spec.precompiled_charsmap = other.normalizer_spec.precompiled_charsmap
        m.normalizer_spec.name = rule
    for k, v in spec.items():
        setattr(m.normalizer_spec, k, v)
    return m.SerializeToString()


def same(mine, lib, data):
    ids, begins, ends = (np.frombuffer(x, "<u4").tolist() for x in mine.encode_all([data])[0])
    want = proto_of(lib, data)
    assert ids == [p[0] for p in want], data
    assert list(zip(begins, ends, strict=True)) == [p[1:] for p in want], data
    assert mine.decode(np.array(ids, "<u4").tobytes()) == lib.decode(ids), data


def proto_of(lib, data):
    from sentencepiece import sentencepiece_pb2

    out = sentencepiece_pb2.SentencePieceText()
    out.ParseFromString(lib.encode(data, out_type="serialized_proto"))
    return [(p.id, p.begin, p.end) for p in out.pieces]


def test_ids_spans_and_text_equal_library():
    mine = sp.model(None)
    for t in texts():
        same(mine, LIB, t.encode())


@pytest.mark.parametrize("spec", [
    {"rule": "nmt_nfkc"}, {"rule": "nfkc_cf"}, {"rule": "nmt_nfkc", "remove_extra_whitespaces": True},
    {"remove_extra_whitespaces": True}, {"add_dummy_prefix": False}, {"rule": "nfkc", "add_dummy_prefix": False, "remove_extra_whitespaces": True}])
def test_compiled_maps_and_settings_equal_library(spec):
    blob = variant(**spec)
    mine, lib = sp.Model(blob), sentencepiece.SentencePieceProcessor(model_proto=blob)
    for t in texts():
        same(mine, lib, t.encode())


def test_bytes_that_are_no_text_and_any_ids():
    mine = sp.Model(open(PATH, "rb").read())
    for data in (b"\xff", b"a\xc3", b"\xe2\x82 x\x80\x80", b"\xf0\x9f\x98a"):
        same(mine, LIB, data)
    r = random.Random(1)
    for _ in range(300):
        ids = [r.choice([r.randrange(32000), r.randrange(3, 259), r.randrange(3)]) for _ in range(r.randrange(12))]
        assert mine.decode(np.array(ids, "<u4").tobytes()) == LIB.decode(ids), ids


def test_words_merge_alike_by_lists_and_heap_and_cache_is_bounded(monkeypatch):
    mine = sp.Model(open(PATH, "rb").read())
    r = random.Random(8)
    for _ in range(300):
        word = [r.choice("▁abest theing") for _ in range(r.randrange(1, 60))]
        assert mine._merge(list(word)) == mine._merge_long(list(word))
    monkeypatch.setattr(sp, "KEEP_CHARS", 30)
    for t in texts()[:120]:
        same(mine, LIB, t.encode())
    assert len(mine.older) + len(mine.known) < 5000


def test_spans_cut_the_text_into_its_parts(make_docs):
    docs = make_docs([(i, t) for i, t in enumerate(ODD)])
    for r in sp.sp_encode(docs).join(docs, "doc_id").collect():
        b, e = np.frombuffer(r.begins, "<u4"), np.frombuffer(r.ends, "<u4")
        data = r.text.encode()
        assert (b[0], e[0]) == (0, 0) and (b[-1], e[-1]) == (len(data), len(data))
        assert b"".join(data[x:y] for x, y in zip(b, e, strict=True)) == data


def test_long_text_equals_library(make_docs):
    text = "word été " * 150_000 + "y" * 100_000
    row = sp.sp_round_trip(make_docs([(1, text)])).first()
    assert np.frombuffer(row.ids, "<u4").tolist() == LIB.encode(text, add_bos=True, add_eos=True) and row.decoded == text


def test_nulls_repeats_empty_and_clashing_columns(spark, make_docs):
    docs = make_docs([(1, None), (1, "a b"), (1, "a b"), (None, "x"), (2, "")])
    out = sp.sp_round_trip(docs.selectExpr("doc_id", "text", "1 as ids", "2 as _id", "3 as _text", "4 as decoded"))
    got = sorted(((r.doc_id, np.frombuffer(r.ids, "<u4").tolist(), r.decoded) for r in out.collect()), key=str)
    assert got == sorted([(1, [1, 2], ""), (2, [1, 2], "")] + [(1, LIB.encode("a b", add_bos=True, add_eos=True), "a b")] * 2
                         + [(None, LIB.encode("x", add_bos=True, add_eos=True), "x")], key=str)
    assert sp.sp_round_trip(make_docs([])).count() == 0
    ids = spark.createDataFrame([(1, None)], "doc_id long, ids binary")
    assert sp.sp_decode(ids).first().decoded == ""
    assert sp.sp_decode(sp.sp_encode(docs)).filter(F.col("decoded") == "a b").count() == 2


def test_query_equals_library(spark, sf):
    def digest(x):
        return hashlib.sha256(x).hexdigest()

    docs = spark.read.parquet(f"{sf}/documents.parquet").collect()
    out = {r.doc_id: r for r in sp.op12_sentencepiece(spark, sf).collect()}
    assert len(out) == len(docs)
    for d in docs:
        ids = LIB.encode(d.text or "", add_bos=True, add_eos=True)
        r = out[d.doc_id]
        assert (r.n_tokens, r.ids_sha256, r.decoded_sha256) == (len(ids), digest(np.array(ids, "<u4").tobytes()), digest(LIB.decode(ids).encode()))


def test_other_kinds_of_model_are_refused():
    m = proto.ModelProto()
    m.ParseFromString(variant())
    m.trainer_spec.model_type = proto.TrainerSpec.UNIGRAM
    with pytest.raises(ValueError):
        sp.Model(m.SerializeToString())
