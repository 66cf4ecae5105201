from pyspark.sql import functions as F

import corpus_pipeline as p
from reviewops.llm import op2_language as op2

from . import test_op3, test_op4, test_op6, test_op9

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def rows_of(df):
    return sorted((tuple(r) for r in df.select(COLUMNS).collect()), key=str)


def test_every_stage_against_brute_force_and_run_is_their_chain(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    rows = rows_of(docs)

    known = p.language(spark, docs, sf)
    gone = {r._id for r in op2.predict(docs, op2.train(docs)).filter("rejected").collect()}
    assert rows_of(known) == [r for r in rows if r[0] not in gone]
    rows = rows_of(known)

    cut = p.lines(spark, known, sf)
    want = {d: t for d, _, _, t in test_op6.brute([(r[0], r[1]) for r in rows])}
    rows = sorted([(r[0], want[r[0]], r[2], r[3], len(want[r[0]])) for r in rows], key=str)
    assert rows_of(cut) == rows

    single = p.near_duplicates(spark, cut, sf)
    stays = {d for d, _, low in test_op3.want([(r[0], r[1]) for r in rows]) if d == low}
    rows = [r for r in rows if r[0] in stays]
    assert rows_of(single) == rows

    clean = p.benchmark(spark, single, sf)
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    found = {d for d, *_ in test_op4.brute([(r[0], r[1]) for r in rows], items)}
    rows = [r for r in rows if r[0] not in found]
    assert rows_of(clean) == rows

    out = sorted((r.doc_id, r.n_tokens) for r in p.run(spark, sf).collect())
    assert out == sorted((r[0], len(test_op9.want(r[1])[0])) for r in rows)


def test_stages_on_odd_rows(spark, make_docs, sf):
    rows = [(1, None), (2, ""), (2, ""), (None, "the one and the other of them"), (None, "the one and the other of them"),
            (3, "the one and the other of them " * 50_000), (4, "###")]
    docs = make_docs(rows).withColumn("_text", F.lit("x")).withColumn("_row", F.lit(1)).withColumn("words", F.lit(2))
    assert sorted(str(r.doc_id) for r in p.near_duplicates(spark, docs, sf).collect()) == ["1", "3", "4", "None"]
    assert p.near_duplicates(spark, docs, sf).columns == p.lines(spark, docs, sf).columns == docs.columns
    assert sorted((str(r.doc_id), r.text) for r in p.lines(spark, docs, sf).collect()) == sorted((str(d), t) for d, t in rows)
    assert p.benchmark(spark, docs, sf).count() == len(rows)
    assert {r.doc_id for r in p.language(spark, docs.withColumn("lang", F.lit("en")), sf).collect()} <= {None, 3}
    for _, step in p.STAGES:
        assert step(spark, docs.limit(0), sf).collect() == []
