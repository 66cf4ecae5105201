"""What is shuffled, read by one task or written grows with the tables at every size, and no faster."""
import os
import re

import pytest
from pyspark.sql import functions as F

from conftest import rows
from reviewops.operators import audit as A
from reviewops.operators import merge as M
from reviewops.plans.q_enrich import _earlier_calls
from reviewops.sinks import table as T
from reviewops.sources import fixtures as X
from reviewops.sources.materialize import materialized


@pytest.fixture()
def no_broadcast(spark):
    """The planner broadcasts nothing by itself, as with large tables."""
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan")[0]


def _wide_exchanges(plan):
    lines = plan.splitlines()
    return [k for k, x in enumerate(lines) if "Exchange hashpartitioning" in x and "wide" in "".join(lines[k:k + 3])]


def _stored(spark, path, n, files, shift=0):
    """Rows of several files, with keys that repeat and null keys, behind a filter and a column of their own."""
    df = spark.range(n, numPartitions=files).select(
        F.when(F.col("id") % 17 != 0, F.concat(F.lit("k-"), (F.col("id") % (n - 50) + shift).cast("string"))).alias("ID"),
        F.concat(F.lit("wide "), F.col("id").cast("string")).alias("wide"), F.col("id").alias("x"))
    df.write.parquet(path)
    return spark.read.parquet(path).filter("x % 5 <> 0").withColumn("x", F.col("x") + shift)


@pytest.mark.parametrize("part_rows", [8, M.PART_ROWS])
def test_stored_merges_equal_plain_ones_and_shuffle_no_wide_row(spark, tmpdir_path, no_broadcast, monkeypatch, part_rows):
    monkeypatch.setattr(M, "PART_ROWS", part_rows)
    table, batch = _stored(spark, f"{tmpdir_path}/t", 900, 3), _stored(spark, f"{tmpdir_path}/i", 700, 2, 300)
    for insert, update in ((True, False), (False, True), (True, True)):
        want = M.merge(table, batch, insert, update, validate=None)
        got = M.merge(table, batch, insert, update, validate=None, stored=True)
        assert rows(got) == rows(want) and got.columns == want.columns
        assert not _wide_exchanges(_plan(got))
    monkeypatch.setattr(M, "BROADCAST_PARTS", 0)  # more bitmaps than are broadcast: the plain joins
    assert rows(M.merge_update(table, batch, validate=None, stored=True)) == rows(M.merge_update(table, batch, validate=None))


def test_stored_merge_refuses_repeated_keys(spark, tmpdir_path):
    table, batch = _stored(spark, f"{tmpdir_path}/t", 200, 2), _stored(spark, f"{tmpdir_path}/i", 200, 2)
    with pytest.raises(Exception, match="DUPLICATE_KEY"):
        M.merge_upsert(table, batch, stored=True).collect()


def test_row_diff_broadcasts_its_bucket_lists(spark, no_broadcast):
    before = spark.range(500).select(F.concat(F.lit("k"), F.col("id").cast("string")).alias("ID"), F.lit("wide").alias("wide"), F.col("id").alias("x"))
    after = before.withColumn("x", F.when(F.col("x") % 2 == 0, F.col("x") + 1).otherwise(F.col("x")))
    diff = A.row_diff(before, after)
    assert diff.count() == 250
    semi = re.findall(r"(\w+Join).*LeftSemi", _plan(diff))
    assert len(semi) >= 4 and set(semi) == {"BroadcastHashJoin"}


def test_clustered_files_grow_in_number(spark, tmpdir_path, monkeypatch):
    monkeypatch.setattr(T, "FILE_ROWS", 25)
    df = M.schema_conform(spark.range(400).select(F.concat(F.lit("k"), F.col("id").cast("string")).alias("ID")))
    T.table_replace_sink(df, tmpdir_path, buckets=4)
    out = T.read_table(spark, tmpdir_path)
    sizes = [r["count"] for r in out.groupBy(F.input_file_name()).count().collect()]
    assert rows(out) == rows(df) and len(sizes) > 10 and max(sizes) < 60
    monkeypatch.setattr(T, "FILE_ROWS", 1000)
    T.table_replace_sink(df, tmpdir_path, buckets=4)
    assert T.read_table(spark, tmpdir_path).select(F.input_file_name()).distinct().count() == 4


def _tables(spark, root):
    n = spark.range(60)
    n.selectExpr("id AS doc_id", "'text' AS text", "'de' AS lang", "'s' AS source").write.parquet(f"{root}/documents.parquet")
    n.selectExpr("id AS doc_id", "0.5D AS quality", "id % 2 AS toxic").write.parquet(f"{root}/labels.parquet")
    n.selectExpr("id AS page_id", "'u' AS url", "'' AS html").write.parquet(f"{root}/pages.parquet")
    n.selectExpr("id div 10 AS conv_id", "id % 10 AS turn", "'assistant' AS role", "'t' AS text").write.parquet(f"{root}/conversations.parquet")
    spark.range(25).selectExpr("id AS n_nationkey", "'n' AS n_name").write.parquet(f"{root}/nation.parquet")
    return root


def test_derivations_join_alike_at_every_size(spark, tmpdir_path):
    root = _tables(spark, tmpdir_path)
    for derive in (X.derive_reviews, X.derive_feed_pages):
        df = derive(spark, root)
        df.collect()
        plan = _plan(df)
        assert plan.count("SortMergeJoin") == 3 and plan.count("BroadcastHashJoin") == 1  # the places


def test_derived_tables_are_written_small(spark, tmpdir_path):
    root = _tables(spark, tmpdir_path)
    df = materialized(spark, root, "growth", ("documents",), lambda s, d: s.read.parquet(f"{d}/documents.parquet"),
                      spark.read.parquet(f"{root}/documents.parquet").schema)
    assert df.count() == 60 and all(".zstd." in os.path.basename(f) for f in df.inputFiles())


def test_ledger_of_earlier_calls_shuffles_only_answers_given(spark, no_broadcast):
    requests = spark.range(1, 9).selectExpr("concat('p-', id) AS ID", "'reply' AS kind", "struct(id AS x) AS request")
    answers = spark.range(1, 9).selectExpr("concat('p-', id) AS ID", "'reply' AS kind", "concat('text ', id) AS content")
    ledger = _earlier_calls(requests, answers)
    assert rows(ledger, "ID", "attempt", "status", "content") == [
        ("p-1", 1, 200, "text 1"), ("p-2", 1, 429, None), ("p-3", 1, 500, None), ("p-3", 2, 500, None),
        ("p-5", 1, 200, "text 5"), ("p-6", 1, 429, None), ("p-7", 1, 500, None), ("p-7", 2, 500, None)]
    below = ledger._jdf.queryExecution().optimizedPlan().toString().split("Join Inner")[1]
    assert "CASE WHEN" in below and "> 0" in below
