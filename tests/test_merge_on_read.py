"""Patches on a table version: reads equal a full rewrite, writes cost what the batch costs."""
import os

import pytest
from pyspark.sql import functions as F

from conftest import SF001, rows
from reviewops.operators import merge as M
from reviewops.operators.merge import schema_conform
from reviewops.plans.pipeline import run_batch
from reviewops.sinks import table as T
from reviewops.sources.fixtures import model_answers, reviews


def _changed(table, every, tag):
    picked = table.filter(F.pmod(F.xxhash64("ID", F.lit(tag)), F.lit(every)) == 0).withColumn("Response", F.lit(tag))
    new = schema_conform(table.sparkSession.createDataFrame([(f"new-{tag}", tag), ("new-all", tag)], "ID string, Response string"))
    return picked.unionByName(new)


def _bytes(spark, path):
    fs, p, _ = T._fs(spark, path)
    return fs.getContentSummary(p).getLength()


def test_reads_equal_a_full_rewrite(spark, tmpdir_path):
    patched, rewritten = (os.path.join(tmpdir_path, x) for x in ("patched", "rewritten"))
    base = reviews(spark, SF001)
    for root in (patched, rewritten):
        T.table_replace_sink(base, root)
    for k, (every, tag) in enumerate([(2, "one"), (3, "two"), (4, "three")], 1):
        batch = _changed(base, every, tag).checkpoint()
        assert T.table_patch_sink(batch, patched) == k
        T.table_replace_sink(M.merge_upsert(T.read_table(spark, rewritten), batch), rewritten)
        assert rows(T.read_table(spark, patched)) == rows(T.read_table(spark, rewritten))
    assert T.compact(spark, patched, buckets=4) == 2
    assert T.patched_rows(spark, patched) is None
    assert rows(T.read_table(spark, patched)) == rows(T.read_table(spark, rewritten))
    # patches of the older version are not laid over the new one; a new patch is its first
    assert T.table_patch_sink(_changed(base, 5, "four"), patched) == 1
    assert {r.Response for r in T.read_table(spark, patched).filter("ID = 'new-all'").collect()} == {"four"}


def test_a_patch_costs_what_its_rows_cost(spark, tmpdir_path, monkeypatch):
    root = os.path.join(tmpdir_path, "table")
    base = reviews(spark, SF001)
    T.table_replace_sink(base, root)
    batch = base.limit(3).checkpoint()
    monkeypatch.setattr(T, "read_table", lambda *a: pytest.fail("the table was read"))
    T.table_patch_sink(batch, root)
    assert _bytes(spark, f"{root}/patches") < _bytes(spark, T.version_path(root, 1)) / 2
    monkeypatch.undo()
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = T.read_table(spark, root)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    # a measured patch is broadcast, so no row of the version is shuffled
    assert "BroadcastHashJoin" in plan and "hashpartitioning" not in plan


def test_unfinished_and_invalid_patches(spark, tmpdir_path):
    root = os.path.join(tmpdir_path, "table")
    base = schema_conform(spark.createDataFrame([("a", "base"), ("b", "base")], "ID string, Response string"))
    assert T.table_patch_sink(base, root) == 0 and T.current_version(spark, root) == 1
    new = base.filter("ID = 'a'").withColumn("Response", F.lit("patch"))
    T.table_patch_sink(new, root)
    T.table_patch_sink(new.withColumn("Response", F.lit("died")), root)
    os.unlink(os.path.join(root, "patches", "version=000001", "patch=000002", "_SUCCESS"))
    assert rows(T.read_table(spark, root), "ID", "Response") == [("a", "patch"), ("b", "base")]
    assert T.table_patch_sink(new.withColumn("Response", F.lit("again")), root) == 3
    assert rows(T.read_table(spark, root), "ID", "Response") == [("a", "again"), ("b", "base")]
    with pytest.raises(Exception, match="DUPLICATE_KEY"):
        T.table_patch_sink(new.unionByName(new), root)
    assert rows(T.read_table(spark, root), "ID", "Response") == [("a", "again"), ("b", "base")]


def test_filters_see_the_patched_value(spark, tmpdir_path):
    root = os.path.join(tmpdir_path, "table")
    base = schema_conform(spark.createDataFrame([("a", "x"), ("b", "x")], "ID string, Response string"))
    T.table_replace_sink(base, root)
    for text in ("y", "z"):
        T.table_patch_sink(base.filter("ID = 'a'").withColumn("Response", F.lit(text)), root)
    t = T.read_table(spark, root)
    assert [rows(t.filter(F.col("Response") == x), "ID") for x in "xyz"] == [[("b",)], [], [("a",)]]


def test_batch_written_as_a_patch_equals_a_version(spark, tmpdir_path):
    import datetime as dt

    out = {}
    for name, on_read in (("patch", True), ("version", False)):
        root = os.path.join(tmpdir_path, name)
        T.table_replace_sink(reviews(spark, SF001), root)
        out[name] = run_batch(spark, root, model_answers(spark, SF001), asof=dt.date(2024, 1, 31), merge_on_read=on_read)
        out[name + "_rows"] = rows(T.read_table(spark, root))
    assert out["patch"]["patch"] == 1 and "version" not in out["patch"] and "errors" not in out["patch"]
    assert out["patch_rows"] == out["version_rows"]
