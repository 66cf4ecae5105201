"""Merge modes and the key guard."""
import pytest
from pyspark.sql import functions as F

from conftest import SF001, rows
from reviewops.operators import audit as A
from reviewops.operators import merge as M
from reviewops.schema import REVIEW_SCHEMA, empty_reviews
from reviewops.sources.fixtures import merge_incoming, merge_target


def _mk(spark, data):
    from reviewops.operators.merge import schema_conform
    return schema_conform(spark.createDataFrame(data, "ID string, Response string"))


def test_modes(spark):
    t = _mk(spark, [("a", "x"), ("b", "y")])
    i = _mk(spark, [("b", None), ("c", "z")])
    assert rows(M.merge_insert(t, i), "ID", "Response") == [("a", "x"), ("b", "y"), ("c", "z")]
    assert rows(M.merge_update(t, i), "ID", "Response") == [("a", "x"), ("b", None)]
    assert rows(M.merge_upsert(t, i), "ID", "Response") == [("a", "x"), ("b", None), ("c", "z")]
    assert rows(M.merge(t, i, False, False), "ID", "Response") == [("a", "x"), ("b", "y")]
    assert rows(M.merge_upsert(t, empty_reviews(spark)), "ID") == [("a",), ("b",)]


def test_duplicate_incoming_key_rejected(spark):
    t = _mk(spark, [("a", "x")])
    i = _mk(spark, [("b", "1"), ("b", "2")])
    with pytest.raises(M.DuplicateKeyError):
        M.merge_upsert(t, i, validate="eager")
    with pytest.raises(Exception, match="DUPLICATE_KEY"):
        M.merge_upsert(t, i).collect()
    nulls = _mk(spark, [(None, "1")])
    with pytest.raises(M.DuplicateKeyError):
        M.check_unique_keys(nulls)


def test_merge_is_idempotent(spark):
    t, i = merge_target(spark, SF001), merge_incoming(spark, SF001)
    once = M.merge_upsert(t, i)
    twice = M.merge_upsert(once, i)
    assert rows(once, "ID", "OverallSatisfaction") == rows(twice, "ID", "OverallSatisfaction")
    ins = M.merge_insert(t, i)
    assert rows(M.merge_insert(ins, i), "ID") == rows(ins, "ID")


def test_dedupe_keeps_first_in_feed_order(spark):
    df = spark.createDataFrame([("a", 2, "late"), ("a", 1, "early"), ("b", 5, "only")],
                               "ID string, seq int, v string")
    assert rows(M.dedupe_incoming(df, "seq")) == [("a", "early"), ("b", "only")]


def test_row_diff(spark):
    b = _mk(spark, [("a", "x"), ("b", "y")])
    a = _mk(spark, [("b", "z"), ("c", "w")])
    got = rows(A.row_diff(b, a), "ID", "status", "changed_columns")
    assert got == [("a", "removed", None), ("b", "changed", "Response"), ("c", "added", None)]


def test_row_diff_edges(spark):
    """NULL -> '' is a change; -0.0 vs 0.0 differs in the row fingerprint but
    is equal by value, so the exact compare drops it; identical rows vanish."""
    schema = "ID string, s string, d double, t string"
    b = spark.createDataFrame([("n", None, 1.0, "x"), ("z", "k", 0.0, "x"), ("same", "k", 2.0, None),
                               ("two", "p", 3.0, "q")], schema)
    a = spark.createDataFrame([("n", "", 1.0, "x"), ("z", "k", -0.0, "x"), ("same", "k", 2.0, None),
                               ("two", "p2", 3.5, "q")], schema)
    got = rows(A.row_diff(b, a), "ID", "status", "changed_columns")
    assert got == [("n", "changed", "s"), ("two", "changed", "s,d")]


def test_partition_count_does_not_change_result(spark):
    t, i = merge_target(spark, SF001), merge_incoming(spark, SF001)
    base = rows(M.merge_upsert(t, i), "ID", "OverallSatisfaction")
    more = rows(M.merge_upsert(t.repartition(7), i.repartition(3)), "ID", "OverallSatisfaction")
    assert base == more


def test_row_level_merge_needs_a_table_format(spark, tmpdir_path):
    """``merge_into_table`` is for formats with row-level MERGE (Delta,
    Iceberg); on a plain Parquet table Spark refuses it and writes nothing."""
    name = "reviewops_merge_plain"
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    spark.sql(f"CREATE TABLE {name} (ID string, x int) USING parquet LOCATION '{tmpdir_path}/t'")
    try:
        spark.createDataFrame([("a", 1)], "ID string, x int").write.insertInto(name)
        incoming = spark.createDataFrame([("a", 2), ("b", 3)], "ID string, x int")
        with pytest.raises(Exception, match="does not support MERGE"):
            M.merge_into_table(incoming, name, insert_new=True, update_existing=True)
        assert rows(spark.table(name)) == [("a", 1)]
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {name}")
