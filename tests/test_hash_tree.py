"""The before/after difference by a hash tree equals the full outer join and moves what changed."""
import re

from pyspark.sql import functions as F

from conftest import SF01, rows
from reviewops.operators import audit as A
from reviewops.operators.merge import schema_conform
from reviewops.sources.fixtures import reviews


def test_equals_the_full_join(spark):
    table = reviews(spark, SF01)
    n = F.pmod(F.xxhash64("ID"), F.lit(50))
    after = table.filter(n != 3).withColumn("Response", F.when(n == 4, F.lit("new")).when(n == 5, F.lit(None).cast("string")).otherwise(F.col("Response")))
    after = after.withColumn("OverallSatisfaction", F.when(n == 6, F.col("OverallSatisfaction") + 1).otherwise(F.col("OverallSatisfaction")))
    after = after.unionByName(schema_conform(spark.createDataFrame([("n1",), ("n2",)], "ID string")))
    want = rows(A.row_diff(table, after, levels=()))
    assert len(want) > 30 and rows(A.row_diff(table, after)) == want
    assert rows(A.row_diff(table, after, levels=(1,))) == rows(A.row_diff(table, after, levels=(3, 6, 9))) == want
    assert A.row_diff(table, table).count() == 0


def test_values_that_read_alike_are_told_apart(spark):
    schema = "ID string, a string, b string, t timestamp_ntz, x double"

    def one(values):
        return spark.createDataFrame([], schema).unionByName(spark.sql(
            f"SELECT 'k' AS ID, {values[0]} AS a, {values[1]} AS b, CAST('2024-01-01 00:00:00{values[2]}' AS timestamp_ntz) AS t, CAST({values[3]} AS double) AS x"))

    base = ("'p'", "NULL", "", "0.5")
    assert A.row_diff(one(base), one(base)).count() == 0
    for other, changed in ((("NULL", "'p'", "", "0.5"), "a,b"), (("'p'", "''", "", "0.5"), "b"), (("'p'", "'-'", "", "0.5"), "b"),
                           (("'p'", "NULL", ".000001", "0.5"), "t"), (("'p'", "NULL", "", "0.5000000000000001"), "x"), (("'p-'", "NULL", "", "0.5"), "a")):
        assert rows(A.row_diff(one(base), one(other)), "status", "changed_columns") == [("changed", changed)]


def test_repeated_and_null_keys(spark):
    schema = "ID string, a string"
    two = spark.createDataFrame([("k", "x"), ("k", "x"), (None, "y"), ("m", "z")], schema)
    one = spark.createDataFrame([("k", "x"), (None, "y"), ("m", "z")], schema)
    # the count of a bucket tells a row that was there twice; the join lists keys as before
    assert A.unequal_buckets(A._digested(two, "ID", ["a"]), A._digested(one, "ID", ["a"]), 12).count() == 1
    assert rows(A.row_diff(two, one)) == []
    assert rows(A.row_diff(two.filter("ID = 'm'"), one.filter("ID IS NULL")), "ID", "status") == [("m", "removed"), (None, "added")]


def test_rows_that_meet_are_those_of_changed_buckets(spark):
    table = reviews(spark, SF01)
    after = table.withColumn("Response", F.when(F.col("ID").isin([r.ID for r in table.limit(3).collect()]), F.lit("changed")).otherwise(F.col("Response")))
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        diff = A.row_diff(table, after)
        assert diff.count() == 3
        live = A.unequal_buckets(A._digested(table, "ID", [c for c in table.columns if c != "ID"]),
                                 A._digested(after, "ID", [c for c in table.columns if c != "ID"]), 20)
        met = table.filter("ID IS NOT NULL").withColumn("bucket", F.shiftrightunsigned(F.xxhash64("ID"), 44)).join(live, "bucket", "left_semi")
        assert live.count() == 3 and met.count() <= 4 < table.count() / 100
        # and the join on the key comes after the bucket filter in the plan
        plan = diff._jdf.queryExecution().executedPlan().toString()
        assert len(re.findall("LeftSemi", plan)) >= 4
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
