"""Plan shape: pushdown, no cartesian products, broadcast only of bounded sides."""
from conftest import SF001
from reviewops.plans import QUERIES


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_no_cartesian_nested_loop_or_window(spark):
    """No pair-producing joins; no window operator (a window sends a whole
    partition key to one task; picks per key use min_by/max_by instead)."""
    import re
    for name, fn in QUERIES.items():
        p = _plan(fn(spark, SF001))
        assert "CartesianProduct" not in p, name
        assert "BroadcastNestedLoopJoin" not in p, name
        assert not re.search(r"\bWindow\b", p), name


def test_worklist_filter_reaches_scan(spark):
    from reviewops.operators import worklists as W
    df = spark.read.parquet(f"{SF001}/events.parquet")
    from reviewops.sources.usage import usage_window
    import datetime as dt
    p = _plan(usage_window(df, dt.datetime(2024, 1, 5), dt.datetime(2024, 1, 6)))
    assert "PushedFilters: [IsNotNull(ts), GreaterThanOrEqual(ts" in p
    assert "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz,user_id:bigint,event_type:string,value:double>" in p
    assert W is not None


def test_classifiers_are_row_local(spark):
    from pyspark.sql import functions as F

    from reviewops.operators import classify as C
    from reviewops.operators.merge import schema_conform
    df = schema_conform(spark.read.parquet(f"{SF001}/documents.parquet").select(
        F.col("doc_id").cast("string").alias("ID"), F.lit("Indeed").alias("Portal"),
        F.col("text").alias("ReviewText")))
    for out in (C.detect_language(df), C.classify_aspects(df),
                df.select(C.sensitive_flag(F.col("ReviewText")))):
        p = out._jdf.queryExecution().executedPlan().toString()
        assert "Generate" not in p and "Exchange" not in p, p


def test_refresh_worklist_filters_reach_the_files(spark):
    """Every wide scan of the work-list has a pushed date filter; only ID and date are read without one."""
    from reviewops.operators import worklists as W
    from reviewops.schema import FIXTURE_ASOF
    from reviewops.sources.fixtures import reviews

    table = reviews(spark, SF001)
    for build in (W.refresh_worklist, W.refresh_worklist_distinct):
        for n in (20, -1):
            df = build(table, FIXTURE_ASOF, n)
            df.collect()
            plan = df._jdf.queryExecution().explainString(
                spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
            scans = [x for x in plan.split("\n\n") if "Scan parquet" in x and "ReadSchema" in x]
            wide = [x for x in scans if "ReviewText" in x]
            pushed = [x.split("PushedFilters")[1].split("ReadSchema")[0] if "PushedFilters" in x else "" for x in wide]
            assert len(pushed) >= 2 and all("RefreshDate" in x for x in pushed)
            assert any("ReviewDate" in x for x in pushed) and any("quer" in x for x in pushed), pushed
