"""One key holding a third of all rows: results stay whole and exact, and the
per-key work is pre-aggregated inside each task before the shuffle."""
from pyspark.sql import functions as F

from conftest import rows
from reviewops.operators import audit as A
from reviewops.operators import classify as C
from reviewops.operators import merge as M
from reviewops.operators.merge import schema_conform

N = 30_000


def _skewed(spark):
    df = spark.range(N).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("k"), F.col("id")))
        .alias("ID"), F.col("id").alias("seq"), (F.col("id") % 7).cast("string").alias("v"))
    return df.repartition(8)


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_dedupe_hot_key(spark):
    out = M.dedupe_incoming(_skewed(spark), "seq")
    assert out.count() == 1 + (N - N // 3)
    assert out.filter(F.col("ID") == "hot").first()["v"] == "0"  # first in feed order (seq 0)
    assert "partial_min_by" in _plan(out)


def test_key_guard_and_counts_hot_key(spark):
    df = _skewed(spark)
    dup = A.duplicate_ids(df)
    assert rows(dup, "ID", "id_count") == [("hot", N // 3)]
    assert "partial_count" in _plan(dup)
    summary = df.groupBy("v").agg(F.count(F.lit(1)).alias("n"))
    assert sum(r["n"] for r in summary.collect()) == N


def test_individuality_boilerplate_in_a_third_of_replies(spark):
    boiler = "Vielen Dank fuer Ihre ausfuehrliche Bewertung und Ihr Feedback"
    df = spark.range(3000).select(
        F.concat(F.lit("r"), F.col("id")).alias("ID"),
        F.when(F.col("id") % 3 == 0, F.concat(F.lit(boiler + "\n"), F.lit("Eigener Text Nummer "),
                                              F.col("id").cast("string"), F.lit(" mit Inhalt")))
        .otherwise(F.concat(F.lit("Einzigartige Antwort Nummer "), F.col("id").cast("string"),
                            F.lit(" ohne Baustein"))).alias("Response"))
    got = C.individuality_score(schema_conform(df))
    by_score = dict(got.groupBy("individuality").count().collect())
    # one shared block -> <= 1 block -> 5 for everyone; no row lost or duplicated
    assert by_score == {5.0: 3000}
    assert "partial_count" in _plan(got)


def test_identical_reply_in_a_third_of_rows_is_split(spark):
    """The same reply text for a third of all reviews makes one join key hot.
    Identical rows compress well, so AQE's byte-based skew split would not
    see it; the hot key is joined by broadcast instead (automatic broadcasts
    off here, so any broadcast is the explicit split) and scores stay exact."""
    same = "Danke fuer Ihr Feedback, wir melden uns bald bei Ihnen persoenlich"
    n = 6000
    df = spark.range(n).select(
        F.concat(F.lit("r"), F.col("id")).alias("ID"),
        F.when(F.col("id") % 3 == 0, F.lit(same))
        .otherwise(F.concat(F.lit("Eigene Antwort Nummer "), F.col("id").cast("string")))
        .alias("Response")).repartition(8)
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        got = C.individuality_score(schema_conform(df))
        collected = got.collect()  # runs this frame's own adaptive plan
        assert len(collected) == n
        by_score = {}
        for r in collected:
            by_score[r["individuality"]] = by_score.get(r["individuality"], 0) + 1
        assert by_score == {1.0: n // 3, 5.0: n - n // 3}
        final = got._jdf.queryExecution().executedPlan().toString()
        assert "BroadcastHashJoin [_h" in final
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_split_join_equals_plain_join(spark):
    """Hot keys (one with a third of the rows, one absent from the other
    side) and cold keys: the split join returns exactly the plain join."""
    from reviewops.operators.hotkeys import hot_keys, join_splitting_hot_keys
    big = spark.range(N).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot"))
        .when(F.col("id") % 5 == 0, F.lit("hot-unmatched"))
        .when(F.col("id") % 7 == 0, F.lit(None).cast("string"))  # a hot NULL group
        .otherwise(F.concat(F.lit("k"), (F.col("id") % 997).cast("string"))).alias("k"),
        F.col("id"))
    counts = big.groupBy("k").agg(F.count(F.lit(1)).alias("n"))
    other = counts.filter(F.col("k") != "hot-unmatched").filter(
        (F.col("k") == "hot") | (F.length("k") % 2 == 0)).select("k", F.col("n").alias("m"))
    hot = hot_keys(counts.filter(F.col("n") > 1000), "k", "n", F.lit(N))
    assert sorted(r["k"] for r in hot.collect() if r["k"] is not None) == ["hot", "hot-unmatched"]
    assert any(r["k"] is None for r in hot.collect())
    for how in ("inner", "left_semi"):
        got = join_splitting_hot_keys(big, other, "k", how, hot)
        assert rows(got) == rows(big.join(other, "k", how).select(*got.columns)), how


def test_take_while_with_one_feed_holding_a_third(spark):
    """One portal feed holds a third of all landed reviews: the per-feed cut
    is a partially aggregated minimum joined back, and the kept rows equal
    a plain-Python take-while in (page, pos) order."""
    import datetime as dt

    from reviewops.operators import ingest as I
    since = dt.datetime(2024, 1, 10)
    data = []
    for i in range(3000):
        feed = ("indeed", "de") if i % 3 == 0 else (("kununu", f"l{i % 7}") if i % 2 else ("indeed", f"x{i % 5}"))
        data.append((feed[0], feed[1], i))
    df = spark.createDataFrame(data, "portal string, lang string, i long")
    df = df.select(F.lit("run").alias("run_id"), "portal", "lang", (F.col("i") % 97).alias("page"), (F.col("i") % 13).alias("pos"),
                   # newest first along (page, pos), old from page 60 on in every feed
                   F.when(F.col("i") % 97 >= 60, F.lit(dt.datetime(2024, 1, 1)))
                   .otherwise(F.lit(dt.datetime(2024, 1, 20))).alias("ts"), "i").repartition(8)
    got = I.feed_prefix(df, since, "feed")
    expected = set()
    by_feed = {}
    for p, lang, i in data:
        by_feed.setdefault((p, lang), []).append((i % 97, i % 13, i))
    for rows_ in by_feed.values():
        for page, pos, i in sorted(rows_):
            if page >= 60:
                break
            expected.add(i)
    assert {r["i"] for r in got.select("i").collect()} == expected
    plan = _plan(got)
    assert "partial_min" in plan and "CartesianProduct" not in plan


def test_place_join_spreads_blank_locations(spark):
    """A third of the rows has no Location and a third is in one city: blank rows
    join on keys of their own, so no task of the shuffle join holds them all;
    the big city is one key, which adaptive execution may split."""
    from reviewops.operators.merge import schema_conform

    n = 6000
    df = schema_conform(spark.range(n).select(
        F.concat(F.lit("r"), F.col("id")).alias("ID"),
        F.when(F.col("id") % 3 == 1, F.when(F.col("id") % 2 == 0, F.lit("")).otherwise(None))
        .when(F.col("id") % 3 == 2, "Bonn").otherwise(F.concat(F.lit("p"), F.col("id") % 50)).alias("Location")))
    places = spark.createDataFrame([("Bonn", "NRW", "DE"), ("p0", "X", "FR"), ("p0", "A", "ES"), ("", "bad", "bad")],
                                   "place string, state_region string, country string")
    old = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled")}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        out = C.geo_enrich(df, places)
        blank = [r["n"] for r in out.filter("coalesce(Location, '') = ''").groupBy(F.spark_partition_id()).agg(
            F.count("*").alias("n")).collect()]
        assert len(blank) >= 6 and max(blank) < 2 * sum(blank) / len(blank)
        got = {tuple(r) for r in out.select("Location", "StateRegion", "Country").distinct().collect()}
        assert ("Bonn", "NRW", "DE") in got and ("p0", "A", "ES") in got and (None, None, None) in got and ("", None, None) in got
        assert out.count() == n
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
