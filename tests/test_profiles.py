"""Language by ranked n-gram profiles: by hand, edge cases, held-out accuracy."""
from conftest import SF01
from pyspark.sql import functions as F

from reviewops.operators import profiles as P
from reviewops.plans import QUERIES


def test_profile_counts_and_order():
    # Grams of _ab_ and _b_ (twice): "_" 6, "b" 3, "b_" 3, "_b" 2, "_b_" 2, then those seen once.
    assert P.text_profile(["ab", "b", "b"]) == ["_", "b", "b_", "_b", "_b_", "_a", "_ab", "a", "ab", "ab_"]
    assert P.text_profile(["ab", "b", "b"], 3) == ["_", "b", "b_"] and P.text_profile([]) == []


def test_training_counts_equal_the_text_profile(spark):
    text = "Straße, straße und ÉTÉ 12 a_b"
    counts = P.gram_counts(spark.createDataFrame([(text, "x"), (None, "x"), (text, None)], "t string, l string"), "t", "l").collect()
    ranked = [r.gram for r in sorted(counts, key=lambda r: (-r.n, r.gram))]
    assert ranked == P.text_profile(["straße", "straße", "und", "été", "a", "b"], 10_000) and {r.lang for r in counts} == {"x"}


def test_edge_cases(spark):
    rows = [(1, "the house and the dog", "en"), (2, "das haus und der hund", "de"), (3, None, "en"), (4, "", None), (5, "12 :-)", "de"),
            (6, "der hund", None), (6, "der hund", None), (7, "the " * 200_000, None)]
    df = spark.createDataFrame(rows, "id int, text string, lang string").withColumn("_found", F.lit(1)).withColumn("distance", F.lit(2))
    profiles = P.language_profiles(df, "text", "lang")
    out = P.detect_by_profile(df, profiles, "text")
    got = {r.id: (r.lang_pred, r.lang_distance) for r in out.collect()}
    assert out.count() == len(rows)
    assert [got[i][0] for i in (1, 2, 6, 7)] == ["en", "de", "de", "en"] and got[3] == got[4] == got[5] == ("und", None)
    none = P.language_profiles(df.filter("false"), "text", "lang")
    assert none == {} and P.detect_by_profile(df, none, "text").filter("lang_pred = 'und'").count() == len(rows)
    assert P.detect_by_profile(df.filter("false"), profiles, "text").collect() == []


def test_ties_take_the_smaller_name(spark):
    df = spark.createDataFrame([("same words", "b"), ("same words", "a")], "text string, lang string")
    assert [r.lang_pred for r in P.detect_by_profile(df, P.language_profiles(df, "text", "lang"), "text").collect()] == ["a", "a"]


def test_scoring_is_row_local(spark):
    df = spark.createDataFrame([("x",)], "text string")
    plan = P.detect_by_profile(df, {"a": ["x"]}, "text")._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Generate" not in plan


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SF01}/documents.parquet").select("doc_id", "lang", F.size(P.letter_runs(F.col("text"))).alias("words"))
    out = QUERIES["detect_language_profiles"](spark, SF01).join(docs, "doc_id").filter("held_out AND lang IS NOT NULL AND words > 0")
    right = F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))
    of_all, of_short = out.agg(right, F.avg(F.when(F.col("words") < 5, (F.col("lang") == F.col("lang_pred")).cast("int")))).first()
    assert of_all > 0.9 and (of_short is None or of_short > 0.5), (of_all, of_short)
