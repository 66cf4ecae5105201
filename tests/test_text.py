"""Scalar text functions on small inline rows (edge cases of the reference)."""
import json

from pyspark.sql import functions as F

from reviewops.functions import answers as AN
from reviewops.functions import text as TX
from reviewops.functions.html import Selector, block_text, css


def _one(spark, expr, *vals, schema="a string, b string"):
    df = spark.createDataFrame([vals], schema)
    return df.select(expr.alias("x")).first()["x"]


def test_strip_labels_kununu(spark):
    cases = {
        "Gut\n\nwork life rating: 4/5 \nsalary rating: 3/5 ": "Gut\nwork \n",
        "x rating: 4.5/5 ok": "x rating: 4.5/5 ok",
        "atmosphere rating: 5/5": "atmosphere rating: 5/5",
        "\n\natmosphere rating: 5/5 ": "",
        "\n": "",
        "": "",
    }
    for text, want in cases.items():
        got = _one(spark, TX.strip_labels(F.col("a"), F.col("b")), "KUNUNU", text)
        assert got == want, (text, got)


def test_strip_labels_indeed_and_other(spark):
    assert _one(spark, TX.strip_labels(F.col("a"), F.col("b")), "Indeed",
                "Pros: a\n\nCons: b\n\nc Pros: d") == "a\n\nb\n\nc d"
    assert _one(spark, TX.strip_labels(F.col("a"), F.col("b")), "Glassdoor", "Pros: a") == "Pros: a"


def test_parse_feed_ts(spark):
    for s, ok in [("2024-01-05T10:11:12.345", True), ("2024-01-05T10:11:12", True),
                  ("2024-01-05 10:11:12", False), ("garbage", False), ("2024-02-30T00:00:00", False),
                  ("2024-01-05T10:11:12Z", False), ("2024-01-05", False), ("2024-3-5T1:2:3", True)]:
        got = _one(spark, TX.parse_feed_ts(F.col("a")), s, None)
        assert (got is not None) == ok, s


def test_compose_texts(spark):
    f = lambda p, c, b: _one(spark, TX.compose_indeed_text(F.col("a"), F.col("b"), F.col("c")),  # noqa
                             p, c, b, schema="a string, b string, c string")
    assert f("p", "c", "body") == "Pros: p\n\nCons: c\n\nbody"
    assert f(None, "c", "body") == "Cons: c\n\nbody"
    assert f("p", "", "") == "Pros: p\n\n"
    g = lambda p, c: _one(spark, TX.compose_glassdoor_text(F.col("a"), F.col("b")), p, c)  # noqa
    assert g("p", "c") == "Pros: p\n\nCons: c"
    assert g(None, "c") == "Cons: c"
    assert g("p", None) == "Pros: p"
    assert g("", None) is None


def test_rating_labels(spark):
    review = {"text": "", "work_life_rating": {"rating": 4, "text": "gut"},
              "id": "1", "atmosphere_rating": {"rating": 2, "text": None},
              "salary_rating": {"rating": 5, "text": ""}}
    raw = json.dumps(review)
    got = _one(spark, TX.rating_labels(F.col("a"), F.col("b")), raw, "")
    assert got == "work life rating: 4/5 gut\natmosphere rating: 2/5 \nsalary rating: 5/5 "
    got = _one(spark, TX.compose_kununu_text(F.col("a"), F.col("b")), raw, "Body")
    assert got == "Body\n\nwork life rating: 4/5 gut\natmosphere rating: 2/5 \nsalary rating: 5/5 "
    assert _one(spark, TX.compose_kununu_text(F.col("a"), F.col("b")), '{"text": null}', None) == ""


def test_answer_object(spark):
    def parse(content):
        df = spark.createDataFrame([(content,)], "a string")
        obj = AN.answer_object(F.col("a"))
        r = df.select(obj.isNotNull().alias("ok"), AN.answer_get(obj, "Response").alias("r"),
                      AN.answer_get(obj, "country").alias("c")).first()
        return r["ok"], r["r"], r["c"]

    assert parse("no brace") == (False, None, None)
    assert parse('x {"Response": "a", "response": "b", "COUNTRY": "DE"} y') == (True, "b", "DE")
    assert parse('{"a": {"Response": "inner"}}')[0] is False  # cut at the inner brace: {"a": }
    assert parse('{"a": {"Response": "inner"}}')[1] is None
    assert parse('{"Response": "x"} {"Response": "y"}')[1] == "x"
    assert parse('{"Response": "unclosed')[0] is False
    assert parse('{"Response": "line\nbreak"}')[0] is False  # raw control char
    assert parse("{'Response': 'single'}")[0] is False


def test_choice_content_and_unescape(spark):
    body = json.dumps({"choices": [{"message": {"content": "hi\\nthere"}}]})
    got = _one(spark, TX.unescape_newline(AN.choice_content(F.col("a"))), body, None)
    assert got == "hi\nthere"


def test_html_block_text(spark):
    html = ('<html><div class="c1 c2"><p>Hello &amp;lt;b&amp;gt;<br>World &quot;x&quot;</p>'
            '</div><article id="a">Art<br/>icle</article></html>')
    assert _one(spark, block_text(F.col("a"), css("c1 c2", "div")), html, None) == \
        'Hello &lt;b&gt;\nWorld "x"'
    assert _one(spark, block_text(F.col("a"), Selector(tag="article")), html, None) == "Art\nicle"
    assert _one(spark, block_text(F.col("a"), css("missing")), html, None) is None
