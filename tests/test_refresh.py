"""Page refresh with the real portal page structure (inline HTML)."""
import datetime as dt

from reviewops.operators.merge import schema_conform
from reviewops.operators.refresh import apply_refresh

ASOF = dt.date(2024, 1, 31)
INDEED = ('<div class="css-14nhnfd e37uo190"><p>review</p>'
          '<div class="css-j3kgaw e1wnkr790">Danke<br>Team &amp; Co</div></div>')
INDEED_NO_REPLY = '<div class="css-14nhnfd e37uo190"><p>review</p></div>'
GLASSDOOR = ('<div class="review-details_reviewDetails__wSGbU">x'
             '<span data-test="review-text-undefined">Thanks!</span></div>')
KUNUNU = ('<div class="index__responseBlock__A5fqZ"><h4>Antwort</h4>'
          '<div class="p-small-regular">Hallo<br/>zusammen</div></div>')
KUNUNU_NO_TEXT = '<div class="index__responseBlock__A5fqZ"><h4>Antwort</h4></div>'


def test_apply_refresh_real_portals(spark):
    rows = schema_conform(spark.createDataFrame([
        ("i1", "Indeed", "old", "Pending", "No", "Yes"),
        ("i2", "indeed", "old", "Pending", "Yes", "Yes"),
        ("i3", "Indeed", "old", "Pending", "No", "Yes"),
        ("g1", "Glassdoor", None, None, "No", None),
        ("g2", "Glassdoor", None, None, "Yes", None),
        ("k1", "kununu", None, None, "No", None),
        ("k2", "kununu", None, None, "No", None),
        ("gone", "kununu", "r", "Approved", "Yes", "Yes"),
        ("flaky", "Indeed", "old", "Pending", "No", "Yes"),
        ("never", "Indeed", "old", "Pending", "No", "Yes"),
    ], "ID string, Portal string, Response string, ApprovalStatus string, "
       "ResponsePostedYesNo string, OnlineYesNo string"))
    fetches = spark.createDataFrame(
        [("i1", 1, 200, INDEED), ("i2", 1, 200, INDEED_NO_REPLY), ("i3", 1, 200, "<html>changed</html>"),
         ("g1", 1, 200, GLASSDOOR), ("g2", 1, 200, "<div>nothing</div>"),
         ("k1", 1, 200, KUNUNU), ("k2", 1, 200, KUNUNU_NO_TEXT), ("gone", 1, 404, None),
         ("flaky", 1, 500, None), ("flaky", 2, 429, None), ("flaky", 3, 200, INDEED)]
        + [("never", a, 503, None) for a in range(1, 12)],
        "ID string, attempt int, status int, html string")
    out = {r["ID"]: r.asDict() for r in apply_refresh(rows, fetches, ASOF).collect()}

    def view(i):
        r = out[i]
        return (r["OnlineYesNo"], r["RefreshDate"], r["ResponsePostedYesNo"], r["Response"],
                r["ApprovalStatus"])

    assert view("i1") == ("Yes", ASOF, "Yes", "Danke\nTeam & Co", "Approved")
    assert view("i2") == ("Yes", ASOF, "No", "old", "Pending")
    assert view("i3") == ("Yes", ASOF, "No", "old", "Pending")  # review block missing: parse error
    assert view("g1") == ("Yes", ASOF, "Yes", "Thanks!", "Approved")
    assert view("g2") == ("Yes", ASOF, "Yes", None, None)  # parse error keeps the flag
    assert view("k1") == ("Yes", ASOF, "Yes", "Hallo\nzusammen", "Approved")
    assert view("k2") == ("Yes", ASOF, "Yes", None, None)  # block without its text element
    assert view("gone") == ("No", ASOF, "Yes", "r", "Approved")
    assert view("flaky") == ("Yes", ASOF, "Yes", "Danke\nTeam & Co", "Approved")
    assert view("never") == ("Yes", None, "No", "old", "Pending")  # no terminal attempt


def test_employment_block_nested_markup(spark):
    from reviewops.functions.html import css
    from reviewops.operators.ingest import supplement_kununu

    cls = "index__employmentInfoBlock__wuOtj p-tiny-regular"
    page = (f'<div class="{cls}"><div><b>Ex-Fahrer/in</b></div><div class="x">'
            '<span>Hat bis 2021 im Bereich Logistik bei Firma gearbeitet.</span></div></div>')
    no_span = f'<div class="{cls}"><b>Fahrer</b></div>'
    rows = schema_conform(spark.createDataFrame([("a", "kununu"), ("b", "kununu"), ("c", "kununu")],
                                                "ID string, Portal string"))
    fetched = spark.createDataFrame([("a", page), ("b", no_span)], "ID string, html string")
    out = {r["ID"]: r.asDict() for r in supplement_kununu(rows, fetched, css(cls, "div")).collect()}
    a = out["a"]
    assert (a["JobTitle"], a["CurrentFormerEmployee"], a["Department"],
            a["ContractTerminationKununuOnly"]) == ("Ex-Fahrer/in", "Former", "Logistik", 2021)
    assert out["b"]["JobTitle"] is None and out["c"]["JobTitle"] is None
