"""Feed JSON from disk through scan, guard, pinned drop, take-while and normalize."""
import datetime as dt
import json
import os

from conftest import SF001, rows
from reviewops.operators import ingest as I
from reviewops.sources.feed import feed_rejects, feed_scan, landed_scan
from reviewops.sources.fixtures import feed_pages

ASOF = dt.date(2024, 1, 31)


def _write_landed(path, records):
    os.makedirs(path, exist_ok=True)
    with open(os.path.join(path, "part-0.json"), "w") as f:
        for r in records:
            f.write(json.dumps(r) + "\n")


def _page(portal, page, reviews, lang="all", raw=None, run="run-1"):
    body = raw if raw is not None else json.dumps({"reviews": reviews}, indent=1)
    return {"run_id": run, "portal": portal, "lang": lang, "page": page, "body": body}


def _rev(i, ts, **kw):
    r = {"id": str(i), "url": f"u{i}", "title": f"t{i}", "datetime": ts, "rating": 4, "text": "body",
         "reviewer": "Fahrer", "location": "Bonn"}
    r.update(kw)
    return r


def test_json_pages_end_to_end(spark, tmpdir_path):
    _write_landed(tmpdir_path, [
        _page("Indeed", 0, [_rev(1, "2024-01-01T00:00:00", reviewer_employee_type="Former Employee"),
                            _rev(2, "2024-01-30T10:00:00.123", pros="p", cons=None,
                                 reviewer_employee_type="Current Employee, 2 years"),
                            _rev(3, "2024-01-20T00:00:00", reviewer_employee_type="Current"),
                            _rev(4, "2023-12-01T00:00:00", reviewer_employee_type="Current"),
                            _rev(5, "2024-01-29T00:00:00", reviewer_employee_type="Current")]),
        _page("glassdoor", 0, [_rev(10, "2024-01-29T00:00:00", pros=None, cons="c", is_current_job=True),
                               _rev(11, "2023-01-01T00:00:00", is_current_job=False),
                               _rev(12, "2024-01-29T00:00:00", is_current_job=False)], lang="de"),
        _page("glassdoor", 1, [_rev(13, "2024-01-29T00:00:00", pros="p", cons="c")], lang="de"),
        _page("KUNUNU", 0, [dict(_rev(20, "2024-01-29T00:00:00", text=""), company={"city": "Köln"},
                                 reply={"text": "Danke"},
                                 work_life_rating={"rating": 4, "text": "ok"})]),
        _page("xing", 0, [_rev(30, "2024-01-29T00:00:00")]),
        _page("Indeed", 9, [], raw="not json"),
        _page("Indeed", 8, []),
    ])
    landed = landed_scan(spark, tmpdir_path)
    assert rows(feed_rejects(landed), "page") == [(9,)]
    feed = feed_scan(landed)
    out = I.extract_new_reviews(feed, dt.datetime(2024, 1, 10), ASOF)
    got = {r["ID"]: r.asDict() for r in out.collect()}
    # Indeed: pinned first review dropped, take-while stops at id 4 (whole feed)
    # Glassdoor: stops per page (id 11 ends page 0, page 1 still read)
    assert sorted(got) == ["10", "13", "2", "20", "3"]
    assert got["2"]["ReviewText"] == "Pros: p\n\nbody"
    assert got["2"]["CurrentFormerEmployee"] == "Current"
    assert got["2"]["ReviewDate"] == dt.date(2024, 1, 30)
    assert got["10"]["ReviewText"] == "Cons: c" and got["10"]["CurrentFormerEmployee"] == "Current"
    k = got["20"]
    assert k["ReviewText"] == "work life rating: 4/5 ok" and k["Location"] == "Köln"
    assert (k["Response"], k["ResponsePostedYesNo"], k["ApprovalStatus"]) == ("Danke", "Yes", "Approved")
    assert k["RefreshDate"] == ASOF and k["OnlineYesNo"] == "Yes"
    _, rejected = I.portal_guard(feed)
    assert rows(rejected, "id") == [("30",)]


NEW, OLD = "2024-01-29T00:00:00", "2023-01-01T00:00:00"
SINCE = dt.datetime(2024, 1, 10)


def _ids(df):
    return sorted(r.ID for r in df.select("ID").collect())


def _both(landed):
    """IDs kept by the extract from pages and from feed rows (they must agree)."""
    got = _ids(I.extract_landed(landed, SINCE, ASOF))
    assert got == _ids(I.extract_new_reviews(feed_scan(landed), SINCE, ASOF))
    return got


def test_runs_landed_together_do_not_cut_each_other(spark, tmpdir_path):
    first = [_page("kununu", 0, [_rev("a", NEW), _rev("b", OLD)], run="run-1"),
             _page("kununu", 1, [_rev("z", NEW)], run="run-1")]
    second = [_page("kununu", 0, [_rev("c", NEW), _rev("d", NEW)], run="run-2"),
              _page("kununu", 1, [_rev("e", NEW), _rev("f", NEW)], run="run-2")]
    one, two, both = (os.path.join(tmpdir_path, x) for x in ("one", "two", "both"))
    for path, pages in ((one, first), (two, second), (both, first + second)):
        _write_landed(path, pages)
    assert _both(landed_scan(spark, one)) == ["a"]
    assert _both(landed_scan(spark, two)) == ["c", "d", "e", "f"]
    assert _both(landed_scan(spark, both)) == ["a", "c", "d", "e", "f"]


def test_first_copy_is_that_of_the_first_run_and_language(spark, tmpdir_path):
    """The German pages are fetched before the English ones, whatever the page."""
    mine = lambda text: [_rev("q", NEW, pros=text, is_current_job=True)]
    _write_landed(tmpdir_path, [
        _page("glassdoor", 0, mine("late run"), "de", run="run-2"), _page("glassdoor", 0, mine("english"), "en"),
        _page("glassdoor", 1, mine("deutsch"), "de"), _page("glassdoor", 0, mine("other"), "xx")])
    landed = landed_scan(spark, tmpdir_path)
    for out in (I.extract_landed(landed, SINCE, ASOF), I.extract_new_reviews(feed_scan(landed), SINCE, ASOF)):
        assert [r.ReviewText for r in out.collect()] == ["Pros: deutsch"]


def test_pages_without_run_id_are_one_run(spark, tmpdir_path):
    pages = [_page("kununu", 0, [_rev("a", NEW), _rev("b", OLD)]), _page("kununu", 1, [_rev("z", NEW)])]
    for p in pages:
        del p["run_id"]
    _write_landed(tmpdir_path, pages)
    assert _both(landed_scan(spark, tmpdir_path)) == ["a"]


def test_extract_from_pages_reads_them_twice_at_most(spark):
    """Once for the cut pages, once for the rows; no feed row is shuffled before the dedupe."""
    plan = I.extract_landed(feed_pages(spark, SF001), SINCE, ASOF)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation [") <= 2 and "Window" not in plan


def test_fixture_pages_roundtrip(spark):
    pages = feed_pages(spark, SF001)
    feed = feed_scan(pages)
    assert feed.count() == 200
