"""Versioned table, CSV backup round trip, run log, stream = batch."""
import datetime as dt
import os

from pyspark.sql import functions as F

from conftest import SF001, rows
from reviewops.operators import ingest as I
from reviewops.sinks import table as T
from reviewops.sources.feed import LANDED_SCHEMA, feed_scan
from reviewops.sources.fixtures import feed_pages, reviews
from reviewops.streaming.ingest import stream_ingest

ASOF = dt.date(2024, 1, 31)
SINCE = dt.datetime(2024, 1, 10)


def test_versioned_table(spark, tmpdir_path):
    root = os.path.join(tmpdir_path, "table")
    assert T.read_table(spark, root).count() == 0
    r = reviews(spark, SF001)
    assert T.table_replace_sink(r.filter(F.col("Portal") == "Indeed"), root) == 1
    assert T.table_sink(r.filter(F.col("Portal") == "kununu"), root) == 1
    v = T.table_replace_sink(T.read_table(spark, root).filter(F.col("Portal") == "kununu"), root,
                             buckets=4)
    assert v == 2
    assert rows(T.read_table(spark, root), "Portal") == rows(r.filter(F.col("Portal") == "kununu"),
                                                             "Portal")


def test_csv_backup_roundtrip(spark, tmpdir_path):
    src = reviews(spark, SF001)
    edge = spark.createDataFrame(
        [("x-1", ' padded "quoted" \\ back\nslash ', "  "), ("x-2", "a,b", "\n"),
         ("x-3", "", None), ("x-4", None, "")],
        "ID string, ReviewText string, Response string")
    from reviewops.operators.merge import schema_conform
    table = src.unionByName(schema_conform(edge))
    path = T.csv_backup(table, tmpdir_path, dt.datetime(2024, 1, 31, 7, 5))
    assert path.endswith("backup_2024-01-31_07-05")
    back = T.read_csv_backup(spark, path)
    # exact: NULL and '' stay apart, every column and type survives
    assert rows(back) == rows(table)


def test_dupes_report_and_run_log(spark, tmpdir_path):
    r = reviews(spark, SF001)
    rep = T.dupes_report(r.unionByName(r.limit(3)), os.path.join(tmpdir_path, "dupes"), ASOF)
    assert rep.count() == 3
    T.run_log(r.limit(2).select("ID", F.lit("test").alias("reason")),
              os.path.join(tmpdir_path, "log"), "unit", dt.datetime(2024, 1, 31))
    assert spark.read.parquet(os.path.join(tmpdir_path, "log")).count() == 2


def test_stream_equals_batch(spark, tmpdir_path):
    landed = os.path.join(tmpdir_path, "landed")
    feed_pages(spark, SF001).write.json(landed)
    root = os.path.join(tmpdir_path, "table")
    q = stream_ingest(spark, landed, root, SINCE, ASOF,
                      checkpoint=os.path.join(tmpdir_path, "ckpt"))
    q.awaitTermination(300)
    streamed = T.read_table(spark, root)
    batch = I.extract_new_reviews(feed_scan(feed_pages(spark, SF001)), SINCE, ASOF)
    assert rows(streamed, "ID", "ReviewText") == rows(batch, "ID", "ReviewText")
    # replaying the same input (new checkpoint) appends nothing new
    q2 = stream_ingest(spark, landed, root, SINCE, ASOF,
                       checkpoint=os.path.join(tmpdir_path, "ckpt2"))
    q2.awaitTermination(300)
    assert T.read_table(spark, root).count() == batch.count()


def test_stream_over_many_micro_batches_equals_batch(spark, tmpdir_path):
    """A run that arrives in several files ends at its first old review, in
    whatever micro-batch that was seen; other runs go on."""
    import json

    new, old = "2024-01-29T00:00:00", "2023-01-01T00:00:00"
    rev = lambda i, ts: {"id": i, "url": i, "title": i, "datetime": ts, "rating": 4, "text": "t"}
    pages = [("run-1", 0, [rev("a", new), rev("b", old)]), ("run-2", 0, [rev("c", new)]), ("run-1", 1, [rev("z", new)]),
             ("run-2", 1, [rev("d", new), rev("a", new)]), ("run-2", 2, [rev("e", old)]), ("run-2", 3, [rev("y", new)])]
    landed = os.path.join(tmpdir_path, "landed")
    os.makedirs(landed)
    for k, (run, page, reviews_) in enumerate(pages):
        path = os.path.join(landed, f"part-{k}.json")
        with open(path, "w") as f:
            f.write(json.dumps({"run_id": run, "portal": "kununu", "lang": "all", "page": page,
                                "body": json.dumps({"reviews": reviews_})}) + "\n")
        os.utime(path, (1_700_000_000 + k, 1_700_000_000 + k))
    root = os.path.join(tmpdir_path, "table")
    stream_ingest(spark, landed, root, SINCE, ASOF, checkpoint=os.path.join(tmpdir_path, "ckpt"),
                  files_per_batch=1).awaitTermination(300)
    batch = I.extract_landed(spark.read.schema(LANDED_SCHEMA).json(landed), SINCE, ASOF)
    assert rows(T.read_table(spark, root), "ID") == rows(batch, "ID") == [("a",), ("c",), ("d",)]


def test_failed_version_write_does_not_block_retry(spark, tmpdir_path):
    """A replacement that died part-way leaves a version folder without
    ``_SUCCESS``: readers skip it and the retry writes past it."""
    root = os.path.join(tmpdir_path, "table")
    r = reviews(spark, SF001)
    assert T.table_replace_sink(r.filter(F.col("Portal") == "Indeed"), root) == 1
    # a crashed job: data files in place, no commit marker
    import pyarrow as pa
    import pyarrow.parquet as pq
    broken = T.version_path(root, 2)
    os.makedirs(broken)
    pq.write_table(pa.table({"ID": ["x-1"], "Portal": ["Indeed"]}),
                   os.path.join(broken, "part-00000.parquet"))
    assert T.current_version(spark, root) == 1
    assert T.read_table(spark, root).count() == r.filter(F.col("Portal") == "Indeed").count()
    assert T.table_replace_sink(r.filter(F.col("Portal") == "kununu"), root) == 3
    assert rows(T.read_table(spark, root), "ID") == rows(r.filter(F.col("Portal") == "kununu"), "ID")


def _land(folder, pages, start=0):
    """One file per landed page, in order of modification time."""
    import json

    os.makedirs(folder, exist_ok=True)
    for k, (run, page, reviews_) in enumerate(pages, start):
        path = os.path.join(folder, f"part-{k}.json")
        with open(path, "w") as f:
            f.write(json.dumps({"run_id": run, "portal": "kununu", "lang": "all", "page": page,
                                "body": json.dumps({"reviews": reviews_})}) + "\n")
        os.utime(path, (1_700_000_000 + k, 1_700_000_000 + k))


def _review(i, ts="2024-01-29T00:00:00"):
    return {"id": i, "url": i, "title": i, "datetime": ts, "rating": 4, "text": "t"}


def test_micro_batches_read_no_table_and_restarts_go_on(spark, tmpdir_path, monkeypatch):
    """IDs of the table, of earlier micro-batches and of earlier starts are known from the state alone."""
    from reviewops.operators.merge import schema_conform
    from reviewops.streaming import ingest as SI

    landed, root, ckpt = (os.path.join(tmpdir_path, x) for x in ("landed", "table", "ckpt"))
    T.table_replace_sink(schema_conform(spark.createDataFrame([("old",)], "ID string")), root)

    def no_scan(*a, **k):
        raise AssertionError("a micro-batch compared IDs with the table")

    def go():
        stream_ingest(spark, landed, root, SINCE, ASOF, checkpoint=ckpt, files_per_batch=1).awaitTermination(300)
        return sorted(r.ID for r in T.read_table(spark, root).collect())

    with monkeypatch.context() as m:
        m.setattr(SI, "new_keys", no_scan)
        _land(landed, [("r1", 0, [_review("a"), _review("old")]), ("r1", 1, [_review("a"), _review("b")])])
        assert go() == ["a", "b", "old"]
        _land(landed, [("r2", 0, [_review("b"), _review("c"), _review("x", "2023-01-01T00:00:00")]), ("r2", 1, [_review("y")])], 2)
        assert go() == ["a", "b", "c", "old"]
    # another writer: from now on rows are compared with the table too
    T.table_sink(schema_conform(spark.createDataFrame([("d",)], "ID string")), root)
    _land(landed, [("r3", 0, [_review("d"), _review("e")]), ("r2", 2, [_review("z")])], 4)
    assert go() == ["a", "b", "c", "d", "e", "old"]


def test_replayed_micro_batch_appends_nothing_twice(spark, tmpdir_path):
    """A failure between the table commit and the checkpoint commit: the commit file is missing, so the
    micro-batch runs again on the state before it."""
    from reviewops.streaming import ingest as SI

    landed, root, ckpt = (os.path.join(tmpdir_path, x) for x in ("landed", "table", "ckpt"))
    _land(landed, [("r1", 0, [_review("a")]), ("r1", 1, [_review("b")])])
    stream_ingest(spark, landed, root, SINCE, ASOF, checkpoint=ckpt, files_per_batch=1).awaitTermination(300)
    last = max(int(x) for x in os.listdir(os.path.join(ckpt, "commits")) if x.isdigit())
    os.unlink(os.path.join(ckpt, "commits", str(last)))
    crc = os.path.join(ckpt, "commits", f".{last}.crc")
    if os.path.exists(crc):
        os.unlink(crc)
    SI._note(spark, ckpt + "-table", "1 1 1")  # and the note was not written either
    stream_ingest(spark, landed, root, SINCE, ASOF, checkpoint=ckpt, files_per_batch=1).awaitTermination(300)
    assert sorted(r.ID for r in T.read_table(spark, root).collect()) == ["a", "b"]
