"""Streaming ingest: landed feed pages -> new reviews appended to the table.

``readStream`` picks up new landed files (JSON lines, ``LANDED_SCHEMA``).  Pages are parsed once and
windowed row by row like the batch extract; two stateful operators (``state.py``) then cut each run's
feed at its first old review and pass the first row of every ID that was not seen before.  So any split
of a run into files gives the batch result, as long as the fetcher lands a run's pages in the order
in which it reads them; late reviews are accepted, and a micro-batch reads neither the table nor
what earlier ones left.

IDs of the table at the first start are the initial state.  Whether anything but this stream has written
the table since is told from its version and its data files (a listing, noted next to the checkpoint
after every micro-batch).  If so -- another writer, or a micro-batch replayed after a failure between the
table commit and the checkpoint commit -- rows are also compared with the table's IDs until the
stream stops, so nothing is appended twice; starting with a new checkpoint takes the table over again.
The stream checkpoint lives under the shared ``spark.checkpoint.dir``.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from ..operators.ingest import FEED_KEYS, in_feed_order, page_rows, page_window
from ..operators.merge import new_keys
from ..session import scratch_path
from ..sinks.table import _fs, current_version, read_table, table_sink
from ..sources.feed import LANDED_SCHEMA
from .state import PROVIDER, FeedCuts, SeenIds

_PROVIDER_CONF = "spark.sql.streaming.stateStore.providerClass"


def _files(spark: SparkSession, root: str) -> str:
    """Version and number of files and bytes of the table (patches included), from a listing."""
    v = current_version(spark, root)
    if v is None:
        return "none"
    fs, p, _ = _fs(spark, root)
    s = fs.getContentSummary(p)
    return f"{v} {s.getFileCount()} {s.getLength()}"


def _note(spark: SparkSession, path: str, text: str | None = None) -> str | None:
    """Write a one-line file, or read it (None where there is none)."""
    fs, p, jvm = _fs(spark, path)
    if text is not None:
        out = fs.create(p, True)
        out.write(bytearray(text.encode()))
        out.close()
        return text
    if not fs.exists(p):
        return None
    reader = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(fs.open(p)))
    try:
        return reader.readLine()
    finally:
        reader.close()


def new_reviews(src: DataFrame, since: _dt.datetime, asof: _dt.date, known: DataFrame | None = None) -> DataFrame:
    """Streaming landed pages to table rows, each ID once; ``known`` are the IDs seen before the first start."""
    pages = page_window(src, since, asof)
    kept = pages.groupBy(*FEED_KEYS).transformWithState(FeedCuts(), pages.schema, "append", "none")
    rows = in_feed_order(page_rows(kept), asof)
    fresh = rows.filter("ID IS NOT NULL").groupBy("ID").transformWithState(
        SeenIds(), rows.schema, "append", "none", None if known is None else known.select("ID").distinct().groupBy("ID"))
    return fresh.drop("_ord")


def stream_ingest(spark: SparkSession, landed_dir: str, table_root: str, since: _dt.datetime,
                  asof: _dt.date, checkpoint: str | None = None,
                  available_now: bool = True, files_per_batch: int | None = None) -> StreamingQuery:
    """``files_per_batch`` bounds the landed files of one micro-batch (default: all that are new)."""
    if not spark.conf.get(_PROVIDER_CONF, "").endswith("RocksDBStateStoreProvider"):
        spark.conf.set(_PROVIDER_CONF, PROVIDER)  # transformWithState needs it
    src = spark.readStream.schema(LANDED_SCHEMA)
    if files_per_batch:
        src = src.option("maxFilesPerTrigger", files_per_batch)
    src = src.json(landed_dir)
    checkpoint = checkpoint or scratch_path(spark, "streams", "ingest")
    note = checkpoint.rstrip("/") + "-table"
    left = _note(spark, note)
    if left is None:
        left = _note(spark, note, _files(spark, table_root))
    foreign = False

    def batch(rows: DataFrame, epoch_id: int) -> None:
        nonlocal left, foreign
        session = rows.sparkSession
        foreign = foreign or _files(session, table_root) != left
        if foreign:
            rows = new_keys(rows, read_table(session, table_root).select("ID"))
        table_sink(rows, table_root)
        left = _note(session, note, _files(session, table_root))

    known = read_table(spark, table_root) if current_version(spark, table_root) is not None else None
    w = new_reviews(src, since, asof, known).writeStream.outputMode("append").foreachBatch(batch).option(
        "checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    return w.start()
