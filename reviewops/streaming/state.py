"""Keyed state of the streaming ingest (``transformWithState``, RocksDB state store).

Two operators, chained: the page at which a run's feed ended (per run, portal and language), and
whether an ID was seen (per ID).  What a micro-batch costs depends on what has landed, not on the
table or on earlier runs.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Row
from pyspark.sql import types as T
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

class FeedCuts(StatefulProcessor):
    """Pages of one feed (``run_id, portal, lang``) up to its cut page.  The state is the least page
    with an old review (one number a feed; it does not expire, since expiry would need processing time, under which
    a run over what is available never ends); portals that stop per page pass."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.cut = handle.getValueState("cut", T.StructType([T.StructField("page", T.LongType())]))

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        pages = sorted(rows, key=lambda r: (r.page is not None, r.page))
        if (key[1] or "").lower() == "glassdoor":
            yield from pages
            return
        known = self.cut.get() if self.cut.exists() else None
        before = cut = known[0] if known else None
        for page in pages:
            if page.cut is not None and page.page is not None and (cut is None or page.page < cut):
                cut = page.page
        if cut != before:
            self.cut.update((cut,))
        for page in pages:
            if cut is None or (page.page is not None and page.page <= cut):
                yield page

    def close(self) -> None:
        pass


class SeenIds(StatefulProcessor):
    """The first row of an ID, in the order of ``_ord``, if the ID was not seen before.  IDs of the table
    at the first start are the initial state."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.seen = handle.getValueState("seen", T.StructType([T.StructField("yes", T.BooleanType())]))

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        if self.seen.exists():
            return
        first = min(rows, key=lambda r: [(x is not None, x) for x in r["_ord"]])
        self.seen.update((True,))
        yield first

    def handleInitialState(self, key, initialState, timerValues) -> None:
        self.seen.update((True,))

    def close(self) -> None:
        pass
