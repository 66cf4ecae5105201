"""Page refresh: apply fetch results to the refresh work-list.

Fetch results are a ledger ``(ID, attempt, status, html)``; up to 10 attempts
per review, the first terminal one (2xx or 404) counts -- a minimum over the
attempts of the work-list's reviews, a partial aggregation.  Per review:

* 404                 -> OnlineYesNo ``No``, RefreshDate = asof
* 2xx                 -> OnlineYesNo ``Yes``, RefreshDate = asof, and from the page:
  reply found -> posted ``Yes``, Response = reply text, status ``Approved``;
  reply missing -> posted ``No``; review block missing (portals 1, 2) -> a
  parse error: posted flag and reply untouched
* anything else       -> row untouched

Page lookups ("reply element inside the review block") need balanced nested
tags, which regular expressions cannot pair; they use the small stdlib parser
in ``functions.htmlparse`` as an Arrow-batched ``pandas_udf``, applied after
the join so only the fetched pages of the work-list are parsed.
"""

from __future__ import annotations

import datetime as _dt
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import schema as S
from ..functions import htmlparse as HP
from ..functions.html import Selector, css


@dataclass(frozen=True)
class PortalPage:
    """Where the reply sits on a portal's review page.  ``review``: block that
    must exist (None = search the whole page); ``reply``: the reply element;
    ``reply_text``: element inside the reply whose text is taken (None = the
    reply itself)."""
    review: Selector | None
    reply: Selector
    reply_text: Selector | None = None


# Page structure of the three portals (CSS classes / attributes).
PORTAL_PAGES = {
    "indeed": PortalPage(review=css("css-14nhnfd e37uo190"), reply=css("css-j3kgaw e1wnkr790")),
    "glassdoor": PortalPage(review=css("review-details_reviewDetails__wSGbU"),
                            reply=Selector(tag="span", attr="data-test",
                                           value="review-text-undefined")),
    "kununu": PortalPage(review=None, reply=css("index__responseBlock__A5fqZ"),
                         reply_text=css("p-small-regular")),
}


def first_terminal_attempt(fetches: DataFrame, attempts: int = S.REFRESH_ATTEMPTS) -> DataFrame:
    """``ID, status, html`` of the first attempt that returned 2xx or 404; picked on
    numbers and a hash of the page, the page itself is joined last."""
    terminal = F.col("status").between(200, 299) | (F.col("status") == 404)
    f = fetches.filter(F.col("attempt") <= attempts).withColumn(
        "_h", F.coalesce(F.xxhash64("html"), F.lit(0)))
    picked = (f.groupBy("ID")
              .agg(F.min(F.when(terminal, F.struct("attempt", "status", "_h"))).alias("_t"),
                   F.max(F.struct("attempt", "status")).alias("_last"))
              .select("ID", F.coalesce(F.col("_t.status"), F.col("_last.status")).alias("_status"),
                      F.col("_t.attempt").alias("attempt"), F.col("_t._h").alias("_h")))
    pages = f.filter(terminal).select("ID", "attempt", "_h", "html").dropDuplicates(["ID", "attempt", "_h"])
    return picked.join(pages, ["ID", "attempt", "_h"], "left").select("ID", "_status", F.col("html").alias("_html"))


def page_parser(pages: dict[str, PortalPage]):
    """Arrow-batched parser: per row ``(review block found, reply found, reply
    text)`` for the row's portal; NULLs for unknown portals or no page.  A
    reply without its inner text element yields NULL text: the posted flag is
    set but the reply is not taken (a parse error after that step)."""
    spec = {name: (HP.selector_spec(pg.review), HP.selector_spec(pg.reply),
                   HP.selector_spec(pg.reply_text))
            for name, pg in pages.items()}

    @F.pandas_udf("parse_ok boolean, found boolean, text string")
    def parse_pages(portal: pd.Series, html: pd.Series) -> pd.DataFrame:
        ok, found, txt = [], [], []
        for p, h in zip(portal, html):
            s = spec.get(str(p).lower()) if (p is not None and h is not None) else None
            if s is None:
                ok.append(None), found.append(None), txt.append(None)
                continue
            root = HP.parse(h)
            scope = HP.find(root, *s[0]) if s[0] else root
            if scope is None:
                ok.append(False), found.append(None), txt.append(None)
                continue
            reply = HP.find(scope, *s[1])
            inner = reply if (reply is None or s[2] is None) else HP.find(reply, *s[2])
            ok.append(True), found.append(reply is not None)
            txt.append(HP.text(inner) if inner is not None else None)
        return pd.DataFrame({"parse_ok": ok, "found": found, "text": txt})

    return parse_pages


def apply_refresh(rows: DataFrame, fetches: DataFrame, asof: _dt.date,
                  pages: dict[str, PortalPage] = PORTAL_PAGES) -> DataFrame:
    # the ledger holds all fetches: only those of the work-list go further
    wanted = fetches.join(rows.select("ID"), "ID", "left_semi")
    j = rows.join(first_terminal_attempt(wanted), "ID", "left")
    status, html = F.col("_status"), F.col("_html")
    ok2xx = status.between(200, 299)
    gone = status == 404
    # exact nested-HTML lookup, run only on the fetched rows of the work-list
    parsed = page_parser(pages)(F.col("Portal"), html)
    parse_ok, found, text = parsed["parse_ok"], parsed["found"], parsed["text"]
    seen = ok2xx & F.coalesce(parse_ok, F.lit(False))
    posted = seen & F.coalesce(found, F.lit(False))
    with_text = posted & text.isNotNull()
    new = {
        "OnlineYesNo": F.when(gone, F.lit("No")).when(ok2xx, F.lit("Yes")).otherwise(F.col("OnlineYesNo")),
        "RefreshDate": F.when(gone | ok2xx, F.lit(asof)).otherwise(F.col("RefreshDate")),
        "ResponsePostedYesNo": F.when(posted, F.lit("Yes")).when(seen, F.lit("No"))
                                .otherwise(F.col("ResponsePostedYesNo")),
        "Response": F.when(with_text, text).otherwise(F.col("Response")),
        "ApprovalStatus": F.when(with_text, F.lit("Approved")).otherwise(F.col("ApprovalStatus")),
    }
    return j.select(*[new[c].alias(c) if c in new else F.col(c) for c in rows.columns])
