"""Column expressions for text fields (all JVM-side, whole-stage codegen).

Each function takes and returns ``Column`` so it can be used in any
``select``/``filter``; none of them sees more than one row.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

NL = "\n"

# The English labels the ingest adds and language detection
# must ignore, and the timestamp format of the feed service.
INDEED_LABELS = ["Pros: ", "Cons: "]
# A rating label's word stops at Python's whitespace (``str.isspace``, the
# reference's ``\s``): Java's Unicode mode ``\S`` (not White_Space) minus
# U+001C..U+001F, which Python also counts as space.  An explicit class of
# the same characters is ten times slower on the JVM.
KUNUNU_RATING_LABEL = r"(?U)([\S&&[^\x1C-\x1F]]+) rating: [1-5]/5 "
FEED_TS_FORMAT = "yyyy-MM-dd'T'HH:mm:ss"
FEED_TS_SHAPE = r"^[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}T[0-9]{1,2}:[0-9]{1,2}:[0-9]{1,2}$"


def blank_or_null(c: Column) -> Column:
    """``(c = '' OR c IS NULL)`` -- never NULL itself."""
    return (c == "") | c.isNull()


def nonblank(c: Column) -> Column:
    return ~blank_or_null(c)


def blank_to_null(c: Column) -> Column:
    return F.nullif(c, F.lit(""))


def strip_labels(portal: Column, text: Column) -> Column:
    """Remove the labels added at ingest before language detection.

    Indeed: every ``Pros: `` and ``Cons: `` goes.  kununu: each
    ``<word> rating: k/5 `` goes (only the last word before "rating"),
    newline runs collapse to one and a lone newline becomes ``''``.
    """
    p = F.lower(portal)
    indeed = text
    for label in INDEED_LABELS:
        indeed = F.replace(indeed, F.lit(label), F.lit(""))
    kununu = F.regexp_replace(F.regexp_replace(text, KUNUNU_RATING_LABEL, ""), "\n{2,}", "\n")
    kununu = F.when(kununu == NL, F.lit("")).otherwise(kununu)
    return F.when(p == "indeed", indeed).when(p == "kununu", kununu).otherwise(text)


def first_word(c: Column) -> Column:
    return F.split_part(c, F.lit(" "), F.lit(1))


def current_former_from_flag(flag: Column) -> Column:
    """JSON boolean -> Current / Former (NULL counts as false)."""
    return F.when(flag, F.lit("Current")).otherwise(F.lit("Former"))


def current_former_from_title(title: Column) -> Column:
    return F.when(title.contains("Ex-"), F.lit("Former")).otherwise(F.lit("Current"))


def _labelled(label: str, c: Column) -> Column:
    return F.when(nonblank(c), F.concat(F.lit(label), c))


def compose_indeed_text(pros: Column, cons: Column, body: Column) -> Column:
    """``Pros: p`` / ``Cons: c`` / body joined by a blank line; blank pros/cons
    are skipped, a present-but-empty body is kept (trailing blank line), a
    missing body is skipped."""
    return F.concat_ws(NL + NL, _labelled("Pros: ", pros), _labelled("Cons: ", cons), body)


def compose_glassdoor_text(pros: Column, cons: Column) -> Column:
    """``Pros: p`` + blank line + ``Cons: c``; NULL when both are blank."""
    p, c = _labelled("Pros: ", pros), _labelled("Cons: ", cons)
    return F.when(p.isNull() & c.isNull(), F.lit(None).cast("string")) \
        .otherwise(F.concat_ws(NL + NL, p, c))


def rating_labels(review_json: Column, body: Column) -> Column:
    """Star ratings of a kununu review as text, in document key order.

    For every key containing ``_rating``: newline, key with ``_`` -> space,
    ``": "``, the rating, ``"/5 "`` and the rating text if not blank.  The
    result starts with one extra newline; when the body is blank the first two
    characters are dropped.
    """
    entries = F.map_entries(F.from_json(review_json, "map<string,string>",
                                        {"allowSingleQuotes": "false"}))
    rated = F.filter(entries, lambda e: e["key"].contains("_rating"))
    parts = F.transform(rated, lambda e: F.concat(
        F.lit(NL), F.replace(e["key"], F.lit("_"), F.lit(" ")), F.lit(": "),
        F.coalesce(F.get_json_object(e["value"], "$.rating"), F.lit("None")), F.lit("/5 "),
        F.coalesce(F.get_json_object(e["value"], "$.text"), F.lit(""))))
    scores = F.concat(F.lit(NL), F.coalesce(F.array_join(parts, ""), F.lit("")))
    return F.when(blank_or_null(body), F.substring(scores, 3, 1 << 30)).otherwise(scores)


def compose_kununu_text(review_json: Column, body: Column) -> Column:
    """Body (blank when missing) followed by its rating labels."""
    return F.concat(F.coalesce(body, F.lit("")), rating_labels(review_json, body))


def parse_feed_ts(c: Column) -> Column:
    """Feed timestamp: drop everything from the first ``.``, then accept only
    the shape ``yyyy-MM-ddTHH:mm:ss`` (1-2 digit fields, as ``strptime``) and
    convert it as wall-clock time (``TIMESTAMP_NTZ``, no time zone involved);
    malformed or impossible values -> NULL."""
    head = F.split_part(c, F.lit("."), F.lit(1))
    return F.when(head.rlike(FEED_TS_SHAPE), head.try_cast("timestamp_ntz"))


def unescape_newline(c: Column) -> Column:
    """The two characters backslash + n become a newline."""
    return F.replace(c, F.lit("\\n"), F.lit(NL))


def try_double(c: Column) -> Column:
    """Numeric cast that yields NULL instead of failing (ANSI mode is on)."""
    return c.try_cast("double")


def try_int(c: Column) -> Column:
    return c.try_cast("int")


def ts_literal(value) -> Column:
    """A wall-clock timestamp literal (``TIMESTAMP_NTZ``) built from its ISO
    text, so it does not depend on the Python or session time zone."""
    import datetime as _dt

    if isinstance(value, _dt.date) and not isinstance(value, _dt.datetime):
        value = _dt.datetime.combine(value, _dt.time())
    return F.lit(value.isoformat(sep=" ", timespec="seconds")).cast("timestamp_ntz")
