"""Parsing model answers.

An HTTP body carries ``choices[0].message.content``; that content should hold
one flat JSON object somewhere in free text.  The object is cut out as the
text between the first ``{`` and the next ``{`` or ``}``, re-wrapped in braces
and parsed as ``map<string,string>`` (key order kept, last duplicate wins).
Key lookup is case-insensitive and the last matching key wins.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

CHOICE_CONTENT_PATH = "$.choices[0].message.content"


def choice_content(body: Column) -> Column:
    return F.get_json_object(body, CHOICE_CONTENT_PATH)


def answer_object_text(content: Column) -> Column:
    """``{...}`` cut from free text; NULL when there is no ``{``."""
    inner = F.regexp_extract(content, r"\{([^{}]*)", 1)
    return F.when(content.contains("{"), F.concat(F.lit("{"), inner, F.lit("}")))


def answer_object(content: Column) -> Column:
    """Parsed flat object as a map; NULL = unparsable answer."""
    return F.from_json(answer_object_text(content), "map<string,string>",
                       {"allowSingleQuotes": "false"})


def answer_get(obj: Column, key: str) -> Column:
    """Case-insensitive lookup with the semantics of a parsed JSON object fed
    into a case-insensitive dictionary: an exact duplicate key keeps its first
    position and its last value; among keys equal ignoring case, the one
    positioned last wins.  NULL if absent.  (The parsed map keeps exact
    duplicate entries, so both rules are applied here.)"""
    hits = F.filter(F.map_entries(obj), lambda e: F.lower(e["key"]) == key.lower())
    winner = F.try_element_at(F.array_distinct(F.transform(hits, lambda e: e["key"])), F.lit(-1))
    same = F.filter(hits, lambda e: e["key"] == winner)
    return F.try_element_at(same, F.lit(-1))["value"]


def answer_has(obj: Column, key: str) -> Column:
    return F.exists(F.map_keys(obj), lambda k: F.lower(k) == key.lower())
