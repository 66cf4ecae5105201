"""Secret scans: keyword prefilter, anchored expressions near hits, embedded checksums.

1. One Aho-Corasick pass over the ASCII-lowered text finds every keyword (``password``,
   ``akia``, ``ghp_`` and so on).  A hex run has no keyword: every run long enough to
   count covers a multiple of its least length, so those places are probed instead.
2. Only at such hits an expression is matched, anchored at the hit.  An expression can
   start nowhere else, and a hit inside the last match of its kind is passed over, so the
   matches are the leftmost non-overlapping ones of a full scan.
3. Kinds that embed a check value are kept only if it is right: ``github`` and ``npm`` tokens
   end in six base-62 digits, the CRC-32 of the thirty characters before them.  ``jwt`` must
   hold a base-64 JSON header that names an algorithm.

Kinds, in this order: the base kinds ``assign`` (whole assignment; the value has six or more
characters), ``access`` (20 or more characters), ``hex`` (24 or more), then the added kinds
``github``, ``npm``, ``jwt``.  A match that fails its test is dropped and not retried.  Spans
are code points, end exclusive.

The scan is one pass over each row, without any shuffle.

Defined results: null text is empty and has no spans; equal rows get equal results; an
empty table gives no rows; text of any length is scanned whole.
"""

from __future__ import annotations

import base64
import binascii
import json
import re
from functools import lru_cache

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewops.llm import common as c

KINDS = ["assign", "access", "hex", "github", "npm", "jwt"]
BASE = 3
HEX_LEAST = 24
# The patterns of the base kinds and of public token formats.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
GITHUB = re.compile(r"(gh[pousr]_[0-9A-Za-z]{30})([0-9A-Za-z]{6})(?![0-9A-Za-z])")
NPM = re.compile(r"(npm_[0-9A-Za-z]{30})([0-9A-Za-z]{6})(?![0-9A-Za-z])")
JWT = re.compile(r"(eyJ[A-Za-z0-9_-]+)\.eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+")
BASE62 = "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"
KEYWORDS = {"password": 0, "passwd": 0, "secret": 0, "token": 0, "apikey": 0, "api_key": 0, "akia": 1, "ghp_": 3, "gho_": 3,
            "ghu_": 3, "ghs_": 3, "ghr_": 3, "npm_": 4, "eyj": 5}


def _checked(m: re.Match) -> bool:
    """The last six characters are the base-62 CRC-32 of the thirty before them."""
    value = 0
    for x in m[2]:
        value = value * 62 + BASE62.index(x)
    return value == binascii.crc32(m[1][4:].encode())


def _jwt(m: re.Match) -> bool:
    try:
        return "alg" in json.loads(base64.urlsafe_b64decode(m[1] + "=" * (-len(m[1]) % 4)))
    except (ValueError, TypeError):
        return False


RULES = [(ASSIGN, lambda m: len(m[2]) >= 6), (ACCESS, lambda m: len(m[0]) >= 20), (HEX, lambda m: len(m[0]) >= HEX_LEAST),
         (GITHUB, _checked), (NPM, _checked), (JWT, _jwt)]
_IS_HEX = np.zeros(256, dtype=bool)
_IS_HEX[[ord(x) for x in "0123456789abcdef"]] = True


@lru_cache(maxsize=1)
def _automaton():
    found = ahocorasick.Automaton()
    for word, kind in KEYWORDS.items():
        found.add_word(word, (len(word), kind))
    found.make_automaton()
    return found


def scan(text: str) -> list[tuple[int, int, int]]:
    """``(start, kind, end)`` of every span, in order."""
    plain = text.encode("latin-1", "replace")  # one byte for each code point
    low = plain.lower()
    hits = [[] for _ in KINDS]
    for end, (size, kind) in _automaton().iter(low.decode("latin-1")):
        hits[kind].append(end + 1 - size)
    probe = np.flatnonzero(_IS_HEX[np.frombuffer(plain, dtype=np.uint8)[::HEX_LEAST]]) * HEX_LEAST
    spans = []
    for kind, (pattern, holds) in enumerate(RULES):
        after = 0
        if kind == 2:
            for at in probe.tolist():
                if at < after:
                    continue
                start = at
                while start > after and text[start - 1] in "0123456789abcdef":
                    start -= 1
                m = pattern.match(text, start)
                after = m.end()
                if holds(m):
                    spans.append((start, kind, after))
            continue
        for start in sorted(set(hits[kind])):
            if start >= after and (m := pattern.match(text, start)):
                after = m.end()
                if holds(m):
                    spans.append((start, kind, after))
    return sorted(spans)


def _scan(batches):
    shape = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))
    for batch in c.groups(batches):
        spans = [[{"kind": KINDS[k], "start": s, "end": e} for s, k, e in scan(x or "")]
                 for x in batch.column("_text").to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column("_id"), pa.array(spans, shape)], names=["_id", "found"])


def find_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: id and ``found``, an array of (kind, start, end) by start,
    then kind."""
    rows = c.keyed(docs, id_col, text_col).select("_id", "_text")
    kind = rows.schema["_id"].dataType.simpleString()
    return (rows.mapInArrow(_scan, f"_id {kind}, found array<struct<kind:string,start:int,end:int>>")
            .withColumnRenamed("_id", id_col))


def joined(spans) -> F.Column:
    """``kind:start:end`` of every span, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def count_of(spans, kind: str) -> F.Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")


def op5_secrets(spark, sf_dir: str) -> DataFrame:
    """Secrets in every whole text of ``documents``."""
    found = F.col("found")
    base = F.filter(found, lambda s: s["kind"].isin(KINDS[:BASE]))
    return find_secrets(spark.read.parquet(f"{sf_dir}/documents.parquet")).select(
        "doc_id", *[count_of(found, k).alias(f"n_{k}") for k in KINDS[:BASE]],
        F.sha2(joined(base), 256).alias("base_sha256"), joined(found).alias("spans"),
        *[count_of(found, k).alias(f"n_{k}") for k in KINDS[BASE:]])
