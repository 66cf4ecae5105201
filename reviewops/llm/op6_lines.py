"""Line dedup by content-defined chunks of lines, in DataFrame functions only.

Lines end at ``\\n``.  Two neighbouring lines that stand together at only one place in all texts can
lie in no repeated chunk, so every text is cut between them; what is left in one piece, a run, holds
repeated pairs only.  Each line has a 28-bit hash (from its MD5); a rolling hash weighs the hashes of
a line and the one before, and inside a run a chunk ends after every line where it is zero modulo
``divisor``, or, where lines alternate or one is repeated (the hashes before and after are equal), after
every second line.  A boundary right after another, after the first or before the last line of a run does not
count, so chunks of a run have two lines at least.  A boundary depends on a few lines around it and
on how often their pairs occur, so lines put in or taken out elsewhere do not move it.

A chunk of two or more lines that occurs at more than one place is kept at its first place
(smallest id, nulls last, then smallest position) and removed at all others.  What is removed is
decided by the chunk's bytes: chunks are grouped by their text itself.

Cost: hashes of pairs are counted with partial aggregation; the text crosses the network once by row
key (both later steps read that shuffle), and chunks of runs once more.  A pair that holds a third of
all rows is one row for each task in the counts, and a join key that adaptive execution splits.

Defined results: null text is empty, keeps no text (``kept_text`` empty) and has one empty line;
single lines that repeat in no company are kept; of rows equal in id and text one counts as the first, the
others lose their repeated chunks, which is all of a text of several lines; an empty table gives no rows;
any text length is worked on whole.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reviewops.llm import common as c

# Weights of the line before and of the line in the rolling hash; lines between its zeroes, on average.
WEIGHTS, DIVISOR = (31, 1), 3


def _line_hash(line: Column) -> Column:
    return F.conv(F.substring(F.md5(line), 1, 7), 16, 10).cast("long")


def _with_chunks(text: DataFrame, divisor: int) -> DataFrame:
    """Adds ``lines`` and ``ends``, the number of lines up to each boundary, from ``pairs``: for each
    line but the last, whether it stands together with the next one elsewhere too."""
    text = text.withColumn("lines", F.split("_text", "\n"))
    text = text.withColumn("hashes", F.transform("lines", _line_hash))

    def pair(i):  # lines i and i + 1, from 1
        return F.coalesce(F.get("pairs", i - 1), F.lit(False))

    def zero(i):
        rolled = WEIGHTS[0] * F.get("hashes", i - 2) + WEIGHTS[1] * F.get("hashes", i - 1)
        return F.when(F.get("hashes", i - 2) == F.get("hashes", i), i % 2 == 0).otherwise(rolled % divisor == 0)

    return text.withColumn("ends", F.filter(F.sequence(F.lit(1), F.size("lines")), lambda i: ~pair(i) | (
        pair(i - 1) & pair(i + 1) & zero(i) & ~(pair(i - 2) & zero(i - 1)))))


def _chunk(pos: Column) -> Column:
    """The lines of chunk ``pos`` (from 0)."""
    start = F.when(pos == 0, 0).otherwise(F.get("ends", pos - 1))
    return F.slice("lines", start + 1, F.get("ends", pos) - start)


def line_dedup(docs: DataFrame, divisor: int = DIVISOR, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: ``_id``, ``_row`` (its other columns), ``_none`` (text is null), ``n_lines``, ``n_removed`` (lines)
    and ``kept_text`` (kept lines joined by ``\\n``)."""
    text = c.keyed(docs, id_col, text_col, carry=True)
    # A text without a line end has no pair.
    lines = text.filter(F.col("_text").contains("\n")).select("_k", "_j", F.split("_text", "\n").alias("lines"))
    hashed = lines.select("_k", "_j", F.posexplode(F.transform(F.sequence(F.lit(1), F.size("lines") - 1), lambda i: F.xxhash64(
        F.get("lines", i - 1), F.get("lines", i)))).alias("pos", "h"))
    # Aggregates are staged before they are joined, so that AQE can split a hot key of the join.
    again = c.stage(hashed.groupBy("h").count().filter("count > 1").select("h", F.lit(True).alias("twice")), "again")
    pairs = hashed.join(again, "h", "left").groupBy("_k", "_j").agg(
        F.collect_set(F.struct("pos", F.coalesce("twice", F.lit(False)).alias("twice"))).alias("p")).filter(F.exists("p", lambda x: x["twice"]))
    pairs = c.stage(pairs.select("_k", "_j", F.array_sort("p")["twice"].alias("pairs")), "pairs")

    # Same columns of the text as in the last join, so that both read one shuffle of it.  The hints keep
    # the plan of large tables at every size; a hot key is still split.
    found = _with_chunks(text.join(pairs.hint("merge"), ["_k", "_j"]).select("_k", "_j", "_id", "_text", "_row", "_none", "pairs"), divisor)
    many = F.filter(F.sequence(F.lit(0), F.size("ends") - 1), lambda p: F.size(_chunk(p)) > 1)
    found = found.select("_k", "_j", "_id", F.explode(F.transform(many, lambda p: F.struct(
        p.alias("pos"), F.array_join(_chunk(p), "\n").alias("chunk")))).alias("e")).select("_k", "_j", "_id", "e.*")
    found = c.stage(found.select("chunk", F.struct(F.col("_id").isNull().alias("none"), F.col("_id").alias("id"), F.col("_k").alias("k"),
                                                   F.col("_j").alias("j"), "pos").alias("place")), "chunks")
    first = c.stage(found.groupBy("chunk").agg(F.min("place").alias("first")), "first")
    gone = (found.join(first, "chunk").filter(~F.col("place").eqNullSafe(F.col("first")))
            .groupBy(F.col("place.k").alias("_k"), F.col("place.j").alias("_j")).agg(F.collect_set("place.pos").alias("gone")))

    out = _with_chunks(text.join(pairs.join(gone, ["_k", "_j"]).hint("merge"), ["_k", "_j"], "left"), divisor)
    keep = F.array_except(F.sequence(F.lit(0), F.size("ends") - 1), "gone")
    kept = F.flatten(F.transform(keep, _chunk))
    out = out.select("_k", "_j", "_id", "_row", "_none", F.size("lines").cast("long").alias("n_lines"), F.when(
        F.col("gone").isNull(), F.col("lines")).otherwise(kept).alias("kept"))
    out = out.select("_k", "_j", "_id", "_row", "_none", "n_lines", (F.col("n_lines") - F.size("kept")).alias("n_removed"),
                     F.array_join("kept", "\n").alias("kept_text"))
    return _one_of_equal_rows(text, out).drop("_k", "_j")


def _one_of_equal_rows(text: DataFrame, out: DataFrame) -> DataFrame:
    """Of rows equal in id and text all but one lose every line, if there are several: each of their pairs
    stands elsewhere too, so the text is one run."""
    equal = c.stage(text.groupBy("_k", "_j").count().filter("count > 1").select("_k", "_j"), "equal")
    if equal.isEmpty():
        return out
    rows = c.stage(out.join(equal, ["_k", "_j"], "left_semi").withColumn("_n", F.monotonically_increasing_id()), "equal-rows")
    first = c.stage(rows.groupBy("_k", "_j").agg(F.min("_n").alias("_first")), "equal-first")
    other = (F.col("_n") != F.col("_first")) & (F.col("n_lines") > 1)
    rows = rows.join(first, ["_k", "_j"]).withColumns({
        "n_removed": F.when(other, F.col("n_lines")).otherwise(F.col("n_removed")), "kept_text": F.when(other, "").otherwise(F.col("kept_text"))})
    return out.join(equal, ["_k", "_j"], "left_anti").unionByName(rows.drop("_n", "_first"))


def dedup_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with the kept lines as text (null stays null); ``n_chars``, where there is one, follows a changed text."""
    out = line_dedup(docs, id_col=id_col, text_col=text_col)
    columns = []
    for x in docs.columns:
        old = F.col("_row").getField(x) if x != text_col else F.when(~F.col("_none"), F.col("kept_text"))
        if x == "n_chars":
            old = F.when(F.col("n_removed") > 0, F.char_length("kept_text").cast(docs.schema[x].dataType)).otherwise(old)
        columns.append(old.alias(x))
    return out.select(*columns)


def op6_line_dedup(spark, sf_dir: str) -> DataFrame:
    """Chunks of lines over every whole text of ``documents``."""
    out = line_dedup(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return out.select(F.col("_id").alias("doc_id"), "n_lines", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


OP6_SQL = f"""
WITH d AS (SELECT doc_id, row_number() OVER () AS r, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
l AS (SELECT doc_id, r, unnest(lines) AS line, unnest(range(1, len(lines) + 1)) AS i FROM d),
t AS (SELECT *, CAST(('0x' || substr(md5(line), 1, 7)) AS BIGINT) AS h,
      lead(line) OVER w AS next FROM l WINDOW w AS (PARTITION BY r ORDER BY i)),
g AS (SELECT *, next IS NOT NULL AND count(*) OVER (PARTITION BY line, next) > 1 AS pair FROM t),
z AS (SELECT *, CASE WHEN lag(h) OVER w = lead(h) OVER w THEN i % 2 = 0
      ELSE coalesce(({WEIGHTS[0]} * lag(h) OVER w + {WEIGHTS[1]} * h) % {DIVISOR} = 0, false) END AS zero,
      coalesce(lag(pair) OVER w, false) AS p1, coalesce(lag(pair, 2) OVER w, false) AS p2, coalesce(lead(pair) OVER w, false) AS n1
      FROM g WINDOW w AS (PARTITION BY r ORDER BY i)),
e AS (SELECT *, NOT pair OR (p1 AND n1 AND zero AND NOT (p2 AND coalesce(lag(zero) OVER w, false))) AS ending
      FROM z WINDOW w AS (PARTITION BY r ORDER BY i)),
n AS (SELECT *, coalesce(sum(ending::INT) OVER (PARTITION BY r ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS pos FROM e),
k AS (SELECT doc_id, r, pos, count(*) AS size, string_agg(line, chr(10) ORDER BY i) AS chunk FROM n GROUP BY doc_id, r, pos),
v AS (SELECT *, size > 1 AND row_number() OVER (PARTITION BY size > 1, chunk ORDER BY doc_id NULLS LAST, r, pos) > 1 AS gone FROM k),
o AS (SELECT doc_id, r, sum(size) AS n_lines, sum(CASE WHEN gone THEN size ELSE 0 END) AS n_removed,
      coalesce(string_agg(CASE WHEN gone THEN NULL ELSE chunk END, chr(10) ORDER BY pos), '') AS kept FROM v GROUP BY doc_id, r)
SELECT doc_id, CAST(n_lines AS BIGINT) AS n_lines, CAST(n_removed AS BIGINT) AS n_removed, sha256(kept) AS kept_sha256 FROM o
"""
