"""What the training-data operators share.

Row identity.  A document row is known by ``(_k, _j)``: a 64-bit and a 32-bit hash
of its id and text.  Rows that agree in id *and* text are therefore one document
(they get the same result); a null id or a null text is an ordinary value.  Only the
named id and text columns are read, so other columns may bear any name.

Words.  ``bytes.split()`` cuts UTF-8 at 0x20 and 0x09-0x0D, which is the word rule
``[^\\x20\\x09-\\x0D]+`` (no byte of a longer UTF-8 sequence lies in those ranges).
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from reviewops.session import scratch_path

# A text is taken apart in pieces of about this many bytes, cut at white space, so a
# very long text never stands in memory as one list of words.
PIECE = 1 << 20
# Rows handed to Python are worked on in groups of at most this many bytes of text.
GROUP_BYTES = 8 << 20

_U = np.uint64
_MULT = _U(0x9E3779B97F4A7C15)
_INV = _U(pow(0x9E3779B97F4A7C15, -1, 1 << 64))


def keyed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", carry: bool = False) -> DataFrame:
    """``_k, _j, _id, _text`` of every row; a null text reads as empty.  With ``carry`` also
    ``_row``, a struct of all columns but the text, and ``_none``, whether the text is null."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rest = [F.struct(*[F.col(f"`{x}`") for x in docs.columns if x != text_col]).alias("_row"),
            F.col(text_col).isNull().alias("_none")] if carry else []
    return docs.select(F.xxhash64(F.col(id_col), text).alias("_k"),
                       F.hash(text, F.col(id_col)).alias("_j"),
                       F.col(id_col).alias("_id"), text.alias("_text"), *rest)


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` under the session's shared checkpoint folder and read it back: what
    follows starts from files that outlive any executor."""
    spark = df.sparkSession
    path = scratch_path(spark, f"llm-{name}-{uuid.uuid4().hex}")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def groups(batches: Iterator[pa.RecordBatch], size_col: str = "_text",
           limit: int = GROUP_BYTES) -> Iterator[pa.RecordBatch]:
    """The same rows in slices of about ``limit`` bytes of ``size_col`` (one row at least)."""
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = np.asarray(batch.column(size_col).cast(pa.binary()).buffers()[1], dtype=np.uint8)
        offsets = np.frombuffer(sizes, dtype=np.int32)[batch.column(size_col).offset:][:batch.num_rows + 1]
        start = 0
        while start < batch.num_rows:
            end = int(np.searchsorted(offsets, int(offsets[start]) + limit, side="right")) - 1
            end = min(max(end, start + 1), batch.num_rows)
            yield batch.slice(start, end - start)
            start = end


def raw(column: pa.Array) -> list[bytes]:
    """A string column as bytes, null as empty."""
    return [x or b"" for x in column.cast(pa.binary()).to_pylist()]


def pieces(data: bytes, size: int = PIECE) -> Iterator[bytes]:
    """``data`` in slices of about ``size`` bytes that end at white space."""
    if len(data) <= size:
        yield data
        return
    start = 0
    while start < len(data):
        end = min(start + size, len(data))
        while end < len(data) and data[end] not in b" \t\n\x0b\f\r":
            end += 1
        yield data[start:end]
        start = end


def word_hashes(data: bytes) -> np.ndarray:
    """XXH64 of every word, in order."""
    parts = []
    for piece in pieces(data):
        words = piece.split()
        parts.append(np.fromiter(map(xxh64_intdigest, words), dtype=_U, count=len(words)))
    return parts[0] if len(parts) == 1 else np.concatenate(parts)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit words that spreads every bit (xor-shift-multiply)."""
    x = (x ^ (x >> _U(32))) * _U(0xD6E8FEB86659FD93)
    x = (x ^ (x >> _U(32))) * _U(0xD6E8FEB86659FD93)
    return x ^ (x >> _U(32))


class RunHash:
    """Hash of any run of items ``[start, end)`` in O(1) each: with weights ``m**i`` modulo
    2**64 summed from the left, a difference of two sums times ``m**-start`` depends on
    the items alone.  ``salt`` gives independent second hashes."""

    def __init__(self, items: np.ndarray, salt: int = 0):
        if salt:
            items = mix(items ^ _U(salt))
        n = len(items)
        power = np.full(n + 1, _MULT, dtype=_U)
        power[0] = 1
        np.multiply.accumulate(power, out=power)
        self.back = np.full(n + 1, _INV, dtype=_U)
        self.back[0] = 1
        np.multiply.accumulate(self.back, out=self.back)
        self.sums = np.zeros(n + 1, dtype=_U)
        np.cumsum(items * power[:n], out=self.sums[1:])

    def __call__(self, start, end) -> np.ndarray:
        return mix((self.sums[end] - self.sums[start]) * self.back[start])

    def windows(self, size: int) -> np.ndarray:
        """The hash of every window of ``size`` items."""
        n = len(self.sums) - size
        if n <= 0:
            return np.empty(0, dtype=_U)
        return mix((self.sums[size:] - self.sums[:n]) * self.back[:n])


def signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)


def spread(lists: list[np.ndarray], dtype) -> np.ndarray:
    return np.concatenate(lists) if lists else np.empty(0, dtype=dtype)
