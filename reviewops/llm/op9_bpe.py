"""Byte-pair encoding and decoding with forced boundaries.

A pair of neighbouring bytes that stands inside no token of the vocabulary can never be
inside a token of any text, so a token must end there: the text is cut at such pairs, each
fragment is merged alone, and the token lists are concatenated.  Fragments are short even
where the tokenizer's own pre-split leaves one long piece (runs without white space), and
merging one never looks past its end.

Order of work: special tokens, the byte-level pre-split pattern, forced cuts inside each
piece, merges by rank inside each fragment.  Pieces recur, so a group of rows encodes each
new piece once, and each worker keeps what it has encoded, up to a fixed number of pieces.

The vocabulary file is read on each worker from ``path`` (default: the installed
``byte_bpe_50k.json``); it has a fixed size and never travels with the data.

Defined results: null text encodes as empty text (no tokens, empty decoded text); every row
has its own result; an empty table gives no rows; the text of a special token encodes to
its id, as the tokenizers library does by default.
"""

from __future__ import annotations

import heapq
import json
import sys
from array import array
from functools import lru_cache
from itertools import islice

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewops.llm import common as c

# Fixed value: the byte-level pre-split pattern of the tokenizer files.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
# Pieces that a worker keeps, and pieces of a long text encoded at a time.
KEEP_PIECES, STRIDE = 1 << 18, 1 << 16
# Fragments of up to SHORT bytes are merged by plain lists.  A merge is rank * SPAN + new id.
SHORT, SPAN, NEVER = 64, 1 << 32, 1 << 62
LITTLE = sys.byteorder == "little" and array("I").itemsize == 4


def _byte_letters() -> dict[str, int]:
    """The alphabet of byte-level vocabulary files: printable Latin-1 stands for itself,
    the other bytes, in order, for the code points from 256."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + k): b for k, b in enumerate(rest)}


class Vocabulary:
    """A vocabulary file, and the pieces encoded so far (piece -> ids as bytes)."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        letters = _byte_letters()
        ids = spec["model"]["vocab"]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        plain = {k: bytes(letters[x] for x in k) for k in ids if k not in self.special}
        self.token = [b""] * (max([*ids.values(), *self.special.values()]) + 1)
        for k, b in plain.items():
            self.token[ids[k]] = b
        for k, i in self.special.items():
            self.token[i] = k.encode()
        self.of_byte = [ids[x] for x, _ in sorted(letters.items(), key=lambda kv: kv[1])]
        # Rank and result of a merge in one number, so that the least number is the next merge.
        self.merge = {}
        for rank, pair in enumerate(spec["model"]["merges"]):
            a, b = pair.split(" ") if isinstance(pair, str) else pair
            self.merge[ids[a], ids[b]] = rank * SPAN + ids[a + b]
        inside = np.zeros((256, 256), dtype=bool)
        for b in plain.values():
            x = np.frombuffer(b, dtype=np.uint8)
            inside[x[:-1], x[1:]] = True
        self.forced = ~inside
        self.split = regex.compile(PATTERN)
        self.specials = regex.compile("(" + "|".join(map(regex.escape, sorted(self.special, key=len, reverse=True))) + ")")
        self.known: dict[str, bytes] = {}

    def cuts(self, data: bytes) -> np.ndarray:
        """Places in ``data`` that no token can reach across."""
        x = np.frombuffer(data, dtype=np.uint8)
        return np.flatnonzero(self.forced[x[:-1], x[1:]]) + 1

    def merged(self, data: bytes) -> list[int]:
        """Token ids of one fragment: the pair of least rank, leftmost first, until none is left."""
        tok = [self.of_byte[b] for b in data]
        if len(tok) > SHORT:
            return self._merged_long(tok)
        get = self.merge.get
        rank = [get(pair, NEVER) for pair in zip(tok, tok[1:], strict=False)]
        while rank and (least := min(rank)) < NEVER:
            i = rank.index(least)
            tok[i:i + 2] = [least % SPAN]
            del rank[i]
            if i:
                rank[i - 1] = get((tok[i - 1], tok[i]), NEVER)
            if i < len(rank):
                rank[i] = get((tok[i], tok[i + 1]), NEVER)
        return tok

    def _merged_long(self, tok: list[int]) -> list[int]:
        """The same with links between neighbours and a heap of candidate pairs."""
        n, get = len(tok), self.merge.get
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(r, i, tok[i], tok[i + 1]) for i in range(n - 1) if (r := get((tok[i], tok[i + 1]))) is not None]
        heapq.heapify(heap)
        while heap:
            r, i, a, b = heapq.heappop(heap)
            j = after[i]
            if tok[i] != a or j >= n or tok[j] != b:
                continue
            tok[i], tok[j] = r % SPAN, -1
            after[i] = k = after[j]
            if k < n:
                before[k] = i
                if (r := get((tok[i], tok[k]))) is not None:
                    heapq.heappush(heap, (r, i, tok[i], tok[k]))
            if (h := before[i]) >= 0 and (r := get((tok[h], tok[i]))) is not None:
                heapq.heappush(heap, (r, h, tok[h], tok[i]))
        return [t for t in tok if t >= 0]

    def learn(self, pieces: set[str]) -> None:
        """Encode what is not yet known: all pieces are cut at once, their fragments merged one by one."""
        if len(self.known) + len(pieces) > KEEP_PIECES:
            self.known.clear()
        new = [p for p in pieces if p not in self.known]
        if not new:
            return
        data = [p.encode() for p in new]
        ends = np.cumsum([len(d) for d in data])
        joined = b"".join(data)
        cut = np.union1d(self.cuts(joined), ends)
        whole = np.searchsorted(cut, ends, side="right").tolist()
        cut = cut.tolist()
        parts = [self.merged(joined[a:b]) for a, b in zip([0, *cut[:-1]], cut, strict=True)]
        start = 0
        for piece, end in zip(new, whole, strict=True):
            ids = parts[start] if end == start + 1 else [t for part in parts[start:end] for t in part]
            self.known[piece] = array("I", ids).tobytes() if LITTLE else np.array(ids, dtype="<u4").tobytes()
            start = end

    def encode_all(self, texts: list[str]) -> list[bytes]:
        """Token ids of whole texts, as little-endian unsigned 32-bit integers."""
        out = []
        for text in texts:
            ids = []
            for section in self.specials.split(text) if any(s in text for s in self.special) else [text]:
                if section in self.special:
                    ids.append(self.special[section].to_bytes(4, "little"))
                elif len(section) <= c.PIECE:
                    ids.append(self.split.findall(section))
                else:
                    pieces = (m.group() for m in self.split.finditer(section))
                    while some := list(islice(pieces, STRIDE)):
                        ids.append(self._ids([some]))
            out.append(ids)
        self.learn(set().union(*(x for ids in out for x in ids if isinstance(x, list))))
        return [b"".join([x if isinstance(x, bytes) else b"".join(map(self.known.__getitem__, x)) for x in ids]) for ids in out]

    def _ids(self, lists: list[list[str]]) -> bytes:
        self.learn(set().union(*lists))
        return b"".join([b"".join(map(self.known.__getitem__, x)) for x in lists])

    def decode(self, ids: np.ndarray) -> str:
        return b"".join(map(self.token.__getitem__, ids.tolist())).decode("utf-8", "replace")


@lru_cache(maxsize=2)
def vocabulary(path: str | None) -> Vocabulary:
    if path is None:
        import public_tokenizers

        path = public_tokenizers.path("byte_bpe_50k.json")
    return Vocabulary(path)


def _encode(path):
    def run(batches):
        known = vocabulary(path)
        for batch in c.groups(batches, limit=c.GROUP_BYTES // 4):
            ids = known.encode_all([x or "" for x in batch.column("_text").to_pylist()])
            yield pa.RecordBatch.from_arrays([batch.column("_id"), pa.array(ids, pa.binary())], names=["_id", "ids"])

    return run


def _round_trip(path):
    def run(batches):
        known = vocabulary(path)
        for batch in c.groups(batches, limit=c.GROUP_BYTES // 4):
            ids = known.encode_all([x or "" for x in batch.column("_text").to_pylist()])
            texts = [known.decode(np.frombuffer(x, dtype="<u4")) for x in ids]
            yield pa.RecordBatch.from_arrays([batch.column("_id"), pa.array(ids, pa.binary()), pa.array(texts, pa.string())],
                                             names=["_id", "ids", "decoded"])
        known.known.clear()
        pa.default_memory_pool().release_unused()

    return run


def _decode(path):
    def run(batches):
        known = vocabulary(path)
        for batch in c.groups(batches, "ids", c.GROUP_BYTES):
            texts = [known.decode(np.frombuffer(x or b"", dtype="<u4")) for x in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("_id"), batch.column("ids"), pa.array(texts, pa.string())],
                                             names=["_id", "ids", "decoded"])

    return run


def bpe_encode(docs: DataFrame, path: str | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: id and ``ids``, the token ids as little-endian unsigned
    32-bit integers."""
    rows = c.keyed(docs, id_col, text_col).select("_id", "_text")
    kind = rows.schema["_id"].dataType.simpleString()
    return rows.mapInArrow(_encode(path), f"_id {kind}, ids binary").withColumnRenamed("_id", id_col)


def bpe_decode(encoded: DataFrame, path: str | None = None, id_col: str = "doc_id") -> DataFrame:
    """``encoded`` (id, ``ids``) with the ``decoded`` text; null ids decode as empty."""
    rows = encoded.select(F.col(id_col).alias("_id"), "ids")
    kind = rows.schema["_id"].dataType.simpleString()
    return rows.mapInArrow(_decode(path), f"_id {kind}, ids binary, decoded string").withColumnRenamed("_id", id_col)


def bpe_round_trip(docs: DataFrame, path: str | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``bpe_decode(bpe_encode(docs))`` in one pass, so that a task needs one Python worker."""
    rows = c.keyed(docs, id_col, text_col).select("_id", "_text")
    kind = rows.schema["_id"].dataType.simpleString()
    return rows.mapInArrow(_round_trip(path), f"_id {kind}, ids binary, decoded string").withColumnRenamed("_id", id_col)


def digests(decoded: DataFrame, id_col: str = "doc_id") -> DataFrame:
    return decoded.select(id_col, F.expr("octet_length(ids) div 4").cast("long").alias("n_tokens"),
                          F.sha2("ids", 256).alias("ids_sha256"), F.sha2(F.col("decoded"), 256).alias("decoded_sha256"))


def op9_bpe(spark, sf_dir: str) -> DataFrame:
    """Encode and decode every whole text of ``documents``."""
    return digests(bpe_round_trip(spark.read.parquet(f"{sf_dir}/documents.parquet")))
