"""SentencePiece encoding and decoding with byte offsets.

A text is normalised by the longest prefix that the model's compiled character map holds at each
place; every byte of the normalised text keeps the place in the original that it came from.  The
normalised text is merged by piece scores, and the ends of the pieces, looked up in that alignment,
give every piece the bytes of the original it stands for.  So encoded text can be cut, masked or
marked in the original without decoding.

No piece of the vocabulary has a word-space sign after another character, so a merge never reaches
over the start of a word, and words are encoded one by one: a group of rows encodes each new word
once (taken apart again where two characters stand together in no piece), and each worker keeps the
words of its last two generations.  (Where a model does have such
pieces, texts are cut only at characters that no piece joins to a word-space sign.)

The model file is read on each worker from ``path`` (default: the installed ``piece_bpe_32k.model``);
it has a fixed size and never travels with the data.  Byte-pair models with byte fallback are
supported (a ValueError names any other kind); nothing is trained or sampled.

Defined results: null text encodes as empty text (begin and end ids alone, empty decoded text); every
row has its own result; an empty table gives no rows; bytes that are no UTF-8 read as U+FFFD, one each.
Begin and end ids stand for no bytes; the bytes of a character outside the vocabulary all begin at
that character, and the last of them ends it.
"""

from __future__ import annotations

import heapq
import re
from functools import lru_cache
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewops.llm import common as c

SPACE = "▁"
# Characters of words that a generation of a worker's cache holds, and words of a long text done at a time.
KEEP_CHARS, STRIDE = 1 << 22, 1 << 16
# Words of up to SHORT characters are merged by plain lists.
SHORT, NEVER = 48, 1 << 30
# Types of pieces in a model file.
UNKNOWN, CONTROL, BYTE = 2, 3, 6


class CharMap:
    """A compiled character map: the size of a double-array trie, its 32-bit units, and the
    replacements, each ended by a zero byte.  A unit holds a label in its low byte, a leaf flag in
    bit 8, and the offset of its children from bit 10 (shifted by 8 more where bit 9 is set); a leaf's
    value is the place of the replacement."""

    def __init__(self, blob: bytes):
        size = int.from_bytes(blob[:4], "little")
        self.units = np.frombuffer(blob[4:4 + size], dtype="<u4").tolist()
        self.text = blob[4 + size:]

    @staticmethod
    def _children(unit: int) -> int:
        return (unit >> 10) << ((unit & 0x200) >> 6)

    def longest(self, data: bytes, start: int) -> tuple[bytes, int] | None:
        """Replacement and length of the longest mapped prefix of ``data[start:]``."""
        units, found = self.units, None
        place = self._children(units[0])
        for end in range(start, len(data)):
            place ^= data[end]
            unit = units[place]
            if unit & 0x800000FF != data[end]:
                break
            place ^= self._children(unit)
            if unit >> 8 & 1:
                found = units[place] & 0x7FFFFFFF, end + 1 - start
        return found and (self.text[found[0]:self.text.index(b"\0", found[0])], found[1])


def _char_len(data: bytes, at: int) -> int:
    """Length of the UTF-8 character at ``at``, 0 where there is none."""
    lead = data[at]
    size = 1 if lead < 0x80 else 2 if 0xC2 <= lead < 0xE0 else 3 if 0xE0 <= lead < 0xF0 else 4 if 0xF0 <= lead < 0xF5 else 0
    try:
        data[at:at + size].decode()
    except UnicodeDecodeError:
        return 0
    return size if at + size <= len(data) else 0


class Model:
    """A model file, and the words encoded lately (word -> ids as bytes)."""

    def __init__(self, blob: bytes):
        from sentencepiece import sentencepiece_model_pb2 as proto

        m = proto.ModelProto()
        m.ParseFromString(blob)
        kinds = {p.type for p in m.pieces}
        if m.trainer_spec.model_type != proto.TrainerSpec.BPE or BYTE not in kinds or kinds - {1, UNKNOWN, CONTROL, BYTE}:
            raise ValueError("a byte-pair model of normal pieces with byte fallback is needed")
        if m.trainer_spec.treat_whitespace_as_suffix or m.denormalizer_spec.precompiled_charsmap:
            raise ValueError("word spaces as suffixes and denormalisation maps are not supported")
        spec = m.normalizer_spec
        self.map = CharMap(spec.precompiled_charsmap) if spec.precompiled_charsmap else None
        self.prefix, self.squeeze, self.escape = spec.add_dummy_prefix, spec.remove_extra_whitespaces, spec.escape_whitespaces
        self.space = SPACE if self.escape else " "
        self.bos, self.eos = m.trainer_spec.bos_id, m.trainer_spec.eos_id
        self.unknown = m.trainer_spec.unk_surface.encode()
        ids = {p.piece: i for i, p in enumerate(m.pieces) if p.type == 1}
        # The score's place among all scores: pieces of equal score share it.
        order = {s: i for i, s in enumerate(sorted({m.pieces[i].score for i in ids.values()}, reverse=True))}
        self.rank = {p: order[m.pieces[i].score] for p, i in ids.items() if len(p) > 1}
        self.ids = {p: i.to_bytes(4, "little") for p, i in ids.items()}
        self.byte_ids = {int(p.piece[1:-1], 16): i for i, p in enumerate(m.pieces) if p.type == BYTE}
        self.is_byte, self.is_control = np.zeros(len(m.pieces), dtype=bool), np.zeros(len(m.pieces), dtype=bool)
        self.surface, sizes = [], []
        for i, p in enumerate(m.pieces):
            self.is_byte[i], self.is_control[i] = p.type == BYTE, p.type == CONTROL
            self.surface.append(bytes([int(p.piece[1:-1], 16)]) if p.type == BYTE else b"" if p.type == CONTROL else
                                self.unknown if p.type == UNKNOWN else p.piece.replace(SPACE, " ").encode())
            sizes.append(1 if p.type == BYTE else len(p.piece.encode()) if p.type == 1 else 0)
        # Bytes of normalised text that a piece takes up.
        self.size = np.array(sizes, dtype=np.int64)
        self.spaced = np.array([p.type == 1 and p.piece.startswith(SPACE) for p in m.pieces])
        glued = {a for p in ids for a, b in zip(p, p[1:], strict=False) if b == self.space and a != self.space}
        # Which characters stand next to each other in some piece (0: a character of no piece).
        letters = sorted({x for p in ids for x in p})
        self.number = np.zeros(0x110000, dtype=np.uint16)
        self.number[[ord(x) for x in letters]] = np.arange(1, len(letters) + 1)
        self.inside = np.zeros((len(letters) + 1, len(letters) + 1), dtype=bool)
        pairs = {p[i:i + 2] for p in ids for i in range(len(p) - 1)}
        self.inside[[self.number[ord(x[0])] for x in pairs], [self.number[ord(x[1])] for x in pairs]] = True
        inner = "".join(map(re.escape, sorted(glued)))
        s = re.escape(self.space)
        self.words = re.compile(f"{s}*[^{s}]+(?:(?<=[{inner}]){s}+[^{s}]*)*|{s}+" if glued else f"{s}*[^{s}]+|{s}+")
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.held = 0

    # Normalisation

    def normalise(self, data: bytes) -> tuple[str, np.ndarray | None]:
        """The normalised text, and the place in ``data`` of each of its bytes and of its end (None:
        the map is the identity, ``places`` finds them)."""
        if self.map is None and not self.squeeze:
            try:
                text = data.decode()
            except UnicodeDecodeError:
                pass
            else:
                return ((self.space if self.prefix and text else "") + text.replace(" ", self.space)), None
        return self._by_prefixes(data)

    def _by_prefixes(self, data: bytes) -> tuple[str, np.ndarray]:
        space, out, places, at = self.space.encode(), [], [], 0
        # With ``squeeze``, spaces at the start, at the end and after another space go.
        after_space, pending = self.squeeze, self.prefix
        while at < len(data):
            new, used = (self.map and self.map.longest(data, at)) or (None, _char_len(data, at))
            if new is None:
                new, used = (data[at:at + used], used) if used else ("�".encode(), 1)
            bare = new.lstrip(b" ") if after_space else new
            if bare:
                if pending:
                    out.append(space)
                    places += [at] * len(space)
                    pending = False
                mapped = bare.replace(b" ", space)
                out.append(mapped)
                places += [at] * len(mapped)
                after_space = self.squeeze and bare.endswith(b" ")
            elif not self.squeeze and pending:
                pending = False
            at += used
        joined, end = b"".join(out), len(data)
        while self.squeeze and joined.endswith(space):
            joined = joined[:-len(space)]
            end = places[len(joined)]
        return joined.decode(), np.array(places[:len(joined)] + [end], dtype=np.int64)

    def places(self, data: bytes, text: str, ends: np.ndarray) -> np.ndarray:
        """Where the bytes at ``ends`` of an identity-normalised ``text`` come from."""
        starts = np.flatnonzero((np.frombuffer(data, dtype=np.uint8) & 0xC0) != 0x80)
        origin = np.concatenate([np.zeros(1 if self.prefix else 0, dtype=np.int64), starts, [len(data)]])
        lead = (np.frombuffer(text.encode(), dtype=np.uint8) & 0xC0) != 0x80
        number = np.concatenate([np.cumsum(lead) - 1, [len(origin) - 1]])
        return origin[number[ends]]

    # Merging

    def merged(self, word: str) -> bytes:
        """Ids of one word: the pair of best score, leftmost first, until none is left."""
        parts = self._merge(list(word)) if len(word) <= SHORT else self._merge_long(list(word))
        ids = self.ids
        return b"".join([x if (x := ids.get(p)) else b"".join([self.byte_ids[b].to_bytes(4, "little") for b in p.encode()])
                         for p in parts])

    def _merge(self, parts: list[str]) -> list[str]:
        get = self.rank.get
        rank = [get(a + b, NEVER) for a, b in zip(parts, parts[1:], strict=False)]
        while rank and (least := min(rank)) < NEVER:
            i = rank.index(least)
            parts[i:i + 2] = [parts[i] + parts[i + 1]]
            del rank[i]
            if i:
                rank[i - 1] = get(parts[i - 1] + parts[i], NEVER)
            if i < len(rank):
                rank[i] = get(parts[i] + parts[i + 1], NEVER)
        return parts

    def _merge_long(self, parts: list[str]) -> list[str]:
        """The same with links between neighbours and a heap of candidate pairs."""
        n, get = len(parts), self.rank.get
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(r, i, len(p)) for i in range(n - 1) if (r := get(p := parts[i] + parts[i + 1])) is not None]
        heapq.heapify(heap)
        while heap:
            _, i, size = heapq.heappop(heap)
            j = after[i]
            if not parts[i] or j >= n or len(parts[i]) + len(parts[j]) != size:
                continue
            parts[i], parts[j] = parts[i] + parts[j], ""
            after[i] = k = after[j]
            if k < n:
                before[k] = i
                if (r := get(p := parts[i] + parts[k])) is not None:
                    heapq.heappush(heap, (r, i, len(p)))
            if (h := before[i]) >= 0 and (r := get(p := parts[h] + parts[i])) is not None:
                heapq.heappush(heap, (r, h, len(p)))
        return [p for p in parts if p]

    def learn(self, words: set[str]) -> None:
        """Encode what is not known.  A full generation becomes the older one; its words that
        come again move to the new one, the rest go at the next change."""
        if self.held > KEEP_CHARS:
            self.older, self.known, self.held = self.known, {}, 0
        new = self._unknown(words)
        if not new:
            return
        # Characters next to each other in no piece are never merged: words fall into fragments there, which recur.
        known, joined, ends = self.known, "".join(new), np.cumsum(list(map(len, new)))
        x = self.number[np.frombuffer(joined.encode("utf-32-le"), dtype="<u4")]
        cut = np.union1d(np.flatnonzero(~self.inside[x[:-1], x[1:]]) + 1, ends)
        last = (np.searchsorted(cut, ends) + 1).tolist()
        cut = cut.tolist()
        parts = [joined[a:b] for a, b in zip([0, *cut[:-1]], cut, strict=True)]
        fresh = self._unknown(set(parts))
        known.update(zip(fresh, map(self.merged, fresh), strict=True))
        first = 0
        for w, end in zip(new, last, strict=True):
            if end > first + 1:
                known[w] = b"".join([known[p] for p in parts[first:end]])
            first = end
        self.held += len(joined) + sum(map(len, fresh))

    def _unknown(self, words: set[str]) -> list[str]:
        """What neither generation holds; words of the older one move to the new one."""
        new, older = words - self.known.keys(), self.older
        if again := older.keys() & new:
            self.known.update((w, older[w]) for w in again)
            self.held += sum(map(len, again))
            new -= again
        return list(new)

    def _joined(self, words: list[str]) -> bytes:
        return b"".join(map(self.known.__getitem__, words))

    def encode_all(self, texts: list[bytes], bos: bool = False, eos: bool = False) -> list[tuple[bytes, bytes, bytes]]:
        """Ids, begins and ends (byte offsets into the text) of whole texts, as little-endian
        unsigned 32-bit integers."""
        normal, ids = [self.normalise(t) for t in texts], []
        for text, _ in normal:
            if len(text) <= c.PIECE:
                ids.append(self.words.findall(text))
                continue
            words, parts = (m.group() for m in self.words.finditer(text)), []
            while some := list(islice(words, STRIDE)):
                self.learn(set(some))
                parts.append(self._joined(some))
            ids.append(b"".join(parts))
        self.learn(set().union(*(x for x in ids if isinstance(x, list))))
        out = []
        for data, (text, places), x in zip(texts, normal, ids, strict=True):
            x = self._joined(x) if isinstance(x, list) else x
            ends = np.cumsum(self.size[np.frombuffer(x, dtype="<u4")])
            ends = (self.places(data, text, ends) if places is None else places[ends]).astype("<u4")
            first, last = [places[0] if places is not None and len(places) else 0], [len(data)]
            begins = np.concatenate([first, ends])[:len(ends)].astype("<u4")
            if bos:
                x = self.bos.to_bytes(4, "little") + x
                begins, ends = (np.concatenate([[0], a]).astype("<u4") for a in (begins, ends))
            if eos:
                x += self.eos.to_bytes(4, "little")
                begins, ends = (np.concatenate([a, last]).astype("<u4") for a in (begins, ends))
            out.append((x, begins.tobytes(), ends.tobytes()))
        return out

    # Decoding

    def decode(self, ids: bytes) -> str:
        x = np.frombuffer(ids, dtype="<u4")
        real = x[~self.is_control[x]]
        parts = list(map(self.surface.__getitem__, real.tolist()))
        if (self.prefix or self.squeeze) and len(real):
            # The word-space sign that normalisation put in front; with ``squeeze``, as long as nothing is written.
            at = 0
            while at < len(real) and self.spaced[real[at]]:
                parts[at] = parts[at][1:]
                if parts[at] or not self.squeeze:
                    break
                at += 1
        try:
            return b"".join(parts).decode()
        except UnicodeDecodeError:
            return "".join(self._runs(real, parts))

    def _runs(self, real: np.ndarray, parts: list[bytes]):
        """Runs of byte pieces read by themselves; a byte that starts no character is U+FFFD."""
        byte = self.is_byte[real]
        cuts = [0, *(np.flatnonzero(byte[1:] != byte[:-1]) + 1).tolist(), len(parts)]
        for a, b in zip(cuts, cuts[1:], strict=False):
            data, at = b"".join(parts[a:b]), 0
            while byte[a] and at < len(data):
                size = _char_len(data, at)
                yield data[at:at + size].decode() if size else "�"
                at += size or 1
            if not byte[a]:
                yield data.decode()


@lru_cache(maxsize=2)
def model(path: str | None) -> Model:
    if path is None:
        import public_tokenizers

        path = public_tokenizers.path("piece_bpe_32k.model")
    with open(path, "rb") as f:
        return Model(f.read())


_SPANS = ["ids", "begins", "ends"]


def _encode(path, bos, eos, decode):
    def run(batches):
        known = model(path)
        for batch in c.groups(batches, limit=c.GROUP_BYTES // 4):
            out = known.encode_all(c.raw(batch.column("_text")), bos, eos)
            cols = [pa.array(x, pa.binary()) for x in zip(*out, strict=True)]
            texts = [pa.array([known.decode(x) for x, _, _ in out], pa.string())] if decode else []
            yield pa.RecordBatch.from_arrays([batch.column("_id"), *cols, *texts], names=["_id", *_SPANS, *["decoded"][:decode]])
        known.known, known.older, known.held = {}, {}, 0
        pa.default_memory_pool().release_unused()

    return run


def _decode(path):
    def run(batches):
        known = model(path)
        for batch in c.groups(batches, "ids", c.GROUP_BYTES):
            texts = [known.decode(x or b"") for x in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("_id"), batch.column("ids"), pa.array(texts, pa.string())],
                                             names=["_id", "ids", "decoded"])

    return run


def _rows(docs, path, id_col, text_col, bos, eos, decode):
    rows = c.keyed(docs, id_col, text_col).select("_id", "_text")
    schema = f"_id {rows.schema['_id'].dataType.simpleString()}, ids binary, begins binary, ends binary" + ", decoded string" * decode
    return rows.mapInArrow(_encode(path, bos, eos, decode), schema).withColumnRenamed("_id", id_col)


def sp_encode(docs: DataFrame, path: str | None = None, id_col: str = "doc_id", text_col: str = "text", bos: bool = True,
              eos: bool = True) -> DataFrame:
    """One row per row of ``docs``: id, ``ids``, and ``begins`` and ``ends``, each piece's byte offsets
    into the text; all little-endian unsigned 32-bit integers."""
    return _rows(docs, path, id_col, text_col, bos, eos, False)


def sp_decode(encoded: DataFrame, path: str | None = None, id_col: str = "doc_id") -> DataFrame:
    """``encoded`` (id, ``ids``) with the ``decoded`` text; null ids decode as empty."""
    rows = encoded.select(F.col(id_col).alias("_id"), "ids")
    kind = rows.schema["_id"].dataType.simpleString()
    return rows.mapInArrow(_decode(path), f"_id {kind}, ids binary, decoded string").withColumnRenamed("_id", id_col)


def sp_round_trip(docs: DataFrame, path: str | None = None, id_col: str = "doc_id", text_col: str = "text", bos: bool = True,
                  eos: bool = True) -> DataFrame:
    """``sp_encode`` and its decoded text in one pass, so that a task needs one Python worker."""
    return _rows(docs, path, id_col, text_col, bos, eos, True)


def op12_sentencepiece(spark, sf_dir: str) -> DataFrame:
    """Encode and decode every whole text of ``documents``, with begin and end ids; ``spans_sha256``
    is the digest of all begins, then all ends."""
    out = sp_round_trip(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return out.select("doc_id", F.expr("octet_length(ids) div 4").cast("long").alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"),
                      F.sha2("decoded", 256).alias("decoded_sha256"), F.sha2(F.concat("begins", "ends"), 256).alias("spans_sha256"))
