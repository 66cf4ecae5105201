import random
import re

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from reviewops.llm import graph
from reviewops.llm import op3_simhash as op3
from reviewops.llm.graph import components

WORD = re.compile("[^\x20\x09-\x0d]+")


def spec_fingerprint(text, k=4):
    low = "".join(chr(ord(x) + 32) if "A" <= x <= "Z" else x for x in text or "")
    w = WORD.findall(low)
    s = [" ".join(w[i:i + k]) for i in range(len(w) - k + 1)] if len(w) >= k else [" ".join(w)] * bool(w)
    h = [xxhash.xxh64(x.encode(), seed=42).intdigest() for x in s]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def spec_components(fps, radius=4):
    """Root index of each fingerprint by comparing every pair."""
    f = np.array(fps, dtype=np.uint64)
    root = list(range(len(f)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(f)):
        for j in np.flatnonzero(np.bitwise_count(f[i + 1:] ^ f[i]) <= radius) + i + 1:
            a, b = find(i), find(int(j))
            root[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(f))]


def want(rows):
    fps = [spec_fingerprint(t) for _, t in rows]
    root = spec_components(fps)
    low = {}
    for (doc_id, _), r in zip(rows, root, strict=True):
        if doc_id is not None:
            low[r] = min(low.get(r, doc_id), doc_id)
    return sorted(((d, f"{f:016x}", low.get(r)) for (d, _), f, r in zip(rows, fps, root, strict=True)), key=str)


def got(df):
    return sorted(((r.doc_id, r.fingerprint, r.component_id) for r in df.collect()), key=str)


def test_bit_sliced_links_find_exactly_the_near_pairs():
    r = np.random.default_rng(5)
    for n in (1, 2, 63, 64, 65, 700):
        base = r.integers(0, 2**64, max(1, n // 8), dtype=np.uint64)
        fps = np.unique(base[r.integers(0, len(base), n)]
                        ^ np.array([sum(1 << int(b) for b in r.integers(0, 64, r.integers(0, 4))) for _ in range(n)], dtype=np.uint64))
        d = np.bitwise_count(fps[:, None] ^ fps[None, :])
        for radius in (0, 3, 4, 7):
            i, j = np.nonzero(np.triu(d <= radius, 1))
            assert sorted(zip(*op3.links(fps, radius), strict=True)) == sorted(zip(i, j, strict=True))


def test_masks_lose_no_pair():
    masks = op3._masks(6, 4)
    r = random.Random(1)
    for _ in range(2000):
        x = sum(1 << b for b in r.sample(range(64), r.randrange(5)))
        assert any(not x & m for m in masks)


def test_long_text_in_pieces_equals_whole():
    text = " ".join(f"Wé{i % 977}" for i in range(300_000))
    assert op3.fingerprint(text.encode(), 4) == spec_fingerprint(text)


@pytest.mark.parametrize("held", [200_000, 2])
def test_components_of_chains_hubs_and_loops(spark, monkeypatch, held):
    monkeypatch.setattr(graph, "HELD", held)
    edges = [(i, i + 1) for i in range(1, 60)] + [(1000, k) for k in range(1001, 1200)] + [(5, 5), (70, 60), (60, 70)]
    frame = spark.createDataFrame(edges, "u long, v long").repartition(7)
    out = {r.node: r.root for r in components(frame).collect()}
    named = components(frame.selectExpr("lpad(u, 5, '0') AS u", "lpad(v, 5, '0') AS v"))
    assert {int(r.node): int(r.root) for r in named.collect()} == out and named.count() == len(out)
    assert {out[k] for k in range(1, 61)} | {out[70]} == {1}
    assert {out[k] for k in range(1000, 1200)} == {1000}
    assert components(spark.createDataFrame([], "u long, v long")).collect() == []


@pytest.mark.parametrize("lanes", [1024, 3])
def test_operator_against_brute_force(make_docs, monkeypatch, lanes):
    monkeypatch.setattr(op3, "LANES", lanes)
    r = random.Random(7)
    base = [[f"t{r.randrange(200)}" for _ in range(120)] for _ in range(8)]
    rows = [(None, None), (3, ""), (2, "  \n"), (4, "One two"), (5, "one  TWO"), (None, "one two"), (6, "É é")]
    for i in range(60):
        w = list(r.choice(base))
        for _ in range(r.randrange(3)):
            w[r.randrange(len(w))] = "x"
        rows.append((100 + i, " ".join(w)))
    rows += rows[-5:]
    docs = make_docs(rows).withColumn("fp", F.lit("x")).withColumn("root", F.lit(1))
    assert got(op3.simhash_dedup(docs)) == want(rows)
    assert got(op3.simhash_dedup(make_docs([]))) == []


def test_query(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").collect()
    assert got(op3.op3_simhash(spark, sf)) == want([(d.doc_id, d.text) for d in docs])
