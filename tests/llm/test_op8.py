import numpy as np
import pytest
from pyspark.sql import functions as F

from reviewops.llm import op8_embeddings as op8


def brute(rows, t=0.98):
    """Rows of (id, vector or None, label): links by comparing all pairs."""
    unit = []
    for _, v, label in rows:
        ok = label is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)
        a = np.array(v, dtype=np.float64) if ok else None
        unit.append(a / np.abs(a).max() / np.linalg.norm(a / np.abs(a).max()) if ok else None)
    n, root = [0] * len(rows), list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            if unit[i] is not None and unit[j] is not None and rows[i][2] == rows[j][2] and len(unit[i]) == len(unit[j]) \
                    and unit[i] @ unit[j] >= t:
                n[i] += 1
                n[j] += 1
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    low = {}
    for i, (d, _, _) in enumerate(rows):
        if d is not None:
            low[find(i)] = min(low.get(find(i), d), d)
    return sorted(((d, n[i], low.get(find(i)), d == low.get(find(i))) for i, (d, _, _) in enumerate(rows)), key=str)


def got(df):
    return sorted(((r.vec_id, r.n_links, r.component_id, r.kept) for r in df.collect()), key=str)


def table(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")


def cloud(seed, size, dim=16, centres=12):
    r = np.random.default_rng(seed)
    base = r.normal(size=(centres, dim))
    out = []
    for i in range(size):
        v = base[r.integers(centres)] + r.normal(size=dim) * r.choice([0.0, 0.05, 0.1, 0.2])
        out.append((i, [float(x) for x in (v * r.choice([1, 3])).astype(np.float32)], int(r.integers(3))))
    return out


@pytest.mark.parametrize("block,leaf", [(512, 64), (7, 3)])
def test_against_brute_force(spark, monkeypatch, block, leaf):
    monkeypatch.setattr(op8, "BLOCK", block)
    monkeypatch.setattr(op8, "LEAF", leaf)
    rows = cloud(1, 250)
    nan, inf = float("nan"), float("inf")
    rows += [(900, None, 1), (901, [], 1), (902, [0.0] * 16, 1), (903, [nan] + [1.0] * 15, 1), (904, [inf] + [1.0] * 15, 1),
             (905, [None] + [1.0] * 15, 1), (906, rows[0][1], None), (None, rows[0][1], rows[0][2]), rows[5], rows[5],
             (907, [1.0, -0.0], 1), (908, [1.0, 0.0], 1), (909, [2.0, 0.0], 1), (None, None, None), (910, [1e-30] * 3, 2), (911, [1e30] * 3, 2)]
    vectors = table(spark, rows).withColumn("k", F.lit(1)).withColumn("x", F.lit("x")).withColumn("id", F.lit(2))
    want = brute(rows)
    assert sum(r[1] for r in want) > 300
    assert got(op8.embedding_dedup(vectors)) == want


def test_empty(spark):
    assert op8.embedding_dedup(table(spark, [])).collect() == []
    assert got(op8.embedding_dedup(table(spark, [(1, None, 1)]))) == [(1, 0, 1, True)]


def test_interval_join_finds_each_pair_once():
    r = np.random.default_rng(3)
    u = r.normal(size=(300, 3))
    u /= np.linalg.norm(u, axis=1, keepdims=True)
    u = u[np.lexsort(np.floor(u / 0.2).T[::-1])]
    i, j = op8.interval_join(u, u, u, u, 0.2 + 1e-9, 0.98, True)
    want = np.nonzero(np.triu(u @ u.T >= 0.98, 1))
    assert sorted(zip(i, j, strict=True)) == sorted(zip(*want, strict=True))


def test_query(spark, sf):
    rows = [(r.vec_id, r.embedding, r.label) for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()]
    assert got(op8.op8_embedding_dedup(spark, sf)) == brute(rows)
