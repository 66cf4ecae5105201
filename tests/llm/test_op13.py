import math
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from reviewops.llm import op13_whitening as w

SCHEMA = "vec_id long, embedding array<float>, label int"


def table(spark, vectors, schema=SCHEMA):
    return spark.createDataFrame([(i, v, 0) for i, v in vectors], schema).repartition(3)


def brute(vectors):
    """Fixed-point vectors, exact sums and deviations, and the covariance's eigenvalues and vectors."""
    good = [(i, [math.floor(64 * float(np.float32(x))) + 1000000 for x in v]) for i, v in vectors
            if v and all(x is not None and math.isfinite(x) for x in v)]
    fit = sorted({tuple(x) for _, x in good})
    n, total = len(fit), [sum(c) for c in zip(*fit, strict=True)]
    y = np.array([[n * a - s for a, s in zip(x, total, strict=True)] for x in fit], dtype=float) / n
    e, v = np.linalg.eigh(y.T @ y / n)
    dev = [(i, sum((n * a - s) ** 2 for a, s in zip(x, total, strict=True))) for i, x in good]
    return n, dev, e[::-1], v[:, ::-1], good, total


def run(df, k=16):
    rows = w.fixed_point(df)
    model, unique = w.fit(rows)
    return model, unique, w.whiten(rows, model, k).collect()


def check(df, vectors, k=16):
    n, dev, e, v, good, total = brute(vectors)
    model, unique, out = run(df, k)
    k = min(k, int((e > e[0] * 1e-13).sum()))
    got = defaultdict(list)
    for r in out:
        got[r.vec_id].append(r)
    assert Counter((r.vec_id, r.deviation) for r in out if r.component == 1) == Counter(dev)
    assert len(out) == k * len(good) and {r.n for r in out} <= {n}
    for r in out:
        assert r.explained == pytest.approx(e[r.component - 1] / e.sum(), rel=1e-9, abs=1e-14)
    assert w.identity_error(unique, model, k) < 1e-8
    # components are the covariance's, up to sign, where eigenvalues differ
    for j in range(k):
        gap = min([abs(e[j] - e[i]) for i in range(len(e)) if i != j] or [1])
        if gap > e[0] * 1e-6:
            sign = np.sign(model.vectors[:, j] @ v[:, j])
            assert np.abs(model.vectors[:, j] * sign - v[:, j]).max() < 1e-7
    for vid, x in good[:50]:
        y = np.array([a - s / n for a, s in zip(x, total, strict=True)])
        want = y @ model.vectors[:, :k] / np.sqrt(model.values[:k])
        # rows of a repeated id are compared as a set
        if len(got[vid]) == k:
            assert np.allclose([r.whitened for r in sorted(got[vid], key=lambda r: r.component)], want, atol=1e-9)
    return model


def test_query_equals_brute_force(spark, sf):
    from reviewops.llm.op13_whitening import op13_whitening

    df = spark.read.parquet(f"{sf}/embeddings.parquet")
    vectors = [(r.vec_id, r.embedding) for r in df.collect()]
    check(df, vectors)
    out = op13_whitening(spark, sf)
    assert out.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    assert out.agg(F.max("identity_error")).first()[0] < 1e-4
    assert out.count() == 16 * len([v for _, v in vectors if v])


def test_nulls_repeats_and_lengths(spark):
    r = random.Random(5)
    vectors = [(i, [r.gauss(0, 1) for _ in range(6)]) for i in range(80)]
    vectors += [(100 + i, vectors[3][1]) for i in range(200)]  # one group holds most rows
    vectors += [(7, vectors[7][1]), (None, [1.0] * 6)]
    odd = [(400, None), (401, []), (402, [1.0, None] * 3), (403, [float("nan")] * 6), (404, [float("inf")] + [0.0] * 5),
           (405, [1e30] * 6), (406, [1.0, 2.0])]
    model = check(table(spark, vectors + odd), vectors)
    assert model.n == 81 and model.dim == 6


def test_constant_and_dependent_entries_have_no_component(spark):
    r = random.Random(6)
    base = [[float(r.randrange(-300, 300)) for _ in range(3)] for _ in range(60)]
    vectors = [(i, [a, b, c, a + b, 2.0, a - c]) for i, (a, b, c) in enumerate(base)]
    model = check(table(spark, vectors), vectors)
    assert len(model.values) == 3


def test_small_variance_beside_large(spark):
    """Spread of 1 : 10**5 in scale, 1 : 10**10 in variance."""
    r = random.Random(7)
    vectors = [(i, [r.gauss(0, 1) * 3000, r.gauss(0, 1) * 3, r.gauss(0, 0.03)]) for i in range(500)]
    check(table(spark, vectors), vectors)


def test_deviation_is_exact_beyond_a_double_and_null_beyond_a_long(spark):
    vectors = [(i, [float(2**18 * i), float(i % 3)]) for i in range(12)]
    n, dev, *_ = brute(vectors)
    assert max(d for _, d in dev) > 2**53
    _, _, out = run(table(spark, vectors))
    assert sorted((r.vec_id, r.deviation) for r in out if r.component == 1) == dev
    _, _, out = run(table(spark, [(0, [2.0**50, 0.0]), (1, [0.0, 1.0])]))
    assert {r.deviation for r in out} == {None}


def test_empty_single_and_clashing_columns(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert run(empty)[0] is None and run(empty)[2] == []
    one = table(spark, [(1, [1.0, 2.0]), (2, [1.0, 2.0])])
    model, _, out = run(one)
    assert model.n == 1 and out == []
    wild = table(spark, [(i, [float(i), float(i * i % 7)]) for i in range(20)]).selectExpr(
        "vec_id", "embedding", "label as _id", "1 as _x", "2 as n", "3 as component", "4 as i", "5 as j", "6 as v")
    assert len(run(wild)[2]) == 40


def test_passes_are_repeated_and_orthonormal(spark):
    r = random.Random(9)
    vectors = [(i, [r.gauss(0, 10.0 ** -k) * 500 for k in range(4)]) for i in range(300)]
    model, unique, _ = run(table(spark, vectors))
    assert 3 <= model.passes <= w.MOST_PASSES + 1
