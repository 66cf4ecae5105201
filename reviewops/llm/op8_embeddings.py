"""Embedding near-dedup by an epsilon grid order join.

Two vectors link if their labels are equal and not null and their cosine (double precision)
is at least ``min_cosine``.  For unit vectors that is a distance of at most
``eps = sqrt(2 - 2 * min_cosine)``, and no projection onto orthonormal axes makes a distance
longer.  So:

1. Equal vectors of a label are one class with a count.
2. The axes are the leading principal dimensions of all classes (sums of products are
   aggregated in Spark: one number for each pair of components reaches the driver).
3. Classes are sorted by label and then by the cells, ``eps`` wide, of their projections (epsilon
   grid order) and cut into sequence intervals (*blocks*) of at most ``BLOCK`` classes.
   Equal cells may be cut anywhere, so no cell and no label has to fit in a task.
4. Blocks whose boxes on the first two axes touch the same or neighbouring cells meet by an
   equi-join on label and cell; pairs whose boxes are more than ``eps`` apart on any axis are
   dropped.  Only the blocks' boxes take part in this.
5. Each pair of blocks is joined recursively: intervals are halved, halves provably more
   than ``eps`` apart are skipped, and small ones are compared by their exact cosines.  A pair
   of blocks gives, for each class, how many vectors it links to, and the edges of a
   spanning forest, never all pairs.

The axes decide only what is skipped; results do not depend on them.

Defined results: a vector that is null, empty, zero or holds a null or non-finite component,
or whose label is null, links with nothing (``n_links`` 0, itself its component, kept);
vectors of different length do not link; equal rows link like any two equal vectors; a null
id takes no part in the smallest id, and ``kept`` compares ids null-safely; an empty table gives
no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewops.llm import common as c
from reviewops.llm.graph import components, local_roots

AXES, BLOCK, LEAF = 8, 512, 64
BOXES = "b long, label {label}, d int, lo array<double>, hi array<double>, k binary, j binary, m binary, x binary"
FOUND = "edge boolean, k long, j long, k2 long, j2 long, n long"


def _unit(flat: np.ndarray, d: int) -> np.ndarray:
    x = flat.reshape(-1, d)
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def _vectors(batch: pa.RecordBatch) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """For each length in the batch: the length, the rows that have it, their components."""
    lists = batch.column("x")
    size = np.diff(np.asarray(lists.offsets))
    flat = lists.flatten().to_numpy(zero_copy_only=False)
    start = np.r_[0, np.cumsum(size)]
    for d in np.unique(size):
        rows = np.flatnonzero(size == d)
        yield int(d), rows, flat[(start[rows][:, None] + np.arange(d)).ravel()]


def _products(batches):
    """Sums of products of components, one set for each task."""
    total = {}
    for batch in batches:
        for d, _, flat in _vectors(batch):
            u = _unit(flat, d)
            total[d] = total.get(d, 0) + u.T @ u
    for d, s in total.items():
        i, j = np.triu_indices(d)
        yield pa.RecordBatch.from_arrays([pa.array(np.full(len(i), d, np.int32)), pa.array(i.astype(np.int32)),
                                          pa.array(j.astype(np.int32)), pa.array(s[i, j])], names=["d", "i", "j", "s"])


def _axes(vectors: DataFrame, many: int) -> dict[int, np.ndarray]:
    """Leading principal dimensions (columns) for each vector length."""
    sums = (vectors.select("x").mapInArrow(_products, "d int, i int, j int, s double")
            .groupBy("d", "i", "j").agg(F.sum("s").alias("s")).toPandas())
    out = {}
    for d, part in sums.groupby("d"):
        full = np.zeros((d, d))
        full[part["i"], part["j"]] = full[part["j"], part["i"]] = part["s"]
        out[int(d)] = np.linalg.eigh(full)[1][:, ::-1][:, :many]
    return out


def _cells(axes: dict[int, np.ndarray], eps: float, many: int):
    def run(batches):
        for batch in batches:
            cells = np.zeros((batch.num_rows, many), dtype=np.int32)
            for d, rows, flat in _vectors(batch):
                p = _unit(flat, d) @ axes[d]
                cells[rows, :p.shape[1]] = np.floor(p / eps)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, *[pa.array(cells[:, g]) for g in range(many)]],
                names=[*batch.schema.names, *[f"c{g}" for g in range(many)]])

    return run


def _blocks(axes: dict[int, np.ndarray], many: int, label_type: pa.DataType):
    """Sorted rows to blocks of one label and length."""

    def pack(b, label, d, k, j, m, x):
        flat = np.concatenate(x)
        p = _unit(flat, d) @ axes[d]
        pad = np.zeros(many - p.shape[1])
        return {"b": b, "label": label, "d": d, "lo": np.r_[p.min(axis=0), pad].tolist(), "hi": np.r_[p.max(axis=0), pad].tolist(),
                "k": np.array(k, "<i8").tobytes(), "j": np.array(j, "<i8").tobytes(), "m": np.array(m, "<i8").tobytes(),
                "x": flat.astype("<f8").tobytes()}

    schema = pa.schema([("b", pa.int64()), ("label", label_type), ("d", pa.int32()), ("lo", pa.list_(pa.float64())),
                        ("hi", pa.list_(pa.float64())), ("k", pa.binary()), ("j", pa.binary()), ("m", pa.binary()), ("x", pa.binary())])

    def run(batches):
        number = TaskContext.get().partitionId() << 32
        last, held = None, [[], [], [], []]
        for batch in batches:
            done = []
            vectors = batch.column("x")
            for label, k, j, m, x in zip(*(batch.column(n).to_pylist() for n in ("label", "k", "j", "m")), vectors, strict=True):
                x = x.values.to_numpy(zero_copy_only=False)
                if held[0] and ((label, len(x)) != last or len(held[0]) == BLOCK):
                    done.append(pack(number, *last, *held))
                    number, held = number + 1, [[], [], [], []]
                last = label, len(x)
                for part, value in zip(held, (k, j, m, x), strict=True):
                    part.append(value)
            if done:
                yield pa.RecordBatch.from_pylist(done, schema)
        if held[0]:
            yield pa.RecordBatch.from_pylist([pack(number, *last, *held)], schema)

    return run


def interval_join(u: np.ndarray, p: np.ndarray, v: np.ndarray, q: np.ndarray, eps: float, min_cosine: float,
                  same: bool) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs of linked rows of ``u`` and ``v`` (unit vectors with projections ``p``, ``q``);
    for one and the same block each pair once."""
    left, right = [], []

    def join(a, b, e, f):
        if same and e < a:
            return
        gap = np.maximum(p[a:b].min(axis=0) - q[e:f].max(axis=0), q[e:f].min(axis=0) - p[a:b].max(axis=0))
        if (gap > eps).any():
            return
        if b - a <= LEAF and f - e <= LEAF:
            i, j = np.nonzero(u[a:b] @ v[e:f].T >= min_cosine)
            if same and a == e:
                i, j = i[i < j], j[i < j]
            left.append(i + a)
            right.append(j + e)
            return
        # Both are cut at the same places, so that "same" stays a triangle.
        for x, y in ((a, (a + b) // 2), ((a + b) // 2, b)) if b - a > LEAF else ((a, b),):
            for z, w in ((e, (e + f) // 2), ((e + f) // 2, f)) if f - e > LEAF else ((e, f),):
                join(x, y, z, w)

    join(0, len(u), 0, len(v))
    return np.concatenate(left or [np.empty(0, int)]), np.concatenate(right or [np.empty(0, int)])


def _join(axes: dict[int, np.ndarray], eps: float, min_cosine: float):
    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                d, same = row["d"], row["b"] == row["b2"]
                read = lambda name, kind="<i8": np.frombuffer(row[name], kind)  # noqa: B023, E731
                u = _unit(read("x", "<f8"), d)
                v = u if same else _unit(read("x2", "<f8"), d)
                i, j = interval_join(u, u @ axes[d], v, v @ axes[d], eps, min_cosine, same)
                if not len(i):
                    continue
                own = {n: read(n) for n in ("k", "j", "m")}
                if same:
                    both, i2, j2 = own, i, j
                else:
                    both = {n: np.concatenate([own[n], read(f"{n}2")]) for n in own}
                    i2, j2 = i, j + len(u)
                n = len(both["k"])
                links = (np.bincount(i2, both["m"][j2], n) + np.bincount(j2, both["m"][i2], n)).astype(np.int64)
                root = local_roots(n, i2, j2)
                has, tree = np.flatnonzero(links), np.flatnonzero(root != np.arange(n))
                none = np.zeros(len(has), dtype=np.int64)
                k, jj = both["k"], both["j"]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.r_[none > 0, np.full(len(tree), True)]), pa.array(np.r_[k[has], k[tree]]),
                     pa.array(np.r_[jj[has], jj[tree]]), pa.array(np.r_[none, k[root[tree]]]),
                     pa.array(np.r_[none, jj[root[tree]]]), pa.array(np.r_[links[has], np.zeros(len(tree), np.int64)])],
                    names=["edge", "k", "j", "k2", "j2", "n"])

    return run


def embedding_dedup(vectors: DataFrame, min_cosine: float = 0.98, id_col: str = "vec_id", vector_col: str = "embedding",
                    label_col: str = "label", axes: int = AXES) -> DataFrame:
    """One row per row of ``vectors``: id, ``n_links``, ``component_id``, ``kept``."""
    eps = float(np.sqrt(2 - 2 * min_cosine)) + 1e-9
    # Adding 0.0 makes -0.0 equal to 0.0 everywhere.
    x = F.transform(F.col(vector_col), lambda v: v.cast("double") + F.lit(0.0))
    rows = vectors.select(F.col(id_col).alias("id"), F.col(label_col).alias("label"), x.alias("x"))
    fine = (F.col("label").isNotNull() & F.coalesce(
        F.forall("x", lambda v: v.isNotNull() & (F.abs(v) <= 1.7976931348623157e308)) & F.exists("x", lambda v: v != 0), F.lit(False)))
    rows = rows.select("id", F.when(fine, F.col("label")).alias("label"), F.when(fine, F.col("x")).alias("x"))
    rows = rows.select("id", "label", "x", F.xxhash64("label", "x").alias("k"), F.xxhash64("x", "label", F.lit(1)).alias("j"))
    good = rows.filter("x IS NOT NULL")
    classes = c.stage(good.groupBy("label", "x", "k", "j").agg(F.count("*").alias("m"), F.min("id").alias("low")), "classes")

    basis = _axes(classes, axes)
    kind = classes.schema["label"].dataType.simpleString()
    cells = [f"c{g}" for g in range(axes)]
    placed = classes.select("label", "x", "k", "j", "m").mapInArrow(
        _cells(basis, eps, axes), f"label {kind}, x array<double>, k long, j long, m long, " + ", ".join(f"{g} int" for g in cells))
    order = ["label", F.size("x"), *cells, "k", "j"]
    arrow_label = vectors.select(label_col).limit(0).toArrow().schema.field(0).type
    blocks = c.stage(placed.repartitionByRange(*order).sortWithinPartitions(*order).select("label", "x", "k", "j", "m")
                     .mapInArrow(_blocks(basis, axes, arrow_label), BOXES.format(label=kind)), "blocks")

    box = blocks.select("b", "label", "d", "lo", "hi")
    span = lambda g, more: F.explode(F.sequence(
        (F.floor(F.col("lo")[g] / eps) - more).cast("int"), (F.floor(F.col("hi")[g] / eps) + more).cast("int")))
    near = box.withColumn("c0", span(0, 1)).withColumn("c1", span(1, 1))
    home = box.withColumn("c0", span(0, 0)).withColumn("c1", span(1, 0)).select(
        "label", "d", "c0", "c1", F.col("b").alias("b2"), F.col("lo").alias("lo2"), F.col("hi").alias("hi2"))
    apart = F.exists(F.sequence(F.lit(0), F.lit(axes - 1)), lambda g: F.greatest(
        F.get("lo", g) - F.get("hi2", g), F.get("lo2", g) - F.get("hi", g)) > eps)
    pairs = (near.join(home, ["label", "d", "c0", "c1"]).filter("b <= b2").filter(~apart)
             .select("b", "b2").distinct())
    second = blocks.select(*[F.col(n).alias(f"{n}2") for n in ("b", "k", "j", "m", "x")])
    # A row holds up to BLOCK vectors, so few rows are dealt to each task.
    met = pairs.join(blocks.select("b", "d", "k", "j", "m", "x"), "b").join(second, "b2")
    found = c.stage(met.mapInArrow(_join(basis, eps, min_cosine), FOUND), "links")

    name = lambda k, j: F.concat_ws("_", k, j)
    edges = found.filter("edge").select(name("k", "j").alias("u"), name("k2", "j2").alias("v"))
    links = found.filter("NOT edge").groupBy("k", "j").agg(F.sum("n").alias("n"))
    known = (classes.select("k", "j", "m", "low", name("k", "j").alias("node"))
             .join(links, ["k", "j"], "left").join(components(edges), "node", "left")
             .select("k", "j", (F.col("m") - 1 + F.coalesce("n", F.lit(0))).alias("n_links"),
                     F.coalesce("root", "node").alias("root"), "low"))
    low = known.groupBy("root").agg(F.min("low").alias("component_id"))
    known = known.join(low, "root").select("k", "j", "n_links", "component_id")
    # Rows without a class stay out of the join: they share one key.
    linked = good.select("id", "k", "j").join(known, ["k", "j"]).select("id", "n_links", "component_id")
    alone = rows.filter("x IS NULL").select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"))
    return linked.unionByName(alone).select(
        F.col("id").alias(id_col), "n_links", "component_id", F.col("id").eqNullSafe(F.col("component_id")).alias("kept"))


def op8_embedding_dedup(spark, sf_dir: str) -> DataFrame:
    """Links at cosine 0.98 over every row of ``embeddings``."""
    return embedding_dedup(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
