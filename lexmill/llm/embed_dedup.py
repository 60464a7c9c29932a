"""Embedding near-duplicates by an epsilon grid order join.

Unit vectors with cosine >= t lie within ``eps = sqrt(2 - 2t)``.  Equal vectors of a label collapse first.  The
rest is rotated to its leading principal directions (second moments summed over all distinct vectors), laid on a grid of cell
width eps, and sorted by label and cell: the epsilon grid order.  The sorted sequence is cut into intervals; interval
summaries (bounding boxes in the leading directions) meet in an equi-join on label and the cells of two directions, and pairs of
intervals that are provably more than eps apart are skipped.  A pair of intervals is joined recursively:
halves whose boxes are too far apart are dropped, small ones are compared exactly in double precision.  A task
returns link counts and a spanning forest of what it linked, never its pairs, so the output stays linear.

Defined results: vectors that are null, empty, zero, or hold null or non-finite components, and rows without a
label, link with nothing; vectors of different lengths don't link; repeated vec_ids are one row each, joined with
each other only if their vectors link (component ids are vec_ids); columns other than vec_id, embedding and label are
ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import Scratch, components, shuffle_partitions
from .vectors import matrix, usable

DIRECTIONS = 6
INTERVAL_ROWS = 2048
SMALL = 128


def unit(x: np.ndarray) -> np.ndarray:
    return x / np.sqrt((x * x).sum(1))[:, None]


def forest(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Root (least index) of each of n nodes under links a-b."""
    root = np.arange(n)
    while len(a):
        low = np.minimum(root[a], root[b])
        before = root.copy()
        np.minimum.at(root, root[a], low)
        np.minimum.at(root, root[b], low)
        while True:
            up = root[root]
            if (up == root).all():
                break
            root = up
        if (root == before).all():
            break
    return root


def _apart(a: np.ndarray, b: np.ndarray) -> float:
    """Squared distance of two bounding boxes."""
    gap = np.maximum(0, np.maximum(a.min(0) - b.max(0), b.min(0) - a.max(0)))
    return float((gap * gap).sum())


def grid_join(u, y, v, z, t, eps2, same, found):
    """Links between sequence intervals (unit vectors u, v with leading coordinates y, z) -> index pairs in ``found``."""
    stack = [(0, len(u), 0, len(v))]
    while stack:
        a0, a1, b0, b1 = stack.pop()
        if same and b1 <= a0:
            continue
        if _apart(y[a0:a1], z[b0:b1]) > eps2:
            continue
        if a1 - a0 <= SMALL and b1 - b0 <= SMALL:
            i, j = np.nonzero(u[a0:a1] @ v[b0:b1].T >= t)
            i, j = i + a0, j + b0
            if same:
                keep = i < j
                i, j = i[keep], j[keep]
            if len(i):
                found.append((i, j))
            continue
        am, bm = (a0 + a1 + 1) // 2, (b0 + b1 + 1) // 2
        for p in ((a0, am), (am, a1)) if a1 - a0 > SMALL else ((a0, a1),):
            for q in ((b0, bm), (bm, b1)) if b1 - b0 > SMALL else ((b0, b1),):
                if p[0] < p[1] and q[0] < q[1] and not (same and q[1] <= p[0]):
                    stack.append((*p, *q))


def embedding_dedup(spark: SparkSession, vectors: DataFrame, threshold: float = 0.98) -> DataFrame:
    """vectors: (vec_id long, embedding array, label) -> vec_id, n_links, component_id, kept."""
    scratch = Scratch(spark, "egrid")
    eps2 = (2 - 2 * threshold) * (1 + 1e-9) + 1e-12
    eps = eps2**0.5
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("v"), F.col("label").cast("string").alias("label"))
    good = rows.where(usable(F.col("v")) & F.col("label").isNotNull() & F.exists("v", lambda x: x != 0))
    members = scratch.keep(good.withColumn("key", F.xxhash64("v")).select("vec_id", "v", "label", F.col("key")), "rows")
    # equal vectors of a label collapse to a class, which has a number of its own, as vec_ids may repeat
    distinct = members.groupBy("label", "v").agg(F.min("vec_id").alias("least"), F.count("*").alias("copies"))
    distinct = scratch.keep(distinct.withColumns({"id": F.monotonically_increasing_id(), "dim": F.size("v")}), "classes")

    def moments(batches):
        sums: dict[int, np.ndarray] = {}
        for b in batches:
            sizes = b.column(1).to_numpy(zero_copy_only=False)
            for d in np.unique(sizes):
                u = unit(matrix(b.column(0).filter(pa.array(sizes == d))))
                sums[int(d)] = sums.get(int(d), 0) + u.T @ u
        for d, m in sums.items():
            yield pa.RecordBatch.from_arrays([pa.array(np.full(d, d), pa.int32()), pa.array(np.arange(d), pa.int32()), pa.array([x.tobytes() for x in m], pa.binary())], ["dim", "line", "m"])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = 0
        for b in batches:
            total = total + np.frombuffer(b"".join(b.column("m").to_pylist()), np.float64).reshape(b.num_rows, -1).sum(0)
            own = b.slice(0, 1)
        yield pa.RecordBatch.from_arrays([own.column("dim"), own.column("line"), pa.array([total.tobytes()], pa.binary())], ["dim", "line", "m"])

    axes: dict[int, np.ndarray] = {}
    total: dict[int, np.ndarray] = {}
    shape = "dim int, line int, m binary"
    parted = distinct.select("v", "dim").mapInArrow(moments, shape)
    for r in parted.groupBy("dim", "line").applyInArrow(add, shape).collect():  # one matrix for each vector length
        total.setdefault(r["dim"], np.zeros((r["dim"], r["dim"])))[r["line"]] = np.frombuffer(r["m"], np.float64)
    for d, m in total.items():
        axes[d] = np.linalg.eigh(m)[1][:, ::-1][:, : min(DIRECTIONS, d)]

    def place(batches):
        for b in batches:
            sizes = b.column(4).to_numpy(zero_copy_only=False)
            for d in np.unique(sizes):
                part = b.filter(pa.array(sizes == d))
                u = unit(matrix(part.column(1)))
                y = u @ axes[int(d)]
                if y.shape[1] < DIRECTIONS:
                    y = np.hstack([y, np.zeros((len(y), DIRECTIONS - y.shape[1]))])
                cells = np.floor(y / eps).astype(np.int32)
                cols = [part.column(0), part.column(2), part.column(3), part.column(4), pa.array([x.tobytes() for x in u], pa.binary()), pa.array([x.tobytes() for x in y], pa.binary())]
                cols += [pa.array(cells[:, k], pa.int32()) for k in range(DIRECTIONS)]
                yield pa.RecordBatch.from_arrays(cols, ["label", "id", "copies", "dim", "u", "y", *[f"c{k}" for k in range(DIRECTIONS)]])

    cells = [f"c{k}" for k in range(DIRECTIONS)]
    placed = distinct.select("label", "v", "id", "copies", "dim").mapInArrow(place, "label string, id long, copies long, dim int, u binary, y binary, " + ", ".join(f"{c} int" for c in cells))
    order = ["label", "dim", *cells, "id"]
    n = members.count()
    parts = max(1, min(shuffle_partitions(spark) * 4, -(-n // (4 * INTERVAL_ROWS))))
    sequence = placed.repartitionByRange(parts, *order).sortWithinPartitions(*order)
    within = Window.partitionBy("part", "label", "dim").orderBy(*cells, "id")
    sequence = sequence.withColumn("part", F.spark_partition_id())
    sequence = scratch.keep(sequence, "sequence")
    sequence = sequence.withColumn("cut", F.floor((F.row_number().over(within) - 1) / INTERVAL_ROWS).cast("int"))
    sequence = scratch.keep(sequence.withColumn("interval", F.xxhash64("part", "label", "dim", "cut")).drop("part", "cut"), "intervals")
    summary = sequence.groupBy("label", "dim", "interval").agg(*[F.min(c).alias(f"lo_{c}") for c in cells], *[F.max(c).alias(f"hi_{c}") for c in cells])
    left = summary.select("label", "dim", F.col("interval").alias("a"), *[F.col(f"{s}_{c}").alias(f"a{s}_{c}") for c in cells for s in ("lo", "hi")])
    left = left.withColumn("slab", F.explode(F.sequence(F.col("alo_c0") - 1, F.col("ahi_c0") + 1))).withColumn("strip", F.explode(F.sequence(F.col("alo_c1") - 1, F.col("ahi_c1") + 1)))
    right = summary.select("label", "dim", F.col("interval").alias("b"), *[F.col(f"{s}_{c}").alias(f"b{s}_{c}") for c in cells for s in ("lo", "hi")])
    right = right.withColumn("slab", F.explode(F.sequence("blo_c0", "bhi_c0"))).withColumn("strip", F.explode(F.sequence("blo_c1", "bhi_c1")))
    near = F.lit(True)
    for c in cells:  # cells one apart may hold vectors within eps; farther ones can't
        near = near & (F.col(f"alo_{c}") <= F.col(f"bhi_{c}") + 1) & (F.col(f"blo_{c}") <= F.col(f"ahi_{c}") + 1)
    pairs = left.join(right, ["label", "dim", "slab", "strip"]).where((F.col("a") <= F.col("b")) & near).select("a", "b").distinct()
    sides = pairs.select("a", "b", F.explode(F.array("a", "b")).alias("interval")).distinct()
    shipped = sequence.select("interval", "id", "copies", "dim", "u", "y", *cells).join(sides, "interval")

    def solve(table: pa.Table) -> pa.Table:
        table = table.sort_by([*[(c, "ascending") for c in cells], ("id", "ascending")])
        a, b = table.column("a")[0].as_py(), table.column("b")[0].as_py()
        d = table.column("dim")[0].as_py()
        of = table.column("interval").to_numpy()
        ids, copies = table.column("id").to_numpy(), table.column("copies").to_numpy()
        u = np.frombuffer(b"".join(table.column("u").to_pylist()), np.float64).reshape(-1, d)
        y = np.frombuffer(b"".join(table.column("y").to_pylist()), np.float64).reshape(-1, DIRECTIONS)
        ia, ib = np.flatnonzero(of == a), np.flatnonzero(of == b)
        found: list = []
        grid_join(u[ia], y[ia], u[ib], y[ib], threshold, eps2, a == b, found)
        links = np.zeros(len(ids), np.int64)
        root = np.arange(len(ids))
        if found:
            i, j = ia[np.concatenate([f[0] for f in found])], ib[np.concatenate([f[1] for f in found])]
            np.add.at(links, i, copies[j])
            np.add.at(links, j, copies[i])
            root = forest(len(ids), i, j)
        hit = np.flatnonzero(links)
        return pa.table([pa.array(ids[hit]), pa.array(links[hit]), pa.array(ids[root[hit]])], names=["id", "links", "root"])

    linked = scratch.keep(shipped.groupBy("a", "b").applyInArrow(solve, "id long, links long, root long"), "links")
    counts = linked.groupBy("id").agg(F.sum("links").alias("links"))
    comp = components(spark, linked.select(F.col("id").alias("a"), F.col("root").alias("b")), scratch)
    classes = (
        distinct.select("label", "v", "id", "least", "copies")
        .join(counts, "id", "left")
        .join(comp, "id", "left")
        .select("label", "v", "least", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.coalesce("component", "id").alias("component"))
    )
    classes = scratch.keep(classes, "named")
    classes = classes.join(classes.groupBy("component").agg(F.min("least").alias("component_id")), "component")
    classes = classes.select(F.xxhash64("v").alias("key"), "label", "v", "n_links", "component_id")
    joined = members.join(classes, ["key", "label", "v"]).select("vec_id", "n_links", "component_id")
    alone = rows.where(~(usable(F.col("v")) & F.col("label").isNotNull() & F.exists("v", lambda x: x != 0)) | F.col("v").isNull() | F.col("label").isNull())
    alone = alone.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return joined.unionByName(alone).select("vec_id", "n_links", "component_id", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)).alias("kept"))
