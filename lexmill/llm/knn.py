"""Exact top-k inner-product search as a Voronoi kNN join.

Pivots (a bounded sample of the data vectors: one for ``PIVOT_ROWS`` rows, 64 to 2,048 of them) cut the data into Voronoi cells.  A cell's summary is its
radius and its ``k + 1`` smallest distances to the pivot.  For a query q and a vector x of cell p,
``q.p - |q| d(x, p) <= q.x <= q.p + |q| d(x, p)``: the summaries of all cells give a score that at least k others
reach, and only cells whose upper bound reaches that score can hold a neighbour.  Queries are copied to those cells
only, cells are cut into blocks of bounded size, each block is solved locally with integer-valued arithmetic, and the
blocks' best k of each query are merged.

Defined results: vectors that are null, empty, or hold null or non-finite components take no part, and vectors of
other lengths than the query's don't meet it; ties go to the smaller id; where ids repeat, every query row is asked on its own and
only its own row is no candidate (of equal rows with one id, one); columns other than ``id`` and ``v`` are ignored; an
empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import Scratch
from .vectors import matrix, pick, usable

BLOCK_ROWS = 8192
PIVOT_ROWS = 20_000


def _scores(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Exact integer inner products: BLAS while every partial sum stays below 2^53, else 64-bit integers."""
    top = float(np.abs(q).max(initial=0)) * float(np.abs(x).max(initial=0)) * max(1, q.shape[1])
    if top < 2.0**53:
        return (q @ x.T).astype(np.int64)
    return q.astype(np.int64) @ x.astype(np.int64).T


def best(q_ids, q, q_twin, x_ids, x, x_twin, k):
    """Best k of x for each row of q, ties to the smaller id, own row left out -> (place in q, id, score) arrays."""
    s = _scores(q, x)
    for i, j in zip(*np.nonzero((q_ids[:, None] == x_ids[None, :]) & (q_twin[:, None] == x_twin[None, :])), strict=True):
        if x_twin[j] < 0 or (q[i] == x[j]).all():
            s[i, j] = np.iinfo(np.int64).min
    n = s.shape[1]
    rows, cols = [], []
    kth = np.partition(s, n - k, axis=1)[:, n - k] if n > k else np.full(len(s), np.iinfo(np.int64).min + 1)
    kth = np.maximum(kth, np.iinfo(np.int64).min + 1)
    for i in range(len(s)):
        c = np.flatnonzero(s[i] >= kth[i])
        if len(c) > k:
            c = c[np.lexsort((x_ids[c], -s[i][c]))[:k]]
        rows.append(np.full(len(c), i))
        cols.append(c)
    r, c = (np.concatenate(v) if v else np.zeros(0, int) for v in (rows, cols))
    return r, x_ids[c], s[r, c]


def voronoi_knn(spark: SparkSession, data: DataFrame, queries: DataFrame, k: int = 10, pivots: int | None = None) -> DataFrame:
    """data, queries: (``id`` long, ``v`` array<double>) with integer-valued components -> query_id, rank, vec_id, score."""
    scratch = Scratch(spark, "knn")
    data = data.where(usable(F.col("v"))).select("id", "v")
    queries = queries.where(usable(F.col("v"))).select("id", "v")
    counted = data.groupBy("id").agg(F.count("*").alias("n")).agg(F.sum("n"), F.max("n")).first()
    if (counted[1] or 0) > 1:  # repeated ids: equal rows are told apart by number
        of_row = Window.partitionBy("id", "v").orderBy(F.lit(1))
        data = data.withColumn("twin", F.row_number().over(of_row))
        queries = queries.withColumn("twin", F.row_number().over(of_row))
    else:
        data, queries = data.withColumn("twin", F.lit(-1)), queries.withColumn("twin", F.lit(-1))
    # every query row has a number of its own
    queries = scratch.keep(queries.withColumn("ask", F.monotonically_increasing_id()), "queries")
    sample = pick(data, "id", "v", pivots or min(2048, max(64, (counted[0] or 0) // PIVOT_ROWS)))
    centres: dict[int, np.ndarray] = {}
    for v in sample:
        centres.setdefault(len(v), []).append(v)
    centres = {d: np.unique(np.array(v, np.float64), axis=0) for d, v in centres.items()}
    empty = spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    if not centres:
        return empty

    def assign(batches):
        for b in batches:
            sizes = np.diff(b.column(1).offsets.to_numpy())
            for d in np.unique(sizes):
                part = b.filter(pa.array(sizes == d))
                x = matrix(part.column(1))
                if d in centres:
                    p = centres[d]
                    d2 = (x * x).sum(1)[:, None] - 2 * x @ p.T + (p * p).sum(1)
                    cell = d2.argmin(1)
                    dist = np.sqrt(((x - p[cell]) ** 2).sum(1))
                else:  # no pivot of this length: one cell about the origin
                    cell, dist = np.full(len(x), -1), np.sqrt((x * x).sum(1))
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), part.column(2), pa.array(np.full(len(x), d), pa.int32()), pa.array(cell, pa.int32()), pa.array(dist, pa.float64())], ["id", "v", "twin", "dim", "cell", "dist"])

    celled = scratch.keep(data.select("id", "v", "twin").mapInArrow(assign, "id long, v array<double>, twin int, dim int, cell int, dist double"), "cells")
    # per cell: rows, radius, and the k+1 least distances (merged from bounded partial lists)
    salt = F.pmod(F.xxhash64("id"), F.lit(64))
    first = Window.partitionBy("dim", "cell", "salt").orderBy("dist", "id")
    near = celled.select("dim", "cell", "dist", "id", salt.alias("salt")).withColumn("r", F.row_number().over(first)).where(F.col("r") <= k + 1)
    near = near.groupBy("dim", "cell").agg(F.slice(F.sort_array(F.collect_list("dist")), 1, k + 1).alias("near"))
    stats = celled.groupBy("dim", "cell").agg(F.count("*").alias("n"), F.max("dist").alias("radius")).join(near, ["dim", "cell"])
    summary = {}
    for r in stats.collect():  # at most one row for each pivot, and one for each other vector length
        summary.setdefault(r["dim"], []).append((r["cell"], r["n"], r["radius"], r["near"]))

    widest = max((len(v) for v in summary.values()), default=1) * (k + 1)
    at_once = max(16, (1 << 21) // widest)  # queries whose bounds a task holds at a time

    def spread(batches):
        for b in (whole.slice(i, at_once) for whole in batches for i in range(0, whole.num_rows, at_once)):
            sizes = np.diff(b.column(1).offsets.to_numpy())
            for d in np.unique(sizes):
                if d not in summary:
                    continue
                part = b.filter(pa.array(sizes == d))
                q = matrix(part.column(1))
                cells = np.array([c[0] for c in summary[d]])
                p = np.array([centres[d][c] if c >= 0 else np.zeros(d) for c in cells])
                radius = np.array([c[2] for c in summary[d]])
                size = np.sqrt((q * q).sum(1))[:, None]
                at = q @ p.T
                slack = 1e-6 * (1 + np.abs(at)) + 1e-9 * size * radius
                upper = at + size * radius + slack
                owner = np.concatenate([np.full(len(c[3]), i) for i, c in enumerate(summary[d])])
                lows = at[:, owner] - size * np.concatenate([c[3] for c in summary[d]])[None, :] - slack[:, owner]
                if lows.shape[1] > k + 1:  # one of them may be the query's own row
                    floor = np.partition(lows, lows.shape[1] - k - 1, axis=1)[:, lows.shape[1] - k - 1]
                else:
                    floor = np.full(len(q), -np.inf)
                i, j = np.nonzero(upper >= floor[:, None])
                take = part.take(pa.array(i))
                yield pa.RecordBatch.from_arrays([*take.columns, pa.array(np.full(len(i), d), pa.int32()), pa.array(cells[j], pa.int32())], ["id", "v", "twin", "ask", "dim", "cell"])

    # as many rows as cells
    blocks = spark.createDataFrame([(int(d), int(c[0]), -(-c[1] // BLOCK_ROWS)) for d, v in summary.items() for c in v], "dim int, cell int, blocks int")
    asked = queries.select("id", "v", "twin", "ask").mapInArrow(spread, "id long, v array<double>, twin int, ask long, dim int, cell int")
    asked = asked.join(F.broadcast(blocks), ["dim", "cell"]).withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).drop("blocks")
    held = celled.select("id", "v", "twin", "dim", "cell").join(F.broadcast(blocks), ["dim", "cell"])
    held = held.select("id", "v", "twin", "dim", "cell", F.pmod(F.xxhash64("id", "twin"), "blocks").cast("int").alias("block"))

    def solve(left: pa.Table, right: pa.Table) -> pa.Table:
        names = ["ask", "query_id", "vec_id", "score"]
        out = [np.zeros(0, np.int64)] * 4
        if left.num_rows and right.num_rows:
            x, x_ids, x_twin = matrix(left.column("v")), left.column("id").to_numpy(), left.column("twin").to_numpy()
            q, q_ids, q_twin, ask = matrix(right.column("v")), *(right.column(c).to_numpy() for c in ("id", "twin", "ask"))
            parts = []
            for i in range(0, len(q), 256):
                at, ids, score = best(q_ids[i : i + 256], q[i : i + 256], q_twin[i : i + 256], x_ids, x, x_twin, k)
                parts.append((ask[i + at], q_ids[i + at], ids, score))
            out = [np.concatenate(p) for p in zip(*parts, strict=True)]
        return pa.table([pa.array(o, pa.int64()) for o in out], names=names)

    keys = ["dim", "cell", "block"]
    local = held.groupBy(*keys).cogroup(asked.groupBy(*keys)).applyInArrow(solve, "ask long, query_id long, vec_id long, score long")
    order = Window.partitionBy("ask").orderBy(F.desc("score"), "vec_id")
    return local.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
