"""Best-fit packing of tokenised documents into fixed-length training sequences.

Method: bulk-synchronous best fit.  Documents are cut into pieces of at most ``capacity`` tokens and ranked by one
range sort on (length, hash), so that pieces of one length, full ones above all, spread over many partitions.  Pieces of
equal length and sequences with equal room are interchangeable, so both sorted lists are kept run-length coded: a run
is (width, first rank, count).  Every round range-sorts the runs of pieces and gaps into bands of width and sweeps the
bands side by side in ascending width: each gap is offered to the longest waiting run that fits it (the
successor search seen from the gap), conflicts between pieces that share a successor are settled by rank
(longest first, then lowest rank), matched gaps shrink, and the next round begins.  Pieces of a gap's own band are longer than
those of lower bands, so a carry sweep over what the bands could not place ends with the matches of one long sweep,
however many bands there are.  Sequences are opened only for what no open gap can take.  The last
step is an equi-join of pieces with their run.  Nothing about single documents reaches the driver.

Defined results: a null text is an empty document (its end id alone); repeated rows and repeated doc_ids are
packed as separate documents, in the order of their hashes; null doc_ids are kept; very long texts give as many full pieces as
they need; an empty table gives an empty result; columns other than doc_id and text are ignored.
"""

from __future__ import annotations

import zlib

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import Scratch
from .vocab import encoder

_PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"
#: Bands that a round is swept in, at least.
BANDS = 8


def pieces(docs: DataFrame, tokenizer: str, capacity: int = 1024, end_id: int = 2, with_ids: bool = False) -> DataFrame:
    """Pieces of every document: a short first piece if needed, then pieces of exactly ``capacity`` tokens.

    ``with_ids`` adds the piece's ids as little-endian unsigned 32-bit integers in ``ids``.
    """
    end = end_id.to_bytes(4, "little")
    schema = _PIECES + (", ids binary" if with_ids else "")

    def cut(batches):
        enc = encoder(tokenizer, "byte")
        for batch in batches:
            rows: list[list] = [[], [], [], [], []]
            blobs: list[bytes] = []
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                ids = enc.ids(text.as_py()) + end
                n = len(ids) // 4
                at, k = 0, 0
                while at < n:
                    size = (n % capacity or capacity) if k == 0 else capacity
                    blob = ids[4 * at : 4 * (at + size)]
                    for col, x in zip(rows, (doc, k, at, size, zlib.crc32(blob)), strict=True):
                        col.append(x)
                    if with_ids:
                        blobs.append(blob)
                    at, k = at + size, k + 1
            cols = [pa.array(rows[0], pa.int64()), pa.array(rows[1], pa.int32()), *(pa.array(c, pa.int64()) for c in rows[2:])]
            names = ["doc_id", "piece", "start", "length", "ids_crc32"]
            if with_ids:
                cols.append(pa.array(blobs, pa.binary()))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(cols, names)

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(cut, schema)


def sweep(waiting: list[tuple], gaps: list[tuple]) -> tuple[list[tuple], list[tuple], list[tuple]]:
    """One successor sweep over two run lists.

    waiting: (width, first, count) of pieces; gaps: (room, first_bin, count).  Returns matches
    (width, first, count, room, first_bin, per_bin), what still waits, and the gaps as they are now.
    """
    stack: list[list] = []
    todo = sorted(waiting)
    at = 0
    matches, after = [], []
    for room, first_bin, bins in sorted(gaps):
        while at < len(todo) and todo[at][0] <= room:
            stack.append(list(todo[at]))
            at += 1
        while bins and stack:
            run = stack[-1]
            width, first, count = run
            per = room // width
            used = min(bins, -(-count // per))
            taken = min(count, used * per)
            matches.append((width, first, taken, room, first_bin, per))
            full, rest = divmod(taken, per)
            if full:
                after.append((room - per * width, first_bin, full))
            if rest:
                after.append((room - rest * width, first_bin + full, 1))
            first_bin, bins = first_bin + used, bins - used
            if taken == count:
                stack.pop()
            else:
                run[1], run[2] = first + taken, count - taken
        if bins:
            after.append((room, first_bin, bins))
    return matches, [tuple(r) for r in stack] + todo[at:], [g for g in after if g[0] > 0]


def _open(waiting: list[tuple], gaps: list[tuple], matched: bool, next_bin: int, capacity: int) -> tuple[list[tuple], int]:
    """New empty sequences for what no gap can take: all pieces over half the capacity, else as many as the
    volume that the open gaps can't hold asks for."""
    if not waiting:
        return [], next_bin
    big = sum(c for w, _, c in waiting if 2 * w > capacity)
    least = min(w for w, _, _ in waiting)
    if big:
        n = big
    else:
        volume = sum(w * c for w, _, c in waiting) - sum(r * c for r, _, c in gaps if r >= least)
        n = -(-volume // capacity) if volume > 0 else int(not matched)
    return ([(capacity, next_bin, n)] if n > 0 else []), next_bin + max(0, n)


_RUN = "kind string, width long, first long, count long, room long, bin long, per long"


def _round(state: DataFrame, capacity: int, next_bin: int, bands: int) -> DataFrame:
    """One round over the state rows (kind ``doc`` or ``gap``) -> rows of kind ``match``, ``doc``, ``gap`` or ``next``."""

    def local(batches, last=True):
        waiting, gaps, kept = [], [], []
        for b in batches:
            for r in b.to_pylist():
                if r["kind"] == "doc":
                    waiting.append((r["width"], r["first"], r["count"]))
                elif r["kind"] == "gap":
                    gaps.append((r["width"], r["first"], r["count"]))
                else:
                    kept.append(tuple(r.values()))
        matches, waiting, gaps = sweep(waiting, gaps)
        rows = kept + [("match", w, f, n, room, b0, per) for w, f, n, room, b0, per in matches]
        if last:
            opened, top = _open(waiting, gaps, bool(rows), next_bin, capacity)
            gaps = gaps + opened
            rows.append(("next", top, 0, 0, 0, 0, 0))
        rows += [("doc", *w, 0, 0, 0) for w in waiting] + [("gap", *g, 0, 0, 0) for g in gaps]
        names = ["kind", "width", "first", "count", "room", "bin", "per"]
        yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], pa.string() if i == 0 else pa.int64()) for i in range(7)], names)

    banded = state.repartitionByRange(bands, "width", "first").mapInArrow(lambda it: local(it, False), _RUN)
    return banded.coalesce(1).mapInArrow(local, _RUN)


def pack(spark: SparkSession, cut: DataFrame, capacity: int = 1024, single_sweep_runs: int = 100_000, broadcast_runs: int = 100_000) -> DataFrame:
    """Place pieces (``doc_id``, ``piece``, ``length``, ...) -> the same rows with ``sequence_id`` and ``offset``."""
    scratch = Scratch(spark, "pack")
    own = cut.columns
    # the range sort: hashes cut a length that many pieces share, places in a partition are counted by the ids Spark gives
    cut = scratch.keep(cut.withColumn("__h", F.xxhash64("doc_id", "piece", "ids_crc32")), "pieces")
    order = ["length", "__h"]
    ranged = cut.repartitionByRange(*order).sortWithinPartitions(*order).withColumns({"__p": F.spark_partition_id(), "__i": F.monotonically_increasing_id()})
    ranged = scratch.keep(ranged.drop("__h"), "ranged")
    sizes = ranged.groupBy("__p", "length").agg(F.count("*").alias("n"), F.min("__i").alias("__first"))  # a row for each length and each partition
    sizes = scratch.keep(sizes.coalesce(1), "sizes")
    before = Window.partitionBy("length").orderBy("__p").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("__p", "length", (F.coalesce(F.sum("n").over(before), F.lit(0)) - F.col("__first")).alias("__base"))
    few = sizes.count() <= broadcast_runs
    ranked = ranged.join(F.broadcast(offsets) if few else offsets, ["__p", "length"]).withColumn("rank", F.col("__base") + F.col("__i"))

    none = F.lit(0).cast("long")
    state = sizes.groupBy("length").agg(F.sum("n").alias("n")).select(
        F.lit("doc").alias("kind"), F.col("length").alias("width"), none.alias("first"), F.col("n").alias("count"), none.alias("room"), none.alias("bin"), none.alias("per")
    )
    rounds: list[DataFrame] = []
    next_bin, runs = 0, 0
    while True:
        bands = max(BANDS, -(-runs // single_sweep_runs))
        done = scratch.keep(_round(state, capacity, next_bin, bands), "round")
        rounds.append(done.where("kind = 'match'"))
        facts = done.groupBy("kind").agg(F.count("*").alias("n"), F.max("width").alias("w")).collect()
        facts = {r["kind"]: r for r in facts}
        if "doc" not in facts:
            break
        next_bin = facts["next"]["w"]
        runs = facts["doc"]["n"] + (facts["gap"]["n"] if "gap" in facts else 0)
        state = done.where("kind in ('doc', 'gap')")
    matches = rounds[0]
    for r in rounds[1:]:
        matches = matches.unionByName(r)
    matches = scratch.keep(matches.select("width", "first", "count", "room", "bin", "per").coalesce(1), "matches")
    few = matches.count() <= broadcast_runs  # 48 bytes each
    right = F.broadcast(matches) if few else matches
    placed = ranked.join(right, (F.col("length") == F.col("width")) & (F.col("rank") >= F.col("first")) & (F.col("rank") < F.col("first") + F.col("count")))
    k = F.col("rank") - F.col("first")
    return placed.select(
        *own,
        (F.col("bin") + F.floor(k / F.col("per"))).cast("long").alias("sequence_id"),
        (F.lit(capacity) - F.col("room") + (k % F.col("per")) * F.col("length")).cast("long").alias("offset"),
    )


def best_fit_packing(spark: SparkSession, docs: DataFrame, tokenizer: str, capacity: int = 1024, end_id: int = 2, with_ids: bool = False) -> DataFrame:
    """Tokenise ``docs`` and pack every piece; see the module's text for the method."""
    return pack(spark, pieces(docs, tokenizer, capacity, end_id, with_ids), capacity)
