"""Token-id files in Simple-8b word-aligned coding.

Format: a folder of Parquet files whose rows are segments.  A segment holds whole documents in ascending
doc_id order: ``doc_ids``, ``counts`` (ids per document, end id included), ``base`` (ids of the shard before it),
``words`` (little-endian 64-bit words), ``block_words`` (little-endian uint32: first word of each block of ``BLOCK``
ids, so any block decodes alone) and ``literals`` (ids of 2^60 and over).  A word is a 4-bit selector over 60
payload bits; selectors 1-14 hold 1 to 60 ids of 60 to 1 bits, lowest bits first; selector 0 is the escape, its
payload is an index into ``literals``.  Shards are range partitions of doc_id, numbered in order.

Defined results: a null or empty text is the end id alone; rows without doc_id come first; repeated rows are
repeated documents (equal doc_ids ordered by a hash of their text); a very long text is one document of one segment, so a row
holds its ids at least; columns other than doc_id and text are ignored; an empty table writes no segment.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import shuffle_partitions
from .vocab import encoder

#: Fixed values of the coding: ids per word for each selector; 60 // count bits each.
COUNTS = np.array([1, 1, 2, 3, 4, 5, 6, 7, 8, 10, 12, 15, 20, 30, 60], dtype=np.int64)
BLOCK = 256
SEGMENT_IDS = 1 << 19

_U = np.uint64


def encode(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """ids (unsigned 64-bit) -> words, first word of each block, literals."""
    ids = np.ascontiguousarray(ids, dtype=np.uint64)
    n = len(ids)
    if not n:
        return np.zeros(0, np.uint64), np.zeros(0, np.uint32), np.zeros(0, np.uint64)
    need = np.zeros(n, np.uint8)
    for shift in (32, 16, 8, 4, 2, 1):  # bit lengths
        big = (ids >> need.astype(np.uint64)) >= (_U(1) << _U(shift))
        need += (big * np.uint8(shift)).astype(np.uint8)
    need += (ids > 0).astype(np.uint8)
    left = np.minimum(BLOCK - np.arange(n) % BLOCK, n - np.arange(n))
    choice = np.where(need <= 60, 1, 0).astype(np.uint8)
    widest = need.copy()
    sel = 2
    for c in range(2, 61):
        m = n - c + 1
        if m <= 0:
            break
        np.maximum(widest[:m], need[c - 1 :], out=widest[:m])
        if c == COUNTS[sel]:
            fits = (widest[:m] <= 60 // c) & (left[:m] >= c)
            choice[:m][fits] = sel
            sel += 1
    at = np.arange(0, n, BLOCK)
    ends = np.minimum(at + BLOCK, n)
    found = []
    while len(at):  # all blocks step together
        found.append(at)
        at = at + COUNTS[choice[at]]
        going = at < ends
        at, ends = at[going], ends[going]
    starts = np.sort(np.concatenate(found))
    chosen = choice[starts]
    words = chosen.astype(np.uint64) << _U(60)
    literals = ids[starts[chosen == 0]]
    words[chosen == 0] |= np.arange(len(literals), dtype=np.uint64)
    for s in range(1, 15):
        here = np.flatnonzero(chosen == s)
        if len(here):
            c = int(COUNTS[s])
            part = ids[starts[here][:, None] + np.arange(c)] << (np.arange(c, dtype=np.uint64) * _U(60 // c))
            words[here] |= np.bitwise_or.reduce(part, axis=1)
    blocks = np.searchsorted(starts, np.arange(0, n, BLOCK)).astype(np.uint32)
    return words, blocks, literals


def decode(words: np.ndarray, literals: np.ndarray) -> np.ndarray:
    """Any run of words back to ids; slice ``words`` by the block offsets to decode blocks alone."""
    chosen = (words >> _U(60)).astype(np.int64)
    counts = COUNTS[chosen]
    ends = np.cumsum(counts)
    out = np.empty(int(ends[-1]) if len(ends) else 0, np.uint64)
    starts = ends - counts
    payload = words & _U((1 << 60) - 1)
    for s in range(15):
        here = np.flatnonzero(chosen == s)
        if not len(here):
            continue
        if s == 0:
            out[starts[here]] = literals[payload[here].astype(np.int64)]
            continue
        c = int(COUNTS[s])
        bits = 60 // c
        part = (payload[here][:, None] >> (np.arange(c, dtype=np.uint64) * _U(bits))) & _U((1 << bits) - 1)
        out[starts[here][:, None] + np.arange(c)] = part
    return out


SEGMENT = "shard int, segment int, base long, n_ids long, doc_ids array<long>, counts array<long>, words binary, block_words binary, literals binary"


def write_token_files(docs: DataFrame, path: str, tokenizer: str, kind: str = "word", end_id: int = 1, shards: int | None = None) -> None:
    """Encode every document, end it with ``end_id`` and write the files in ascending doc_id order."""
    spark = docs.sparkSession
    end = end_id.to_bytes(4, "little")

    def build(batches):
        from pyspark import TaskContext

        enc = encoder(tokenizer, kind)
        shard = TaskContext.get().partitionId()
        state = {"segment": 0, "base": 0}
        docs_, parts, size = [], [], 0

        def flush():
            ids = np.frombuffer(b"".join(parts), dtype="<u4")
            words, blocks, literals = encode(ids)
            row = [shard, state["segment"], state["base"], len(ids), list(docs_), [len(p) // 4 for p in parts], words.astype("<u8").tobytes(), blocks.astype("<u4").tobytes(), literals.astype("<u8").tobytes()]
            types = [pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.binary(), pa.binary(), pa.binary()]
            names = ["shard", "segment", "base", "n_ids", "doc_ids", "counts", "words", "block_words", "literals"]
            state["segment"] += 1
            state["base"] += len(ids)
            return pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in zip(row, types, strict=True)], names)

        for batch in batches:
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                ids = enc.ids(text.as_py()) + end
                docs_.append(doc)
                parts.append(ids)
                size += len(ids) // 4
                if size >= SEGMENT_IDS:
                    yield flush()
                    docs_, parts, size = [], [], 0
        if parts:
            yield flush()

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    ordered = rows.repartitionByRange(shards or shuffle_partitions(spark), "doc_id").sortWithinPartitions("doc_id", F.xxhash64("text"))
    ordered.mapInArrow(build, SEGMENT).write.parquet(path)


def read_token_files(spark: SparkSession, path: str, with_ids: bool = False) -> DataFrame:
    """Documents of the files: doc_id, start (ids of all documents before it), n_tokens, ids_crc32
    and, if asked for, ``ids`` as little-endian unsigned 32-bit integers."""
    segments = spark.read.schema(SEGMENT).parquet(path)
    totals = segments.groupBy("shard").agg(F.sum("n_ids").alias("n"))  # one row for each shard
    ahead = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    first = totals.select("shard", F.coalesce(F.sum("n").over(ahead), F.lit(0)).alias("shard_base"))
    rows = segments.join(F.broadcast(first), "shard").select((F.col("shard_base") + F.col("base")).alias("start"), "doc_ids", "counts", "words", "literals")
    schema = "doc_id long, start long, n_tokens long, ids_crc32 long" + (", ids binary" if with_ids else "")

    def unpack(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                start, doc_ids, counts, words, literals = (batch.column(k)[i].as_py() for k in range(5))
                ids = decode(np.frombuffer(words, "<u8").astype(np.uint64), np.frombuffer(literals, "<u8").astype(np.uint64)).astype("<u4").tobytes()
                ends = np.cumsum(np.array(counts, np.int64))
                blobs = [ids[4 * (e - c) : 4 * e] for e, c in zip(ends.tolist(), counts, strict=True)]
                cols = [pa.array(doc_ids, pa.int64()), pa.array(start + ends - np.array(counts, np.int64)), pa.array(counts, pa.int64()), pa.array([zlib.crc32(b) for b in blobs], pa.int64())]
                names = ["doc_id", "start", "n_tokens", "ids_crc32"]
                if with_ids:
                    cols.append(pa.array(blobs, pa.binary()))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(cols, names)

    return rows.mapInArrow(unpack, schema)
