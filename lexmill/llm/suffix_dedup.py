"""Exact removal of long repeated byte strings with a run-length index.

A byte goes if a string of ``length`` bytes that covers it also starts anywhere else in the corpus.  Steps:

1. Anchors: every window of ``length`` bytes names its least ``gram``-byte hash (the leftmost of equals).  Equal
   windows name equal anchors at equal places, so whatever repeats shares an anchor.  An occurrence of an anchor comes
   with its context, the bytes that some window through it can hold.
2. Anchors met once go.  Equal contexts collapse: where a context repeats as a whole, all its windows repeat.
3. Contexts that are left in an anchor's group are put, group by group, into blocks of bounded size, and a block gets a
   run-length index: the Burrows-Wheeler transform of its contexts, kept as runs with the text positions at both
   ends of every run.  Inside a run, a suffix and the one before it match one byte further than their
   successors do, so the matching statistics of all positions stream out of the run ends: at position i they are
   those of the nearest sampled position j <= i, less i - j.  Matches long enough to hold a window mark its bytes.
   The bytes that all members of a group share (the anchor, and more after a split) are one symbol in the index.
4. Groups too large for a block are split by window place: the lower and the upper half of the places share
   more bytes, so each half falls apart by those bytes, equal contexts collapse again, and what is left is
   indexed.  After at most nine splits a group is a single window place, whose members are equal windows.

With ``words``, passages of that many words that repeat go, too, whatever their bytes: the same index is built over texts whose
symbols are words instead of bytes, each a code of six bytes.  Words are those of ``shingles`` (A-Z lower-cased, any
white space between them).

Defined results: a null text is empty: nothing removed; repeated rows are each other's copies, so their windows are
all removed, and so are those of repeated doc_ids, each row on its own; texts shorter than ``length`` stay whole;
texts of any length are judged whole; columns of the input named like ours pass through untouched, but for n_removed, which is
written anew; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Scratch, shuffle_partitions
from .shingles import _SPACE, buffers, chunks, mix, units

_U = np.uint64
GRAM = 24
#: Parts of the window places that contexts are grouped by.
PARTS = 4
#: Most bytes, and most words, of flanks that one index holds.
INDEX_BYTES, INDEX_WORDS = 3 << 20, 1 << 20
#: Bytes of texts whose anchors a task holds at a time.
TEXT_BYTES = 4 << 20
#: Texts whose flanks a task holds at a time.
FLANK_ROWS = 500
#: Windows scanned at once in very long texts.
SEGMENT = 1 << 22
#: Bytes of a word's code, and words of an anchor.
CODE, GRAM_WORDS = 6, 12
#: Low bits of a sort key that hold the place (texts below 2 GB).
_PLACES = np.uint64(31)
_BASE = 0x9E3779B97F4A7C55
_INVERSE = pow(_BASE, -1, 1 << 64)
_VALUE = mix(np.arange(1, 257, dtype=np.uint64) * _U(0xD1B54A32D192ED03))


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, _U(base))
    out[:1] = 1
    return np.cumprod(out)


def prefix_hash(b: np.ndarray, powers: np.ndarray) -> np.ndarray:
    out = np.zeros(len(b) + 1, np.uint64)
    np.cumsum((_VALUE[b] if b.dtype == np.uint8 else mix(b)) * powers[: len(b)], out=out[1:])
    return out


def range_hash(prefix: np.ndarray, inverse: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """Hashes of b[lo:hi], lengths mixed in."""
    return mix((prefix[hi] - prefix[lo]) * inverse[lo] + (hi - lo).astype(np.uint64) * _U(0x8CB92BA72F3D8DD7))


def anchors(b: np.ndarray, prefix: np.ndarray, inverse: np.ndarray, length: int, gram: int = GRAM) -> tuple[np.ndarray, np.ndarray]:
    """(positions, gram hashes) of the anchors of one text."""
    if len(b) < length:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    h = mix((prefix[gram:] - prefix[:-gram]) * inverse[: len(b) - gram + 1])
    w = length - gram + 1  # grams in a window
    m = len(h)
    # sliding minimum by block-wise running minima from both sides; the order is (upper hash bits, place), so the
    # leftmost of equals wins
    key = (h >> _PLACES << _PLACES) | np.arange(m, dtype=np.uint64)
    full = np.concatenate([key, np.full(-m % w, ~_U(0))]).reshape(-1, w)
    ahead = np.minimum.accumulate(full, axis=1).ravel()
    back = np.minimum.accumulate(full[:, ::-1], axis=1)[:, ::-1].ravel()
    least = np.minimum(back[: m - w + 1], ahead[w - 1 : m])
    at = least & ((_U(1) << _PLACES) - _U(1))
    at = at[np.concatenate([[True], at[1:] != at[:-1]])].astype(np.int64)
    return at, h[at]


def parts(w: int) -> list[tuple[int, int]]:
    """Places of an anchor in a window (bytes to its left, 0 to w), in equal parts."""
    edges = [w * k // PARTS for k in range(PARTS + 1)]
    return [(edges[k] + (k > 0), edges[k + 1]) for k in range(PARTS)]


def scan(b: np.ndarray, length: int, gram: int, segment: int = SEGMENT):
    """Anchors of one text with their contexts: position, anchor hash, bytes left and right, context hash, and for each
    part of the window places the hash of the bytes that all its windows hold."""
    n, w = len(b), length - gram
    found = []
    for s in range(0, max(1, n - length + 1), segment):
        e = min(n - length + 1, s + segment)
        if e <= s:
            break
        lo, hi = max(0, s - w), min(n, e + length + w)
        part = b[lo:hi]
        powers, inverse = _tables(len(part))
        prefix = prefix_hash(part, powers)
        at, h = anchors_of(part, prefix, inverse, s - lo, e - lo, length, gram)
        left, right = np.minimum(at + lo, w), np.minimum(n - (at + lo) - gram, w)
        ctx = range_hash(prefix, inverse, at - left, at + gram + right)
        ctx = mix(ctx ^ (left.astype(np.uint64) << _U(32)))
        shared = [range_hash(prefix, inverse, np.maximum(at - a, 0), np.minimum(at + gram + w - z, len(part))) for a, z in parts(w)]
        found.append((at + lo, h, left, right, ctx, *shared))
    if not found:
        z = np.zeros(0, np.int64)
        return z, z.astype(np.uint64), z, z, *[z.astype(np.uint64)] * (1 + PARTS)
    out = [np.concatenate(x) for x in zip(*found, strict=True)]
    if len(found) > 1:
        _, one = np.unique(out[0], return_index=True)
        out = [x[one] for x in out]
    return tuple(out)


def anchors_of(part, prefix, inverse, s, e, length, gram):
    """Anchors of the windows that start in [s, e) of a part."""
    at, h = anchors(part[s : e + length - 1], prefix[s : e + length], inverse[s:], length, gram)
    return at + s, h


_READY: list = []


def _tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    if not _READY or len(_READY[0]) < n + 1:
        size = 1 << max(14, int(n + 1).bit_length())
        _READY[:] = [_powers(_BASE, size), _powers(_INVERSE, size)]
    return _READY[0], _READY[1]


def word_codes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(codes of the words, offsets) of a string column."""
    data, offsets = buffers(column)
    codes, sizes = [np.zeros(0, np.uint64)], [np.zeros(1, np.int64)]
    for first, last in chunks(offsets):
        _, _, of, words = units(data, offsets[first : last + 1], lines=False, width=1)
        codes.append(words & _U((1 << 8 * CODE) - 1))
        sizes.append(np.bincount(of, minlength=last - first))
    return np.concatenate(codes), np.cumsum(np.concatenate(sizes))


def packed(symbols: np.ndarray) -> bytes:
    """Bytes as they are, words as codes."""
    return symbols.tobytes() if symbols.dtype == np.uint8 else symbols.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :CODE].tobytes()


def ranked(raw: bytes, size: int) -> tuple[np.ndarray, int]:
    """Symbols of packed bytes as small integers, and a bound of them."""
    b = np.frombuffer(raw, np.uint8)
    if size == 1:
        return b.astype(np.int64), 256
    wide = np.zeros((len(b) // size, 8), np.uint8)
    wide[:, :size] = b.reshape(-1, size)
    found, rank = np.unique(wide.view("<u8").ravel(), return_inverse=True)
    return rank.astype(np.int64), len(found)


def in_bytes(raw: bytes, spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Spans of a text's words in bytes."""
    if not spans:
        return []
    word = np.zeros(len(raw) + 2, np.int8)
    word[1:-1] = ~_SPACE[np.frombuffer(raw, np.uint8)]
    turn = np.diff(word)
    first, end = np.flatnonzero(turn == 1), np.flatnonzero(turn == -1)
    lo, hi = np.array(spans).T
    return list(zip(first[lo].tolist(), end[hi - 1].tolist(), strict=True))


class RunIndex:
    """Run-length Burrows-Wheeler index of a text of small integers whose suffixes all differ."""

    def __init__(self, text: np.ndarray):
        n = len(text)
        self.text, self.n = text, n
        self.levels, self.steps = [text.astype(np.int32)], [1]
        rank, step = text.astype(np.int64), 1
        bits = int(rank.max() + 1).bit_length()
        if n > 4 and 4 * bits <= 62:  # four symbols at once
            key = np.zeros(n + 3, np.int64)
            key[:n] = rank + 1
            key = (((key[:n] << bits | key[1 : n + 1]) << bits | key[2 : n + 2]) << bits) | key[3 : n + 3]
            step = 4
        else:
            key = rank
        # a rank is the place where its suffixes begin in the order, so suffixes that are alone keep theirs and later rounds sort the rest
        order, rank, live = np.arange(n), np.empty(n, np.int64), np.arange(n)
        while True:
            by = np.argsort(key)
            key = key[by]
            moved = order[live][by]
            order[live] = moved
            head = np.ones(len(live), bool)
            np.not_equal(key[1:], key[:-1], out=head[1:])
            rank[moved] = np.maximum.accumulate(np.where(head, live, 0))
            live = live[~(head & np.append(head[1:], True))]
            if not len(live) or step >= n:
                break
            if step > 1:
                self.levels.append(rank.astype(np.int32))
                self.steps.append(step)
            at = order[live]
            ahead = at + step
            key = rank[at] * (n + 1)
            inner = ahead < n
            key[inner] += rank[ahead[inner]] + 1
            step *= 2
        self.suffixes = order
        bwt = text[order - 1]
        edge = np.flatnonzero(bwt[1:] != bwt[:-1]) + 1
        #: ranks of run heads and run tails: all that the matching statistics need
        self.heads, self.tails = np.concatenate([[0], edge]), np.concatenate([edge - 1, [n - 1]])
        self.runs = bwt[self.heads]

    def common(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Longest common prefixes of suffixes i and j."""
        i, j = i.copy(), j.copy()
        out = np.zeros(len(i), np.int64)
        for rank, step in zip(self.levels[::-1], self.steps[::-1], strict=True):
            while True:
                fits = (i < self.n) & (j < self.n)
                same = np.zeros(len(i), bool)
                same[fits] = rank[i[fits]] == rank[j[fits]]
                if not same.any():
                    break
                out[same] += step
                i[same] += step
                j[same] += step
                if step not in (1, self.steps[-1]):
                    break
        return out

    def _stream(self, ranks: np.ndarray, other: np.ndarray) -> np.ndarray:
        """Matches of every text position with a neighbour in suffix order, streamed from sampled ranks."""
        at = self.suffixes[ranks]
        match = np.zeros(len(ranks), np.int64)
        inner = (other >= 0) & (other < self.n)
        match[inner] = self.common(at[inner], self.suffixes[other[inner]])
        values = np.zeros(self.n, np.int64)
        values[at] = match
        sampled = np.zeros(self.n, np.int64)
        sampled[at] = at
        # position 0 has no symbol before it; its run end is always sampled
        last = np.maximum.accumulate(sampled)
        return values[last] - (np.arange(self.n) - last)

    def statistics(self) -> np.ndarray:
        """Longest match of the text at each position with the text at any other position."""
        return np.maximum(self._stream(self.heads, self.heads - 1), self._stream(self.tails, self.tails + 1))


def marked(groups: np.ndarray, lefts: list[bytes], rights: list[bytes], width: np.ndarray, size: int = 1) -> tuple[np.ndarray, np.ndarray]:
    """Repeated windows of contexts (left flank, shared symbol, right flank) within their groups.

    width: flank symbols (of ``size`` bytes) plus the shared one that a window holds.  Returns for each context the least and the
    greatest number of left flank symbols in a repeated window (-1, -1 if none).
    """
    n = len(groups)
    sizes = np.array([(len(a) + len(b)) // size + 2 for a, b in zip(lefts, rights, strict=True)])
    ends = np.cumsum(sizes)
    starts = ends - sizes
    centre = starts + np.array([len(a) // size for a in lefts])
    gap = bytes(size)
    text, bound = ranked(b"".join([a + gap + b + gap for a, b in zip(lefts, rights, strict=True)]), size)
    _, group = np.unique(groups, return_inverse=True)
    text[centre] = bound + group
    text[ends - 1] = bound + n + np.arange(n)
    index = RunIndex(text)
    reach = index.statistics()
    of = np.repeat(np.arange(n), sizes)
    place = np.arange(len(text))
    hit = np.flatnonzero((reach >= width[of]) & (place <= centre[of]) & (place + width[of] > centre[of]))
    least, most = np.full(n, 1 << 40), np.full(n, -1)
    inside = centre[of[hit]] - hit
    np.minimum.at(least, of[hit], inside)
    np.maximum.at(most, of[hit], inside)
    least[most < 0] = -1
    return least, most


def repeated_spans(
    spark: SparkSession, docs: DataFrame, length: int = 400, gram: int = GRAM, most: int = INDEX_BYTES, stream: Callable = buffers, size: int = 1, scratch: Scratch | None = None
) -> DataFrame:
    """docs: (row long unique, text) -> (row, lo, hi): spans of the stream (bytes of the texts, or words) whose union is what
    repeats.  size: bytes of a symbol; most: symbols that one index holds."""
    scratch = scratch or Scratch(spark, "repeats")
    docs = docs.select("row", "text")
    w = length - gram

    def anchor_rows(batches):
        for batch in batches:
            for first, last in chunks(buffers(batch.column(1))[1], TEXT_BYTES):
                data, offsets = stream(batch.column(1).slice(first, last - first))
                outs, owners = [], []
                for i in np.flatnonzero(np.diff(offsets) >= length):
                    got = scan(data[offsets[i] : offsets[i + 1]], length, gram)
                    outs.append(got)
                    owners.append(np.full(len(got[0]), first + i))
                if not outs:
                    continue
                at, h, left, right, ctx, *shared = (np.concatenate(x) for x in zip(*outs, strict=True))
                rows = batch.column(0).take(pa.array(np.concatenate(owners)))
                cols = [pa.array(h.view(np.int64)), rows, pa.array(at, pa.int64()), pa.array(left, pa.int32()), pa.array(right, pa.int32()), pa.array(ctx.view(np.int64))]
                cols += [pa.array(x.view(np.int64), mask=(left < a) | (right < w - b)) for x, (a, b) in zip(shared, parts(w), strict=True)]
                yield pa.RecordBatch.from_arrays(cols, ["h", "row", "pos", "l", "r", "ctx", *keys])

    keys = [f"p{k}" for k in range(PARTS)]
    seen = scratch.keep(docs.mapInArrow(anchor_rows, "h long, row long, pos long, l int, r int, ctx long, " + ", ".join(f"{k} long" for k in keys)), "anchors")
    # minima of plain numbers, so that rows are hashed, not sorted
    one_row, one_pos = F.min("row").alias("one_row"), F.min_by("pos", "row").alias("one_pos")
    contexts = seen.groupBy("h", "ctx").agg(F.count("*").alias("n"), one_row, one_pos, *[F.first(k).alias(k) for k in keys])
    met = seen.groupBy("h").agg(F.count("*").alias("met")).where("met > 1").select("h")
    contexts = scratch.keep(contexts.join(met, "h", "left_semi"), "contexts")
    # contexts that repeat as a whole
    whole = seen.select("h", "ctx", "row", "pos", "l", "r").join(contexts.where("n > 1").select("h", "ctx"), ["h", "ctx"], "left_semi")
    spans = [whole.select("row", (F.col("pos") - F.col("l")).alias("lo"), (F.col("pos") + gram + F.col("r")).alias("hi"))]
    # the others by parts of the window places
    groups = F.array(*[F.when(F.col(k).isNotNull(), F.struct(F.xxhash64("h", k, F.lit(i)).alias("g"), F.lit(a).alias("lo"), F.lit(b).alias("hi"))) for i, (k, (a, b)) in enumerate(zip(keys, parts(w), strict=True))])
    split = contexts.select(F.explode(groups).alias("x"), F.col("one_row").alias("row"), F.col("one_pos").alias("pos"), (F.col("n") == 1).alias("need")).where("x is not null")
    split = split.select(F.col("x.g").alias("g"), F.col("x.lo").alias("a"), F.col("x.hi").alias("b"), "row", "pos", "need")
    live = split.groupBy("g").agg(F.count("*").alias("n"), F.max("need").alias("need")).where("n > 1 and need").select("g")
    split = scratch.keep(split.join(live, "g", "left_semi"), "split")

    by_row = split.groupBy("row").agg(F.collect_list(F.struct("g", "a", "b", "pos", "need")).alias("of"))
    few = split.count() <= 200_000
    picked = docs.join(F.broadcast(by_row) if few else by_row, "row").select("row", "text", "of")

    def flanks(batches):
        names = ["g", "a", "b", "row", "pos", "need", "lf", "rf"]
        for batch in (whole.slice(i, FLANK_ROWS) for whole in batches for i in range(0, whole.num_rows, FLANK_ROWS)):
            data, offsets = stream(batch.column(1))
            out: list[list] = [[] for _ in names]
            for i, (row, of) in enumerate(zip(batch.column(0).to_pylist(), batch.column(2).to_pylist(), strict=True)):
                text = packed(data[offsets[i] : offsets[i + 1]])
                for x in of:
                    a, b, p = x["a"], x["b"], x["pos"]
                    end = p + gram
                    values = (x["g"], a, b, row, p, x["need"], text[size * max(0, p - b) : size * max(0, p - a)], text[size * (end + w - b) : size * (end + w - a)])
                    for col, v in zip(out, values, strict=True):
                        col.append(v)
            types = [pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.bool_(), pa.binary(), pa.binary()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, types, strict=True)], names)

    schema = "g long, a int, b int, row long, pos long, need boolean, lf binary, rf binary"
    items = scratch.keep(picked.mapInArrow(flanks, schema), "flanks")
    low, high = F.expr(f"greatest(a, b - length(rf) div {size})"), F.expr(f"least(b, a + length(lf) div {size})")

    def find(table: pa.Table) -> pa.Table:
        g, a, b = (table.column(c).to_numpy() for c in ("g", "a", "b"))
        least, most = marked(g, table.column("lf").to_pylist(), table.column("rf").to_pylist(), b - a + 1, size)
        ok = (most >= 0) & table.column("need").to_numpy()
        row, pos = table.column("row").to_numpy()[ok], table.column("pos").to_numpy()[ok]
        return pa.table([pa.array(row), pa.array(pos - a[ok] - most[ok]), pa.array(pos - a[ok] - least[ok] + length)], names=["row", "lo", "hi"])

    while True:
        items = items.where(low <= high)
        alike = ["g", "a", "b", "kl", "kr"]
        keyed = items.withColumns({"kl": F.xxhash64("lf", F.length("lf")), "kr": F.xxhash64("rf", F.length("rf"))})
        equal = keyed.groupBy(*alike).agg(F.count("*").alias("n"), one_row, one_pos)
        both = scratch.keep(keyed.join(equal, alike), "equal")
        spans.append(both.where("n > 1 and need").select("row", (F.col("pos") - high).alias("lo"), (F.col("pos") - low + length).alias("hi")))
        one = both.where("one_row = row and one_pos = pos")
        one = one.select("g", "a", "b", "row", "pos", (F.col("need") & (F.col("n") == 1)).alias("need"), "lf", "rf")
        sizes = one.groupBy("g").agg(F.count("*").alias("n"), F.max("need").alias("need"), F.sum(F.expr(f"(length(lf) + length(rf)) div {size} + 2")).alias("symbols")).where("n > 1 and need")
        sizes = scratch.keep(sizes.select("g", "symbols"), "sizes")
        total, largest = sizes.agg(F.sum("symbols"), F.max("symbols")).first()
        if not total:
            break
        fit = sizes.where(F.col("symbols") <= most).select("g")
        blocks = max(1, -(-int(total) // (most // 2)), min(shuffle_partitions(spark), int(total) // (most // 16)))
        indexed = one.join(fit, "g", "left_semi").withColumn("block", F.pmod(F.xxhash64("g"), F.lit(blocks)))
        spans.append(scratch.keep(indexed.groupBy("block").applyInArrow(find, "row long, lo long, hi long"), "found"))
        if largest <= most:
            break
        large = one.join(sizes.where(F.col("symbols") > most).select("g"), "g", "left_semi")
        m = F.floor((F.col("a") + F.col("b")) / 2).cast("int")
        large = large.withColumn("m", m)
        lower = large.where(f"length(rf) >= {size} * (b - m)").select(
            F.xxhash64("g", F.expr(f"substring(rf, 1, {size} * (b - m))"), F.lit(0)).alias("g"),
            "a",
            F.col("m").alias("b"),
            "row",
            "pos",
            "need",
            F.expr(f"case when length(lf) <= {size} * (m - a) then lf else substring(lf, length(lf) - {size} * (m - a) + 1, {size} * (m - a)) end").alias("lf"),
            F.expr(f"substring(rf, {size} * (b - m) + 1, length(rf))").alias("rf"),
        )
        upper = large.where(f"length(lf) >= {size} * (m + 1 - a) and m < b").select(
            F.xxhash64("g", F.expr(f"substring(lf, length(lf) - {size} * (m + 1 - a) + 1, {size} * (m + 1 - a))"), F.lit(1)).alias("g"),
            (F.col("m") + 1).alias("a"),
            "b",
            "row",
            "pos",
            "need",
            F.expr(f"substring(lf, 1, length(lf) - {size} * (m + 1 - a))").alias("lf"),
            F.expr(f"case when length(rf) <= {size} * (b - m - 1) then rf else substring(rf, 1, {size} * (b - m - 1)) end").alias("rf"),
        )
        items = scratch.keep(lower.unionByName(upper), "halved")
    out = spans[0]
    for s in spans[1:]:
        out = out.unionByName(s)
    return out


def merge(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[list[int]] = []
    for lo, hi in sorted(spans):
        if out and lo <= out[-1][1]:
            out[-1][1] = max(out[-1][1], hi)
        else:
            out.append([lo, hi])
    return [tuple(x) for x in out]


def repeated_words(spark: SparkSession, docs: DataFrame, words: int, most: int = INDEX_WORDS) -> DataFrame:
    """docs: (row long unique, text) -> (row, lo, hi): spans of words whose union is all passages of ``words`` words that repeat."""
    return repeated_spans(spark, docs, words, min(GRAM_WORDS, words // 2), most, word_codes, CODE)


def suffix_dedup(
    spark: SparkSession, docs: DataFrame, length: int = 400, gram: int = GRAM, index_bytes: int = INDEX_BYTES, digest: bool = False, with_text: bool = False, words: int = 0, index_words: int = INDEX_WORDS
) -> DataFrame:
    """Remove what repeats: strings of ``length`` bytes and, if given, passages of ``words`` words.  With ``digest``: doc_id and, of the
    strings alone, n_bytes, n_removed, n_spans, kept_sha256 and, if asked for, kept (what is left by them) and text (what is left by both); else the
    input's columns plus n_removed.  ``text`` is what is left of the text (bytes that a cut inside a letter leaves over are dropped)."""
    from .common import hidden
    from .line_dedup import SLICE, with_rows

    scratch = Scratch(spark, "repeats-rows")
    named = docs.select("doc_id", "text") if digest else docs.drop("n_removed")
    inner, own = hidden(named, "doc_id", "text")
    numbered, rows = with_rows(scratch, inner)
    first = Scratch(spark, "repeats")
    spans = repeated_spans(spark, rows, length, gram, index_bytes, scratch=first).withColumn("words", F.lit(False))
    if words:  # one index at a time: the tables of the first go before the second is made
        spans = scratch.keep(spans, "spans")
        first.clear()
        spans = spans.unionByName(repeated_words(spark, rows, words, index_words).withColumn("words", F.lit(True)))
    by_row = spans.groupBy("row").agg(F.collect_list(F.struct("lo", "hi", "words")).alias("__spans"))
    joined = numbered.join(by_row.hint("shuffle_hash"), "row", "left").select(*[F.col(c).cast("string") if c == "text" else c for c in own], "__spans")
    at = own.index("text")

    names = ["n_bytes", "n_removed", "n_spans", "kept_sha256", *["kept", "text"] * with_text]

    def left(raw: bytes, gone: list[tuple[int, int]]) -> list[bytes]:
        edges = [0, *(x for span in gone for x in span), len(raw)]
        return [raw[lo:hi] for lo, hi in zip(edges[::2], edges[1::2], strict=True)]

    def whole_letters(kept: list[bytes]) -> str:
        return "".join(k.decode("utf-8", "ignore") for k in kept)

    def cut(batches):
        for b in (whole.slice(i, SLICE) for whole in batches for i in range(0, whole.num_rows, SLICE)):
            out: dict[str, list] = {k: [] for k in ["n_bytes", "n_removed", "n_spans", "kept_sha256", "kept", "text"]}
            for text, spans in zip(b.column(at).to_pylist(), b.column(len(own)).to_pylist(), strict=True):
                raw = (text or "").encode()
                of = [[(x["lo"], x["hi"]) for x in spans or [] if x["words"] == w] for w in (False, True)]
                gone = merge(of[0])
                both = merge(gone + in_bytes(raw, of[1])) if of[1] else gone
                gone = gone if digest else both
                kept = left(raw, gone)
                out["n_bytes"].append(len(raw))
                out["n_removed"].append(sum(hi - lo for lo, hi in gone))
                out["n_spans"].append(len(gone))
                if digest:
                    out["kept_sha256"].append(hashlib.sha256(b"".join(kept)).hexdigest())
                if digest and with_text:
                    out["kept"].append(None if text is None else whole_letters(kept))
                if with_text or not digest:
                    out["text"].append(None if text is None else out["kept"][-1] if digest and gone == both else whole_letters(left(raw, both)))
            made = {k: pa.array(v, pa.int64() if k.startswith("n_") else pa.string()) for k, v in out.items()}
            if digest:
                yield pa.RecordBatch.from_arrays([b.column(own.index("doc_id")).cast(pa.int64()), *(made[k] for k in names)], ["doc_id", *names])
            else:
                cols = list(b.columns[: len(own)])
                cols[at] = made["text"]
                yield pa.RecordBatch.from_arrays([*cols, made["n_removed"]], [*own, "n_removed"])

    if digest:
        return joined.mapInArrow(cut, "doc_id long, " + ", ".join(f"{k} {'long' if k.startswith('n_') else 'string'}" for k in names))
    schema = inner.withColumn("text", F.col("text").cast("string")).schema.add("n_removed", "long")
    return joined.mapInArrow(cut, schema).toDF(*named.columns, "n_removed")
