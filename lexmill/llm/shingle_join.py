"""Exact Jaccard joins of shingle sets: candidates from rarity-ordered prefixes, exact verification after.

Shared by the document join and the line join.  Steps:

1. Count: one pass adds up shingle counts in ``CLASSES`` hash classes over all texts (bounded, and the same for any
   input size).  The global order is (class count, hash), so rare shingles come first whatever the corpus.
2. Prefix: a set of n shingles posts its first n - ceil(t n) + k of that order, k = max(2, n // ``extra``).  Two sets
   with Jaccard >= t share at least the smaller k of posted shingles, so a set that shares fewer with all others
   together links with nothing and goes.  Postings leave a task as packed blocks dealt by shingle hash; shingles of very
   frequent classes are dealt by set as well, so no block gathers a hot shingle.
3. Lists: a block is sorted once; shingles with two or more sets become member lists, pairs that the length or
   positional filter rules out go, and equal lists collapse.
4. Leaders: exact set overlap, first of every set with the leaders of its lists; sets that link are connected.  What is
   left are lists with members in different groups.  Lists stand in one order, the shortest first.  A linked pair shares k
   lists, so a set needs all of its lists but the last k - 1, and at the first list that two sets share, whatever either
   posted before is what the other lacks.  That bounds their overlap (the positional filter over whole sets), and pairs meet
   only where sizes and this bound allow a link.
5. Token combinations: lists of more than ``LONG_LIST`` sets belong to the frequent shingles.  They are replaced by lists of
   the sets that share two of them; rarer shingles stay single.  Frequent lists are the last in the order, so a
   pair whose first common list is frequent shares a second one that is, too.
6. Jaccard distance is a metric, so a leader stands for the sets within 1 - t of it: what is farther than 2(1 - t)
   from a leader links with none of them, and only pairs that this leaves open are compared one by one.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import Scratch, components, shuffle_partitions
from .shingles import buffers, chunks, distinct, mix, signatures, units

CLASSES = 1 << 16
#: Class counts travel in so many slices, which add up side by side.
SLICES = 64
#: A shingle in more sets than this is a frequent one.
LONG_LIST = 512
#: Postings that a task gathers before it packs them, and that a block holds on average.
FLUSH = 1 << 20
BLOCK_POSTINGS = 1 << 21
#: Most sets on one side of a block of two clusters.
BLOCK_SETS = 4096
#: Buckets of the histogram that bounds an overlap, for documents and for lines.
BINS = (256, 32)
#: Shingles that two linked sets of two or more share among those posted, at least.
K = 2


class ShingleJoin:
    """One corpus (``row`` long, ``text`` string) cut into units, ready to be joined with itself."""

    def __init__(self, spark: SparkSession, docs: DataFrame, lines: bool, percent: int = 75, width: int = 5, extra: int | None = None):
        self.spark, self.docs, self.lines, self.percent, self.width = spark, docs.select("row", "text"), lines, percent, width
        self.extra = extra or 1 << 30
        self.bins = BINS[lines]
        self.scratch = Scratch(spark, "lines" if lines else "ngrams")

    # 1 ---------------------------------------------------------------------------------------------------------
    def count(self) -> DataFrame:
        """Units (row, line, n, sig, fresh: first of its set in its row) of all texts; keeps the class counts."""
        lines, width, wide = self.lines, self.width, CLASSES // SLICES
        names = ["row", "line", "n", "sig", "fresh", "slice", "counts"]

        def work(batches):
            total = np.zeros(CLASSES, np.int64)
            for batch in batches:
                data, offsets = buffers(batch.column(1))
                for a, b in chunks(offsets):
                    rows, number, unit, tokens = units(data, offsets[a : b + 1], lines, width)
                    total += np.bincount((tokens & np.uint64(CLASSES - 1)).astype(np.int64), minlength=CLASSES)
                    u, t, _ = distinct(unit, tokens)
                    n, sig = signatures(u, t, len(rows))
                    fresh = np.ones(len(rows), bool)
                    if lines:
                        order = np.lexsort((number, sig, rows))
                        fresh[order[1:]] = (sig[order[1:]] != sig[order[:-1]]) | (rows[order[1:]] != rows[order[:-1]])
                        some = n > 0  # lines without words take no part
                        rows, number, n, sig, fresh = rows[some], number[some], n[some], sig[some], fresh[some]
                    m = len(rows)
                    yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(a + rows)), pa.array(number, pa.int32()), pa.array(n, pa.int32()), pa.array(sig), pa.array(fresh), pa.nulls(m, pa.int32()), pa.nulls(m, pa.binary())], names)
            own = total.reshape(SLICES, wide)
            none = [pa.nulls(SLICES, kind) for kind in (pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.bool_())]
            yield pa.RecordBatch.from_arrays([*none, pa.array(np.arange(SLICES), pa.int32()), pa.array([x.tobytes() for x in own], pa.binary())], names)

        schema = "row long, line int, n int, sig long, fresh boolean, slice int, counts binary"
        both = self.scratch.keep(self.docs.mapInArrow(work, schema), "units")

        def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = np.zeros(wide, np.int64)
            for batch in batches:
                total += np.frombuffer(b"".join(batch.column("counts").to_pylist()), np.int64).reshape(-1, wide).sum(axis=0)
                own = batch.column("slice")[:1]
            yield pa.RecordBatch.from_arrays([own, pa.array([total.tobytes()], pa.binary())], ["slice", "counts"])

        summed = both.where("slice is not null").select("slice", "counts").groupBy("slice").applyInArrow(add, "slice int, counts binary").collect()
        total = np.zeros((SLICES, wide), np.int64)
        for r in summed:  # SLICES rows of fixed size
            total[r[0]] = np.frombuffer(r[1], np.int64)
        total = total.ravel()
        self.total = int(total.sum())
        # 12-bit class ranks, monotone in the count: the order only has to be the same for all sets
        order = np.argsort(np.argsort(total, kind="stable"), kind="stable")
        self.ranks = (order * 4096 // CLASSES).astype(np.uint16)
        self.hot = total > max(self.total // 512, 4 * (self.total // CLASSES) + 1000)
        self.units = both.where("slice is null").drop("slice", "counts")
        return self.units

    # 2, 3 ------------------------------------------------------------------------------------------------------
    def lists(self) -> DataFrame:
        """Members of the lists, one row for each: lh long, sig long, mult long (equal lists that collapsed)."""
        lines, width, percent, extra = self.lines, self.width, self.percent, self.extra
        spark = self.spark
        filters = lines  # postings of lines carry what the length and positional filters need
        ranks, hot = self.ranks, self.hot
        share = (100 - percent) / 100 + 1 / min(extra, 1 << 20)
        n_blocks = max(2 * shuffle_partitions(spark), int(self.total * share) // BLOCK_POSTINGS)

        def pack(parts):
            t, sig, n, place = (np.concatenate(p) for p in zip(*parts, strict=True))
            block = (mix(t) % np.uint64(n_blocks)).astype(np.int64)
            is_hot = hot[(t & np.uint64(CLASSES - 1)).astype(np.int64)]
            block[is_hot] = n_blocks + sig[is_hot] % n_blocks
            order = np.argsort(block, kind="stable")
            block = block[order]
            lo = np.flatnonzero(np.diff(block, prepend=-1))
            hi = np.append(lo[1:], len(block))
            fields = [(t >> np.uint64(32)).astype(np.uint32)[order], sig[order]]
            if filters:
                fields += [n[order], place[order]]
            blobs = [b"".join([x[i:j].tobytes() for x in fields]) for i, j in zip(lo, hi, strict=True)]
            return pa.RecordBatch.from_arrays([pa.array(block[lo], pa.int64()), pa.array(blobs, pa.binary())], ["block", "blob"])

        def post(batches):
            seen: set[int] = set()  # sets that this task has posted; more than once does no harm
            parts, held = [], 0
            for batch in batches:
                data, offsets = buffers(batch.column(1))
                for a, b in chunks(offsets):
                    rows, _, unit, tokens = units(data, offsets[a : b + 1], lines, width)
                    if not len(tokens):
                        continue
                    u, t, _ = distinct(unit, tokens, ranks[(tokens & np.uint64(CLASSES - 1)).astype(np.int64)])
                    n, sig = signatures(u, t, len(rows))
                    fresh = np.zeros(len(rows), bool)
                    for i in np.flatnonzero(n):
                        s = int(sig[i])
                        if s not in seen:
                            fresh[i] = True
                            if len(seen) < 200_000:
                                seen.add(s)
                    need = -(-percent * n // 100)
                    prefix = np.minimum(n, n - need + np.maximum(K, n // extra))
                    first = np.cumsum(n) - n
                    place = np.arange(len(u)) - first[u]
                    keep = (place < prefix[u]) & fresh[u]
                    parts.append((t[keep], sig[u[keep]], np.minimum(n[u[keep]], 65535).astype(np.uint16), np.minimum(place[keep], 65535).astype(np.uint16)))
                    held += len(parts[-1][0])
                    if held >= FLUSH:
                        yield pack(parts)
                        parts, held = [], 0
            if held:
                yield pack(parts)

        none = pa.table([pa.array([], pa.int64())] * 3, names=["lh", "sig", "mult"])

        def gather(table: pa.Table) -> pa.Table:
            block = table.column("block")[0].as_py()
            layout = [(4, np.uint32), (8, np.int64), (2, np.uint16), (2, np.uint16)][: 4 if filters else 2]
            parts: list = [[] for _ in layout]
            for chunk in table.column("blob").chunks:
                for x in chunk:
                    raw = x.as_py()
                    m, at = len(raw) // sum(w for w, _ in layout), 0
                    for part, (w, kind) in zip(parts, layout, strict=True):
                        part.append(np.frombuffer(raw, kind, m, at))
                        at += w * m
            fields = [np.concatenate(p) for p in parts]
            order = np.lexsort((fields[1], fields[0]))
            t, sig = fields[0][order], fields[1][order]
            fresh = np.ones(len(t), bool)
            fresh[1:] = (t[1:] != t[:-1]) | (sig[1:] != sig[:-1])
            t, sig = t[fresh], sig[fresh]
            first = np.concatenate([[0], np.flatnonzero(np.diff(t.astype(np.int64))) + 1])
            size = np.diff(np.append(first, len(t)))
            loose = block >= n_blocks  # a share of a hot shingle's sets: joined by shingle later
            good = size >= (1 if loose else 2)
            if filters and not loose:  # length and positional filters on lists of two
                n, place = (x[order][fresh].astype(np.int64) for x in fields[2:])
                two = np.flatnonzero(size == 2)
                a, b = first[two], first[two] + 1
                known = (n[a] < 65535) & (n[b] < 65535)
                over = np.minimum(place[a], place[b]) + 1 + np.minimum(n[a] - place[a] - 1, n[b] - place[b] - 1)
                able = (100 + percent) * over >= percent * (n[a] + n[b])
                good[two[known & ~able]] = False
            if not good.any():
                return none
            inside = np.repeat(good, size)
            sig, size = sig[inside], size[good]
            if loose:  # a hot shingle's members never meet in one row or block
                lh = mix(t[inside].astype(np.uint64) + np.uint64(0x7F4A7C15 << 32)).view(np.int64)
                return pa.table([pa.array(lh), pa.array(sig), pa.array(np.ones(len(sig), np.int64))], names=["lh", "sig", "mult"])
            at = np.cumsum(size) - size
            sums = np.add.reduceat(mix(sig.astype(np.uint64)), at)
            lh, one, mult = np.unique(mix(sums + size.astype(np.uint64)).view(np.int64), return_index=True, return_counts=True)
            chosen = np.zeros(len(size), bool)
            chosen[one] = True
            times, named = np.zeros(len(size), np.int64), np.zeros(len(size), np.int64)
            times[one], named[one] = mult, lh
            rows = np.repeat(chosen, size)
            return pa.table([pa.array(np.repeat(named, size)[rows]), pa.array(sig[rows]), pa.array(np.repeat(times, size)[rows])], names=["lh", "sig", "mult"])

        posted = self.docs.mapInArrow(post, "block long, blob binary")
        return posted.groupBy("block").applyInArrow(gather, "lh long, sig long, mult long")

    def enough(self, flat: DataFrame, sets: DataFrame) -> DataFrame:
        """Members (with ``n`` and ``ord`` of the sets) whose sets share enough posted shingles, in lists that still join two, with their leaders.

        Adds ``shared`` (posted shingles that some other set posted too), ``room`` (what lists may have lost to shingles
        posted by 32 bits that fell together), ``rest`` (shingles not posted), ``alone`` and ``k``; and of each list
        ``central``, the set with the fewest shingles of its own (an original has none, its copies have those of
        their edits), and ``early``, that of the first document.
        """
        p = self.percent
        need = F.ceil(F.col("n") * p / 100)
        extra = F.greatest(F.lit(K), F.floor(F.col("n") / self.extra))
        least = F.least(F.greatest(F.lit(K), F.floor(F.floor(F.col("n") * p / 100) / self.extra)), F.col("n"))
        posted = F.least(F.col("n"), F.col("n") - need + extra)
        held = flat.withColumn("shared", F.sum("mult").over(Window.partitionBy("sig"))).join(sets.select("sig", "ord", "n").hint("shuffle_hash"), "sig")
        held = held.withColumns({"posted": posted, "k": least.cast("long"), "room": F.floor(posted / 2048)}).where("shared + room >= k")
        # equal lists of several blocks collapse
        held = held.groupBy("sig", "lh").agg(F.sum("mult").alias("mult"), *[F.first(c).alias(c) for c in ("n", "ord", "shared", "room", "posted", "k")])
        held = held.select("lh", "mult", "sig", "n", "ord", "shared", "room", (F.col("n") - F.col("posted")).alias("rest"), F.greatest(F.lit(0), F.col("posted") - F.col("shared")).alias("alone"), "k")
        held = self.scratch.keep(held, "enough")
        # few of its own, many shared, then any: one number
        clip = lambda c: F.least(F.col(c), F.lit(65535)).cast("long")
        worth = F.shiftleft(clip("alone"), 46) + F.shiftleft(65535 - clip("shared"), 30) + F.pmod(F.hash("sig"), F.lit(1 << 30))
        lead = held.groupBy("lh").agg(F.count("*").alias("size"), F.min(worth).alias("worth"), F.min_by("sig", worth).alias("central"), F.min("ord").alias("first"), F.min_by("sig", "ord").alias("early"))
        return self.scratch.keep(held.join(lead.where("size > 1").drop("size"), "lh"), "members")

    # 4 ---------------------------------------------------------------------------------------------------------
    def combine(self, rows: DataFrame) -> DataFrame:
        """Replace frequent lists (rows lh, size, mult, centre, component, left, rest, n, top) by lists of those that share two of them."""
        own = ["centre", "component", "left", "rest", "n", "top"]
        rare = rows.where(F.col("size") <= LONG_LIST).select("lh", *own)
        frequent = rows.where(F.col("size") > LONG_LIST)
        held = frequent.groupBy("centre", "component").agg(F.max("rest").alias("rest"), F.min("n").alias("n"), F.max("top").alias("top"), F.sort_array(F.collect_list(F.struct("size", "lh", "left", "mult"))).alias("of"))
        one = held.select("centre", "component", "rest", "n", "top", "of", F.posexplode("of").alias("i", "x"))
        second = F.expr("filter(transform(of, (o, j) -> case when j > i or (j = i and o.mult > 1) then struct(o.lh as lh, if(j = i, o.left, least(x.left, x.mult + o.left)) as left) end), o -> o is not null)")
        combos = one.select("centre", "component", "rest", "n", "top", F.col("x.lh").alias("x"), F.explode(second).alias("y"))
        # between a pair's first two common lists, too, either has what the other lacks
        combos = combos.select("centre", "component", F.col("y.left").alias("left"), "rest", "n", "top", "x", F.col("y.lh").alias("y"))
        return rare.unionByName(combos.select(F.xxhash64("x", "y").alias("lh"), *own))

    # 5 ---------------------------------------------------------------------------------------------------------
    def sets(self, wanted: DataFrame, broadcast_bytes: int = 8 << 20) -> DataFrame:
        """Shingle sets (sig, n, tokens, bins: histogram of hash bits) of wanted units (sig, row, line), read again from the texts."""
        lines, width = self.lines, self.width
        by_row = wanted.groupBy("row").agg(F.collect_list("line").alias("lines"))
        by_row = self.scratch.keep(by_row, "wanted")
        rows, places = by_row.agg(F.count("*"), F.coalesce(F.sum(F.size("lines")), F.lit(0))).first()
        few = 24 * rows + 4 * places <= broadcast_bytes
        picked = self.docs.join(F.broadcast(by_row) if few else by_row, "row").select("row", "text", "lines")

        n_bins = self.bins

        def work(batches):
            for batch in batches:
                data, offsets = buffers(batch.column(1))
                if lines:  # only the wanted lines, as texts of their own
                    pieces = []
                    for i, asked in enumerate(batch.column(2).to_pylist()):
                        text = data[offsets[i] : offsets[i + 1]].tobytes().split(b"\n")
                        pieces += [text[k] for k in asked]
                    data, offsets = buffers(pa.array(pieces, pa.large_binary()))
                for a, b in chunks(offsets):
                    rows, _, unit, tokens = units(data, offsets[a : b + 1], False, width)
                    u, t, _ = distinct(unit, tokens)
                    n, sig = signatures(u, t, len(rows))
                    ends = np.cumsum(n)
                    t = t[np.lexsort((t, u))]
                    bins = ((t >> np.uint64(8)) % np.uint64(n_bins)).astype(np.int64)
                    out: dict[int, tuple] = {}
                    for i in np.flatnonzero(n):
                        own = slice(ends[i] - n[i], ends[i])
                        histogram = np.minimum(np.bincount(bins[own], minlength=n_bins), 255).astype(np.uint8)
                        out[int(sig[i])] = (int(n[i]), t[own].tobytes(), histogram.tobytes())
                    yield pa.RecordBatch.from_arrays([pa.array(list(out), pa.int64()), pa.array([x[0] for x in out.values()], pa.int32()), pa.array([x[1] for x in out.values()], pa.binary()), pa.array([x[2] for x in out.values()], pa.binary())], ["sig", "n", "tokens", "bins"])

        self.kept_sets = self.scratch.keep(picked.mapInArrow(work, "sig long, n int, tokens binary, bins binary"), "sets")
        return self.kept_sets

    def verify(self, pairs: DataFrame, tag: str, least, rough: bool = True) -> DataFrame:
        """Exact overlap of the pairs (a, b) whose Jaccard is ``least`` percent or more -> a, b, na, nb, common.

        A histogram of hash bits of each set bounds the overlap from above; only pairs that pass it meet their
        whole sets.  Pairs that mostly link go without it (``rough``).
        """
        side = lambda x, what: self.kept_sets.select(F.col("sig").alias(x), F.col("n").alias(f"n{x}"), F.col(what).alias(f"t{x}"))

        n_bins = self.bins

        def bound(batches):
            for batch in batches:
                x, y = (np.frombuffer(b"".join([v.as_buffer() for v in batch.column(k)]), np.uint8).reshape(batch.num_rows, n_bins) for k in (5, 6))
                na, nb = batch.column(3).to_numpy().astype(np.int64), batch.column(4).to_numpy().astype(np.int64)
                common = np.minimum(x, y).sum(axis=1, dtype=np.int64)
                common = np.where(((x == 255) & (y == 255)).any(axis=1), np.minimum(na, nb), np.minimum(common, np.minimum(na, nb)))
                ok = common * 100.0 >= (na + nb - common) * batch.column(2).to_numpy()
                yield pa.RecordBatch.from_arrays([c.filter(pa.array(ok)) for c in batch.columns[:3]], ["a", "b", "least"])

        def work(batches):
            for batch in batches:
                common = []
                for x, y in zip(batch.column(5), batch.column(6), strict=True):
                    x, y = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                    if len(x) > len(y):
                        x, y = y, x
                    at = np.searchsorted(y, x)
                    at[at == len(y)] = 0
                    common.append(int((y[at] == x).sum()) if len(y) else 0)
                common = np.array(common, np.int64)
                na, nb = batch.column(3).to_numpy().astype(np.int64), batch.column(4).to_numpy().astype(np.int64)
                ok = pa.array(common * 100.0 >= (na + nb - common) * batch.column(2).to_numpy())
                cols = [batch.column(k).filter(ok) for k in (0, 1, 3, 4)] + [pa.array(common).filter(ok)]
                yield pa.RecordBatch.from_arrays(cols, ["a", "b", "na", "nb", "common"])

        names = ["a", "b", "least", "na", "nb", "ta", "tb"]
        pairs = pairs.select("a", "b", least.cast("double").alias("least"))
        if rough:
            pairs = pairs.join(side("b", "bins"), "b").join(side("a", "bins"), "a").select(*names)
            pairs = pairs.mapInArrow(bound, "a long, b long, least double")
        joined = pairs.join(side("b", "tokens"), "b").join(side("a", "tokens"), "a").select(*names)
        return self.scratch.keep(joined.mapInArrow(work, "a long, b long, na int, nb int, common long"), tag)

    def at_least(self, percent: float):
        """Jaccard of a verified pair >= percent / 100."""
        return F.col("common") * 100 >= (F.col("na") + F.col("nb") - F.col("common")) * percent

    def groups(self, members: DataFrame) -> DataFrame:
        """Connected groups of the sets in the members table -> (id, component) of sets."""
        # every set against leaders of its lists
        near_by = members.groupBy("sig").agg(F.min_by("central", "worth").alias("central"), F.min_by("early", "first").alias("early"))
        first = near_by.select(F.col("sig").alias("b"), F.explode(F.array_distinct(F.array("central", "early"))).alias("a")).where("a <> b")
        tried = self.verify(first, "leaders", F.lit(self.percent), rough=False)
        good = tried.where(self.at_least(self.percent)).select("a", "b")
        comp = self.scratch.keep(components(self.spark, good, self.scratch), "comp")
        centre_of = good.groupBy(F.col("b").alias("sig")).agg(F.min("a").alias("centre"))
        place = comp.withColumnRenamed("id", "sig").join(centre_of, "sig", "left")

        rows = members.select("lh", "mult", "sig", "n", "room", "rest", "k").join(place, "sig", "left")
        rows = self.scratch.keep(rows.withColumns({"centre": F.coalesce("centre", "sig"), "component": F.coalesce("component", "sig")}), "centred")
        # lists with members of several groups; of its lists a set needs all but the last k - 1, one more among frequent ones
        open_lists = rows.groupBy("lh").agg(F.count("*").alias("size"), F.min("component").alias("lo"), F.max("component").alias("hi")).where("lo <> hi").select("lh", "size")
        onward = Window.partitionBy("sig").orderBy(F.desc("size"), F.desc("lh")).rowsBetween(Window.unboundedPreceding, Window.currentRow)
        rows = rows.join(open_lists, "lh").withColumn("left", F.sum("mult").over(onward) + F.col("room"))  # in this list and those after it
        rows = rows.where(F.col("left") + (F.col("size") > LONG_LIST).cast("long") >= F.col("k"))
        # members with one leader and group stand together, with the bounds of the best of them
        rows = rows.groupBy("lh", "size", "centre", "component").agg(F.max("mult").alias("mult"), F.max("left").alias("left"), F.max("rest").alias("rest"), F.min("n").alias("n"), F.max("n").alias("top"))
        short = self.scratch.keep(self.combine(self.scratch.keep(rows, "live")), "short")

        def side(name: str) -> DataFrame:
            return short.select([F.col(c).alias(c if c == "lh" else f"{name}_{c}") for c in short.columns])

        common = F.least("a_left", "b_left") + F.greatest("a_rest", "b_rest")
        able = common * (100 + self.percent) >= (F.col("a_n") + F.col("b_n")) * self.percent
        able &= (F.col("a_top") * 100 >= F.col("b_n") * self.percent) & (F.col("b_top") * 100 >= F.col("a_n") * self.percent)
        apart_now = (F.col("a_centre") < F.col("b_centre")) & (F.col("a_component") != F.col("b_component"))
        pairs = side("a").alias("x").join(side("b").alias("y"), (F.col("x.lh") == F.col("y.lh")) & apart_now & able)
        between = pairs.select(F.col("a_centre").alias("a"), F.col("b_centre").alias("b")).distinct()
        stands = self.scratch.keep(centre_of.select(F.col("centre").alias("a")).distinct(), "stands")
        between = between.join(stands.select("a", F.lit(1).alias("sa")), "a", "left").join(stands.select(F.col("a").alias("b"), F.lit(1).alias("sb")), "b", "left")
        between = between.select("a", "b", (F.coalesce("sa", F.lit(0)) + F.coalesce("sb", F.lit(0))).alias("stand"))
        met = self.verify(between, "between", F.when(F.col("stand") == 0, self.percent).when(F.col("stand") == 1, self.near).otherwise(self.leaders_near))
        comp = self.joined(comp, met.where(self.at_least(self.percent)).select("a", "b"))

        # what the metric leaves open between groups that aren't connected
        maybe = self.scratch.keep(self.lifted(comp, met.where(~self.at_least(self.percent)).select("a", "b")).select("a", "b"), "open")
        if maybe.limit(1).count():
            comp = self.joined(comp, self.between_clusters(maybe, centre_of))
        return comp

    def lifted(self, comp: DataFrame, pairs: DataFrame) -> DataFrame:
        """Pairs (a, b) whose ends aren't connected yet, with their groups u and v."""
        for c, g in (("a", "u"), ("b", "v")):
            pairs = pairs.join(comp.select(F.col("id").alias(c), F.col("component").alias(g)), c, "left").withColumn(g, F.coalesce(g, c))
        return pairs.where("u <> v")

    def joined(self, comp: DataFrame, links: DataFrame) -> DataFrame:
        """Groups after more links: only the groups that these join are worked on."""
        new = self.scratch.keep(self.lifted(comp, links).select(F.col("u").alias("a"), F.col("v").alias("b")).distinct(), "joins")
        if not new.limit(1).count():
            return comp
        over = self.scratch.keep(components(self.spark, new, self.scratch), "over")
        over = over.unionByName(over.select(F.col("component").alias("id"), "component").distinct()).distinct()
        moved = comp.join(over.select(F.col("id").alias("component"), F.col("component").alias("to")), "component", "left")
        moved = moved.select("id", F.coalesce("to", "component").alias("component"))
        # groups that were single sets until now, or whose least set is no row of its own
        return self.scratch.keep(moved.unionByName(over).groupBy("id").agg(F.min("component").alias("component")), "comp")

    def between_clusters(self, maybe: DataFrame, centre_of: DataFrame) -> DataFrame:
        """Links between the clusters of leaders a and b (a leader, and the sets that link with it).

        The members of the larger cluster are connected, so a set of the smaller needs one link with any of them: that is
        all a task returns.  Clusters meet in blocks of bounded size, both sides blocked.
        """
        percent, n_bins = self.percent, self.bins
        ends = maybe.select(F.explode(F.array("a", "b")).alias("sig")).distinct()
        cluster = centre_of.select("sig", "centre").unionByName(ends.select("sig", F.col("sig").alias("centre"))).distinct()
        cluster = self.scratch.keep(cluster, "clusters")
        sizes = cluster.groupBy("centre").agg(F.count("*").alias("size"))
        size_of = lambda x: sizes.select(F.col("centre").alias(x), F.col("size").alias(f"n{x}"))
        sided = maybe.join(size_of("a"), "a").join(size_of("b"), "b")
        larger = F.col("na") >= F.col("nb")
        sided = sided.select(F.when(larger, F.col("a")).otherwise(F.col("b")).alias("h"), F.when(larger, F.col("b")).otherwise(F.col("a")).alias("centre"))
        right = self.scratch.keep(sided.join(cluster, "centre").select("h", "sig").distinct(), "asking")
        blocks = right.groupBy("h").agg(F.ceil(F.count("*") / BLOCK_SETS).cast("int").alias("nr"))
        blocks = blocks.join(sizes.select(F.col("centre").alias("h"), F.ceil(F.col("size") / BLOCK_SETS).cast("int").alias("nl")), "h")
        left = cluster.withColumnRenamed("centre", "h").join(blocks, "h").select("h", "sig", F.pmod(F.xxhash64("sig"), F.col("nl")).cast("int").alias("bl"), F.explode(F.sequence(F.lit(0), F.col("nr") - 1)).alias("br"))
        right = right.join(blocks, "h").select("h", "sig", F.explode(F.sequence(F.lit(0), F.col("nl") - 1)).alias("bl"), F.pmod(F.xxhash64("sig"), F.col("nr")).cast("int").alias("br"))

        def solve(left: pa.Table, right: pa.Table) -> pa.Table:
            found: list[tuple[int, int]] = []
            if left.num_rows and right.num_rows:
                read = lambda t: (t.column("sig").to_numpy(), t.column("n").to_numpy().astype(np.int64), [np.frombuffer(x, np.uint64) for x in t.column("tokens").to_pylist()], np.frombuffer(b"".join(t.column("bins").to_pylist()), np.uint8).reshape(-1, n_bins))
                ls, ln, lt, lb = read(left)
                rs, rn, rt, rb = read(right)
                for i in range(len(rs)):
                    low = np.minimum(ln, rn[i])
                    bound = np.minimum(lb, rb[i]).sum(axis=1, dtype=np.int64)
                    bound = np.where((lb[:, rb[i] == 255] == 255).any(axis=1), low, np.minimum(bound, low))
                    able = (bound * (100 + percent) >= (ln + rn[i]) * percent) & (ls != rs[i])
                    for j in np.flatnonzero(able)[np.argsort(-bound[able], kind="stable")]:
                        common = len(np.intersect1d(lt[j], rt[i], assume_unique=True))
                        if common * 100 >= (ln[j] + rn[i] - common) * percent:
                            found.append((int(rs[i]), int(ls[j])))
                            break
            return pa.table([pa.array([f[0] for f in found], pa.int64()), pa.array([f[1] for f in found], pa.int64())], names=["a", "b"])

        keys = ["h", "bl", "br"]
        again = self.spark.read.schema(self.kept_sets.schema).parquet(self.kept_sets._lexmill_path)  # columns of its own
        solved = left.join(self.kept_sets, "sig").groupBy(*keys).cogroup(right.join(again, "sig").groupBy(*keys)).applyInArrow(solve, "a long, b long")
        return self.scratch.keep(solved, "across")

    @property
    def near(self) -> float:
        """Similarity that whatever links with a member has with the member's leader at least: distance 2(1 - t)."""
        return max(0.0, 100 - 2 * (100 - self.percent) - 1e-6)

    @property
    def leaders_near(self) -> float:
        """The same between the leaders of two linked members: distance 3(1 - t)."""
        return max(0.0, 100 - 3 * (100 - self.percent) - 1e-6)

