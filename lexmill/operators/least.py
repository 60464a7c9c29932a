"""Least likeness inside clusters: exact minima over all pairs of members, in blocks of bounded size.

A cluster is dealt into blocks by the hash of its members; two blocks meet in one group, and a group finds the least value
of its pairs.  All pairs count.  What is spared is work that can't change a minimum: Jaccard indexes of a group come
from products of word matrices, and the matching of two texts ends as soon as it is no less than the least one found.
"""

from __future__ import annotations

from collections import Counter
from difflib import SequenceMatcher
from operator import add
from sys import intern

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Members and bytes of a block: of sets, and of texts (whose pairs take longer).
SETS, TEXTS, BLOCK_BYTES = 512, 256, 8 << 20
#: Columns of a word matrix at a time, and pairs of a step of the words outside it.
WORDS, STEP = 2048, 1 << 20
#: Pairs of texts of most unequal lengths that are compared before all others.
FIRST = 8
#: Runs of so many indexed characters are left to difflib, which is quick where characters are rare.
LONG = 16


def _blocks(rows: DataFrame, keys: list[str], ident: str, value: str, weight: Column, most: int) -> DataFrame:
    """Rows of each group: __lo and __hi (blocks that meet), __x (the row's own block).

    Equal values of a cluster are one member, with the least and the greatest of their identifiers.  How many there are is
    estimated, which sizes the blocks and nothing else.
    """
    known = F.col(ident).isNotNull() & F.col(value).isNotNull()
    for k in keys:
        known = known & F.col(k).isNotNull()
    rows = rows.where(known).select(*keys, ident, value)
    members = F.approx_count_distinct(value)
    sizes = rows.groupBy(*keys).agg(F.count("*").alias("__n"), F.ceil(F.greatest(members / most, members * F.avg(weight) / BLOCK_BYTES, F.lit(1))).cast("int").alias("__blocks"))
    distinct = rows.groupBy(*keys, value).agg(F.min(ident).alias("first_id"), F.max(ident).alias("last_id"))
    rows = distinct.join(sizes.where("__n > 1").drop("__n"), keys)
    rows = rows.withColumn("__x", F.pmod(F.xxhash64(value), F.col("__blocks")).cast("int"))
    rows = rows.withColumn("__y", F.explode(F.sequence(F.lit(0), F.col("__blocks") - 1)))
    return rows.select(*keys, value, "first_id", "last_id", F.least("__x", "__y").alias("__lo"), F.greatest("__x", "__y").alias("__hi"), "__x")


def _minima(rows: DataFrame, keys: list[str], value: str, find) -> DataFrame:
    """Least value of each cluster; find(values, first, last, left): left marks the first of two blocks, or is None if there is one.

    A value that two documents have is a pair of its own, for which find gives its likeness to itself.
    """

    def group(table: pa.Table) -> pa.Table:
        lo, x = table.column("__lo")[0].as_py(), table.column("__x").to_numpy()
        left = None if lo == table.column("__hi")[0].as_py() else x == lo
        first, last = (table.column(c).to_numpy() for c in ("first_id", "last_id"))
        least = find(table.column(value), first, last, left)
        return pa.table([*(table.column(k).slice(0, 1) for k in keys), pa.array([least], pa.float64())], names=[*keys, "least"])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.select(*keys).schema) + ", least double"
    return rows.groupBy(*keys, "__lo", "__hi").applyInArrow(group, schema).groupBy(*keys).agg(F.min("least").alias("least"))


# Jaccard indexes -----------------------------------------------------------------------------------------------------------


def shared_words(doc: np.ndarray, word: np.ndarray, n: int) -> np.ndarray:
    """Words that documents share (n x n), from distinct (document, word) pairs."""
    _, word, met = np.unique(word, return_inverse=True, return_counts=True)
    keep = met[word] > 1
    doc, word = doc[keep], word[keep]
    out = np.zeros((n, n), np.float32)
    often = met > max(2, n // 12)
    # frequent words: products of 0/1 matrices (counts below 2^24 are exact)
    number = np.cumsum(often) - 1
    at = often[word]
    d, w = doc[at], number[word[at]]
    order = np.argsort(w, kind="stable")
    d, w = d[order], w[order]
    for s in range(0, int(often.sum()), WORDS):
        a, z = np.searchsorted(w, [s, s + WORDS])
        part = np.zeros((n, min(WORDS, int(often.sum()) - s)), np.float32)
        part[d[a:z], w[a:z] - s] = 1
        out += part @ part.T
    # the others: the pairs that each word makes
    d, w = doc[~at], word[~at]
    order = np.argsort(w, kind="stable")
    d, times = d[order], met[w[order]]
    seldom = np.zeros((n, n), np.float32)
    for k in np.unique(times):
        lists = d[times == k].reshape(-1, k)
        i, j = np.triu_indices(int(k), 1)
        step = max(1, STEP // len(i))
        for s in range(0, len(lists), step):
            part = lists[s : s + step]
            np.add.at(seldom.reshape(-1), (part[:, i] * n + part[:, j]).ravel(), np.float32(1))
    return out + seldom + seldom.T


def _least_jaccard(values, first: np.ndarray, last: np.ndarray, left: np.ndarray | None, separator: str | None = None) -> float | None:
    lists = pa.concat_arrays([pc.split_pattern(x, separator) if separator else x for x in values.chunks])
    n = len(lists)
    doc = np.repeat(np.arange(n), np.diff(lists.offsets.to_numpy()))
    word = lists.flatten().dictionary_encode(null_encoding="encode").indices.to_numpy().astype(np.int64)
    base = int(word.max(initial=0)) + 1
    doc, word = np.divmod(np.unique(doc * base + word), base)
    size = np.bincount(doc, minlength=n).astype(np.float64)
    shared = shared_words(doc, word, n).astype(np.float64)
    which = np.triu(np.ones((n, n), bool), 1) if left is None else left[:, None] & ~left[None, :]
    # two sets of one and the same identifier are no pair
    which &= np.minimum(first[:, None], first[None, :]) != np.maximum(last[:, None], last[None, :])
    union = size[:, None] + size[None, :] - shared
    ratio = np.divide(shared, union, out=np.ones((n, n)), where=union > 0)[which]
    own = [1.0] if (first != last).any() else []
    return min([*own, float(ratio.min())] if len(ratio) else own, default=None)


def least_jaccard(rows: DataFrame, keys: list[str], ident: str, words: str, separator: str | None = None) -> DataFrame:
    """(keys, least): least Jaccard index of the word sets of two members; 1 if both are empty.

    words: arrays, or texts whose parts between separators are the words.
    """
    weight = F.octet_length(words) * 2 if separator else F.size(words) * 16
    blocks = _blocks(rows, keys, ident, words, weight, SETS)
    return _minima(blocks, keys, words, lambda *x: _least_jaccard(*x, separator)).where("least is not null")


# Similarity of texts -------------------------------------------------------------------------------------------------------


def indexed(b: str) -> set[str]:
    """Characters that difflib's index of a text holds: of a text of 200 or more, those that aren't popular."""
    n = len(b)
    chars = set(b)
    if n < 200:
        return chars
    counts = {c: b.count(c) for c in chars} if len(chars) < 256 else Counter(b)
    return {c for c, k in counts.items() if k <= n // 100 + 1}


def pairs_of(text: str) -> set[str]:
    """Character pairs of a text."""
    return set(map(intern, set(map(add, text, text[1:]))))


class Matcher:
    """``SequenceMatcher(None, a, b).ratio()`` for one b and many a.

    The same blocks as difflib's, by other means: a block starts from the longest run of characters that b's index holds and a has,
    the first in a and then in b.  Such runs are looked up by length, as strings that both texts have, until they are LONG;
    then difflib finds the blocks.
    """

    def __init__(self, b: str):
        self.b, self.grams = b, [indexed(b)]
        codes = np.frombuffer(b.encode("utf-32-le", "surrogatepass"), "<u4")
        self._at = np.flatnonzero(np.isin(codes, np.array([ord(c) for c in self.grams[0]], "<u4")))  # where the last of grams start
        self._difflib: SequenceMatcher | None = None

    def _grams(self, k: int) -> set[str]:
        """Runs of k indexed characters in b."""
        while len(self.grams) < k:
            n = len(self.grams) + 1
            self._at = self._at[:-1][self._at[1:] == self._at[:-1] + 1]
            self.grams.append({self.b[i : i + n] for i in self._at.tolist()})
        return self.grams[k - 1]

    def _common(self, a: str, chars: set[str], pairs: set[str]) -> list[set[str]] | None:
        """Runs of each length that a has, too; None if they are long."""
        out = [self.grams[0] & chars]
        if out[0]:
            out.append(self._grams(2) & pairs)
        while out[-1]:
            if len(out) == LONG:
                return None
            last = out[-1]
            out.append({g for g in self._grams(len(out) + 1) if g[:-1] in last and g[1:] in last and g in a})
        return out[:-1]

    def _longest(self, a: str, common: list[set[str]], alo: int, ahi: int, blo: int, bhi: int) -> tuple[int, int, int]:
        b, besti, bestj, best = self.b, alo, blo, 0
        for k in range(min(len(common), ahi - alo, bhi - blo), 0, -1):
            end = ahi
            for g in common[k - 1]:
                i = a.find(g, alo, end)
                if i >= 0:
                    j = b.find(g, blo, bhi)
                    if j >= 0:
                        besti, bestj, best, end = i, j, k, i + k - 1
            if best:
                break
        while besti > alo and bestj > blo and a[besti - 1] == b[bestj - 1]:
            besti, bestj, best = besti - 1, bestj - 1, best + 1
        while besti + best < ahi and bestj + best < bhi and a[besti + best] == b[bestj + best]:
            best += 1
        return besti, bestj, best

    def ratio(self, a: str, bound: float = 2.0, chars: set[str] | None = None, pairs: set[str] | None = None) -> float:
        """The ratio; if it is no less than ``bound``, any value from ``bound`` up to it."""
        total = len(a) + len(self.b)
        if not total:
            return 1.0
        common = self._common(a, set(a) if chars is None else chars, pairs_of(a) if pairs is None else pairs)
        if common is None:
            if self._difflib is None:
                self._difflib = SequenceMatcher(None, "", self.b)
            self._difflib.set_seq1(a)
        matches, queue = 0, [(0, len(a), 0, len(self.b))]
        while queue:
            alo, ahi, blo, bhi = queue.pop()
            i, j, k = self._difflib.find_longest_match(alo, ahi, blo, bhi) if common is None else self._longest(a, common, alo, ahi, blo, bhi)
            if k:
                matches += k
                if 2.0 * matches / total >= bound:
                    break
                if alo < i and blo < j:
                    queue.append((alo, i, blo, j))
                if i + k < ahi and j + k < bhi:
                    queue.append((i + k, ahi, j + k, bhi))
        return 2.0 * matches / total


def _least_similarity(values, first: np.ndarray, last: np.ndarray, left: np.ndarray | None) -> float | None:
    texts = values.to_pylist()
    n = len(texts)
    if left is None:
        allowed = ~np.eye(n, dtype=bool)
    else:
        allowed = left[:, None] != left[None, :]
    # a pair (a, b) is there if some document of a comes before some document of b
    allowed &= first[:, None] < last[None, :]
    own = first != last
    least = min((1.0 if texts[k] else 0.0 for k in np.flatnonzero(own)), default=None)
    if not allowed.any():
        return least
    size = np.array([len(t) for t in texts])
    if (allowed & ((size == 0)[:, None] | (size == 0)[None, :])).any():
        return 0.0
    # nothing matches: no character of b's index in a, and no common start
    letters = sorted(set().union(*map(set, texts)))
    at = {c: k for k, c in enumerate(letters)}
    holds, index = np.zeros((2, n, len(letters)), np.float32)
    for k, t in enumerate(texts):
        holds[k, [at[c] for c in set(t)]] = 1
        index[k, [at[c] for c in indexed(t)]] = 1
    heads = np.array([at[t[0]] for t in texts])
    if (allowed & (holds @ index.T == 0) & (heads[:, None] != heads[None, :])).any():
        return 0.0
    # every pair has a match now, so none is below 2 / total; the most unequal lengths first
    total = size[:, None] + size[None, :]
    ceiling = 2.0 * np.minimum(size[:, None], size[None, :]) / total
    least, floor = 2.0 if least is None else least, 2.0 / total
    chars, pairs = [set(t) for t in texts], [pairs_of(t) for t in texts]
    seeds = np.argsort(np.where(allowed, ceiling, 3.0), axis=None)[: min(FIRST, int(allowed.sum()))]
    ready: dict[int, Matcher] = {}
    for a, b in zip(*np.unravel_index(seeds, (n, n)), strict=True):
        ready[b] = ready.get(b) or Matcher(texts[b])
        least = min(least, ready[b].ratio(texts[a], least, chars[a], pairs[a]))
    for b in range(n):
        todo = np.flatnonzero(allowed[:, b] & (floor[:, b] < least))
        if len(todo):
            m = ready.get(b) or Matcher(texts[b])
            for a in todo[np.argsort(ceiling[todo, b], kind="stable")]:
                if floor[a, b] < least:
                    least = min(least, m.ratio(texts[a], least, chars[a], pairs[a]))
    return float(least)


def least_similarity(rows: DataFrame, keys: list[str], ident: str, text: str) -> DataFrame:
    """(keys, least): least ratio of matching blocks of two members, the one of lesser identifier first; 0 if a text is empty."""
    blocks = _blocks(rows, keys, ident, text, F.octet_length(text), TEXTS)
    return _minima(blocks, keys, text, _least_similarity).where("least is not null")
