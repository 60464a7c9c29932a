"""Document and line joins against brute force."""

import random
import re

import numpy as np
import pytest

from lexmill.llm.line_dedup import line_dedup
from lexmill.llm.ngram_join import ngram_groups


def shingles(text):
    raw = bytes(c + 32 if 65 <= c <= 90 else c for c in (text or "").encode())
    words = re.findall(rb"[^\x20\x09-\x0D]+", raw)
    if not words:
        return set()
    if len(words) < 5:
        return {tuple(words)}
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)}


def similar(a, b, percent=75):
    common = len(a & b)
    return common * 100 >= percent * (len(a) + len(b) - common) and common > 0


def brute_groups(docs):
    return sorted(brute_groups_of(docs))


def brute_groups_of(docs):
    sets = [shingles(t) for _, t in docs]
    group = list(range(len(docs)))

    def root(i):
        while group[i] != i:
            i = group[i]
        return i

    for i in range(len(docs)):
        for j in range(i):
            if sets[i] and sets[j] and similar(sets[i], sets[j]):
                group[max(root(i), root(j))] = min(root(i), root(j))
    least = {}
    for i, (d, _) in enumerate(docs):
        least[root(i)] = min(least.get(root(i), d), d)
    return [(d, len(sets[i]), least[root(i)]) for i, (d, _) in enumerate(docs)]


def brute_lines(docs):
    """Documents in reading order -> kept text: of a group of similar lines only the first stays."""
    lines = [(i, k, line) for i, (_, text) in enumerate(docs) if text is not None for k, line in enumerate(text.split("\n"))]
    first = {n: c for n, _, c in brute_groups_of([(n, line) for n, (_, _, line) in enumerate(lines)])}
    keep = {(i, k) for n, (i, k, _) in enumerate(lines) if first[n] == n}
    return [None if text is None else "\n".join(x for k, x in enumerate(text.split("\n")) if (i, k) in keep) for i, (_, text) in enumerate(docs)]


def edited(rng, words, rate):
    out = list(words)
    for i in range(len(out)):
        if rng.random() < rate:
            out[i] = f"e{rng.randrange(10**6)}"
    return out


def corpus(seed, n=260):
    """Texts with exact copies, near copies at many distances, chains, shared passages and odd texts."""
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(60)]
    passages = [" ".join(rng.choice(vocabulary) for _ in range(rng.choice([6, 12, 25]))) for _ in range(6)]
    bases = [[rng.choice(vocabulary) for _ in range(rng.choice([7, 30, 80]))] for _ in range(12)]
    texts = []
    while len(texts) < n:
        kind = rng.random()
        if kind < 0.5:
            texts.append(" ".join(edited(rng, rng.choice(bases), rng.choice([0, 0.01, 0.03, 0.05, 0.1]))))
        elif kind < 0.7:
            texts.append("\n".join(rng.sample(passages, rng.randrange(1, 5))))
        elif kind < 0.8 and texts:  # a chain: a copy of a copy
            texts.append(" ".join(edited(rng, texts[-1].split(), 0.02)))
        else:
            texts.append(" ".join(rng.choice(vocabulary) for _ in range(rng.randrange(0, 12))))
    return texts


@pytest.mark.parametrize("seed", [1, 2])
def test_groups_match_brute_force(spark, seed, monkeypatch):
    from lexmill.llm import shingle_join

    monkeypatch.setattr(shingle_join, "LONG_LIST", 8)  # so that frequent shingles are combined
    monkeypatch.setattr(shingle_join, "BLOCK_SETS", 4096 if seed == 1 else 3)
    docs = [(i * 3 + 1, t) for i, t in enumerate(corpus(seed))] + [(5000, None), (5001, ""), (5002, " \t\n"), (5003, "one two")]
    random.Random(seed).shuffle(docs)
    got = ngram_groups(spark, spark.createDataFrame(docs, "doc_id long, text string").repartition(3))
    assert sorted(map(tuple, got.collect())) == brute_groups(docs)


def test_groups_of_hot_shingles_match(spark, monkeypatch):
    from lexmill.llm import shingle_join

    real = shingle_join.ShingleJoin.count

    def count(self):
        out = real(self)
        self.hot[:] = True  # all shingles dealt by set
        return out

    monkeypatch.setattr(shingle_join.ShingleJoin, "count", count)
    docs = list(enumerate(corpus(7, 120)))
    got = ngram_groups(spark, spark.createDataFrame(docs, "doc_id long, text string"))
    assert sorted(map(tuple, got.collect())) == brute_groups(docs)


def test_groups_of_odd_tables(spark):
    assert ngram_groups(spark, spark.createDataFrame([], "doc_id long, text string")).collect() == []
    long = " ".join(f"x{i}" for i in range(60_000))
    rows = [(1, "a b c d e f", "k", 9), (1, "a b c d e f", "k", 9), (None, "a b c d e f", None, None), (2, long, "", 0), (3, long + " y", "", 0)]
    got = ngram_groups(spark, spark.createDataFrame(rows, "doc_id long, text string, component_id string, n int"))
    assert sorted(map(tuple, got.collect()), key=str) == sorted([(1, 2, 1), (1, 2, 1), (None, 2, None), (2, 59996, 2), (3, 59997, 2)], key=str)


@pytest.mark.parametrize("seed", [3, 4])
def test_lines_match_brute_force(spark, seed, monkeypatch):
    from lexmill.llm import shingle_join

    monkeypatch.setattr(shingle_join, "LONG_LIST", 8)
    rng = random.Random(seed)
    lines = corpus(seed, 200)
    docs = [(i, "\n".join(rng.sample(lines, rng.randrange(1, 5)))) for i in range(90)] + [(500, None), (501, "")]
    got = line_dedup(spark, spark.createDataFrame(docs, "doc_id long, text string").repartition(3))
    got = {r["doc_id"]: (r["text"], r["n_lines"], r["n_removed"]) for r in got.collect()}
    for (doc, text), want in zip(docs, brute_lines(docs), strict=True):
        n = 0 if text is None else text.count("\n") + 1
        assert got[doc][0] == want or (want == "" and got[doc][0] == ""), doc
        assert got[doc][1] == n


def test_lines_of_odd_tables(spark):
    empty = line_dedup(spark, spark.createDataFrame([], "doc_id long, text string"))
    assert empty.collect() == [] and empty.columns == ["doc_id", "text", "n_lines", "n_removed"]
    text = "first line of the text here\nsecond line of the text here"
    rows = [(7, text, 1), (7, text, 1), (None, text, 2), (None, None, 3)]
    got = line_dedup(spark, spark.createDataFrame(rows, "doc_id long, text string, n_lines int"))
    out = sorted(((r["doc_id"], r["text"], r["n_removed"]) for r in got.collect()), key=str)
    assert out == sorted([(7, text, 0), (7, "", 2), (None, "", 2), (None, None, 0)], key=str)


def test_units_beyond_a_packed_key():
    from lexmill.llm import shingles as S

    rng = random.Random(2)
    pairs = sorted((rng.choice([0, 1, 5]) + rng.choice([0, S.UNITS, 3 * S.UNITS]), rng.randrange(4) << 60 | rng.randrange(3)) for _ in range(300))
    unit, tokens = np.array([u for u, _ in pairs]), np.array([t for _, t in pairs], np.uint64)
    for rank in (None, (tokens & np.uint64(3)).astype(np.uint16)):
        u, t, at = S.distinct(unit, tokens, rank)
        want = sorted(set(pairs), key=lambda x: (x[0], x[1] & 3 if rank is not None else 0, x[1]))
        assert list(zip(u.tolist(), t.tolist(), strict=True)) == want
        assert (unit[at] == u).all() and (tokens[at] == t).all()


def test_lines_of_a_very_long_text(spark):
    from lexmill.llm.shingles import UNITS

    words = lambda k: " ".join(f"w{k}x{i}" for i in range(30))
    lines = [""] * (UNITS + 200)
    for k in range(20):
        lines[3 + k] = words(k)
        lines[UNITS + 3 + k] = words(k + 7) if k % 2 else words(k + 7) + " more"  # equal or near to an earlier line but for 7
    got = line_dedup(spark, spark.createDataFrame([(1, "\n".join(lines))], "doc_id long, text string")).first()
    kept = [x for x in got["text"].split("\n") if x]
    assert got["n_removed"] == 13 and len(kept) == 27 and kept[:20] == [words(k) for k in range(20)]
