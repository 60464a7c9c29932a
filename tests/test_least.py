"""Least likeness in clusters against all pairs of documents, with blocks small enough that many meet."""

from __future__ import annotations

import random
from difflib import SequenceMatcher

import pytest

from lexmill.operators import least as M
from lexmill.queries.registry import QUERIES


def ratio(a: str, b: str) -> float:
    return SequenceMatcher(None, a, b).ratio() if a and b else 0.0


def jaccard(a: str, b: str) -> float:
    a, b = set(a.split(" ")), set(b.split(" "))
    return len(a & b) / len(a | b)


def corpus():
    """(cluster, id, text): near copies, copies between others, repeated ids, long runs and odd characters."""
    r = random.Random(5)
    words = [f"{r.choice('abcdefghij')}{w}" for w in ("an", "ola", "Qu-", "été", "i]n", "u^s", "o\\r", "ment", "日本", "")]
    text = lambda n: " ".join(r.choice(words) for _ in range(n))
    rows = []
    for c in range(6):
        base = [text(n) for n in (3, 40, 120, 400)]
        for k in range(26):
            t = r.choice(base)
            cut = r.randrange(len(t))
            rows.append((c, r.randrange(60), r.choice([t, t[:cut] + text(2) + t[cut:], text(r.choice([1, 30, 200]))])))
    rows += [(7, 1, "x y"), (7, 2, "x y"), (8, 1, ""), (8, 2, ""), (9, 4, "a b"), (9, 4, "a c"), (10, 1, "seul")]
    return rows


def wanted(rows, of):
    found = {}
    for c, i, x in rows:
        for d, j, y in rows:
            if c == d and i < j:
                found[c] = min(found.get(c, 9.0), of(x, y))
    return found


@pytest.mark.parametrize("most", [4, 512])
def test_least_values(spark, monkeypatch, most):
    monkeypatch.setattr(M, "SETS", most)
    monkeypatch.setattr(M, "TEXTS", most)
    rows = corpus()
    df = spark.createDataFrame([*rows, (None, 1, "x"), (7, None, "z"), (7, 3, None)], "c int, i long, t string").repartition(3)
    got = {r["c"]: r["least"] for r in M.least_similarity(df, ["c"], "i", "t").collect()}
    assert got == wanted(rows, ratio)
    got = {r["c"]: r["least"] for r in M.least_jaccard(df, ["c"], "i", "t", " ").collect()}
    assert got == wanted(rows, jaccard)
    lists = df.selectExpr("c", "i", "split(t, ' ') as t")
    assert {r["c"]: r["least"] for r in M.least_jaccard(lists, ["c"], "i", "t").collect()} == got


def test_matcher():
    texts = [t for _, _, t in corpus()]
    r = random.Random(2)
    for _ in range(300):
        a, b = r.choice(texts), r.choice(texts)
        want, bound = SequenceMatcher(None, a, b).ratio(), r.random()
        got = M.Matcher(b).ratio(a, bound)
        assert M.Matcher(b).ratio(a) == want
        assert got == want if want < bound else bound <= got <= want


def test_members_meet_in_blocks(spark, monkeypatch):
    """Rows grow with members times blocks, never with pairs; copies are one member."""
    df = spark.range(3000).selectExpr("1 as c", "id as i", "concat('un texte ', id % 1000) as t")
    assert M._blocks(df, ["c"], "i", "t", M.F.length("t"), 2000).count() == 1000
    assert M._blocks(df, ["c"], "i", "t", M.F.length("t"), 100).count() <= 1000 * 13


DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def test_copies_count_on_both_sides(spark, tmp_path):
    """Document 2 stands between two copies: it is compared with the one as first and with the other as second text."""
    a, b = "abcd " * 50, "q" + "dbca " * 29 + "xxxx"
    assert len(a) % 50 == len(b) % 50 == 0 and ratio(b, a) < ratio(a, b)
    spark.createDataFrame([(1, a, "fr", "s", 0), (2, b, "fr", "s", 0), (3, a, "fr", "s", 0)], DOCS).write.parquet(f"{tmp_path}/documents.parquet")
    row = QUERIES["cluster_assessment"](spark, str(tmp_path)).first()
    assert row["min_similarity"] == round(ratio(b, a), 3)
    assert QUERIES["cluster_jaccard"](spark, str(tmp_path)).first()["n_pairs"] == 3
