"""Repeated byte strings against brute force."""

import hashlib
import random
import re
from collections import Counter

import numpy as np
import pytest

from lexmill.llm.suffix_dedup import RunIndex, suffix_dedup


def brute_kept(docs, length):
    """Kept text of each document (null stays null)."""
    raws = [(t or "").encode() for _, t in docs]
    seen = Counter(r[i : i + length] for r in raws for i in range(len(r) - length + 1))
    out = []
    for (_, t), r in zip(docs, raws, strict=True):
        gone = bytearray(len(r))
        for i in range(len(r) - length + 1):
            if seen[r[i : i + length]] > 1:
                gone[i : i + length] = b"\1" * length
        out.append(None if t is None else bytes(x for x, g in zip(r, gone, strict=True) if not g).decode("utf-8", "ignore"))
    return out


def brute(docs, length):
    raws = [(t or "").encode() for _, t in docs]
    seen = Counter(r[i : i + length] for r in raws for i in range(len(r) - length + 1))
    out = []
    for (d, _), r in zip(docs, raws, strict=True):
        gone = bytearray(len(r))
        for i in range(len(r) - length + 1):
            if seen[r[i : i + length]] > 1:
                gone[i : i + length] = b"\1" * length
        spans = sum(1 for i in range(len(gone)) if gone[i] and (i == 0 or not gone[i - 1]))
        kept = bytes(x for x, g in zip(r, gone, strict=True) if not g)
        out.append((d, len(r), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def corpus(seed, n=160):
    rng = random.Random(seed)
    word = lambda: rng.choice(["ab", "cde", "é", "fgh", "ij", "klm", "n"])
    passages = ["".join(word() for _ in range(k)) for k in (10, 20, 30, 60)]
    texts = ["a" * 300, "ab" * 120, "", None, "x"]
    while len(texts) < n:
        kind = rng.random()
        body = " ".join(word() for _ in range(rng.randrange(0, 60)))
        if kind < 0.5:
            at = rng.randrange(len(body) + 1)
            texts.append(body[:at] + rng.choice(passages) + body[at:])
        elif kind < 0.7:
            texts.append(rng.choice([t for t in texts if t]))
        elif kind < 0.85:
            t = list(rng.choice([t for t in texts if t]))
            t[rng.randrange(len(t))] = "Z"
            texts.append("".join(t))
        else:
            texts.append(body)
    return list(enumerate(texts))


def test_run_index_statistics():
    rng = np.random.default_rng(5)
    for _ in range(20):
        text = np.concatenate([rng.integers(0, 3, rng.integers(1, 60)), [100]])
        n = len(text)
        want = [max((next((k for k in range(n) if max(i, j) + k >= n or text[i + k] != text[j + k]), n) for j in range(n) if j != i), default=0) for i in range(n)]
        index = RunIndex(text)
        assert index.statistics().tolist() == want
        assert len(index.runs) <= n


@pytest.mark.parametrize("seed,index_bytes", [(1, 1 << 20), (2, 1 << 20), (3, 400), (4, 60)])
def test_matches_brute_force(spark, seed, index_bytes):
    docs = corpus(seed)
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    got = suffix_dedup(spark, df, length=40, gram=8, index_bytes=index_bytes, digest=True)
    assert sorted(map(tuple, got.collect()), key=str) == brute(docs, 40)


def test_long_texts_in_segments(monkeypatch):
    from lexmill.llm import suffix_dedup as module

    rng = np.random.default_rng(1)
    b = rng.integers(97, 101, 5000).astype(np.uint8)
    whole, parts = module.scan(b, 40, 8), module.scan(b, 40, 8, segment=300)
    for x, y in zip(whole, parts, strict=True):
        if x.dtype == np.uint64 and x is not whole[1] and x is not whole[4]:
            continue  # half hashes count only where the half is whole
        assert (x == y).all()


def test_odd_tables(spark):
    assert suffix_dedup(spark, spark.createDataFrame([], "doc_id long, text string"), digest=True).collect() == []
    rows = [(1, "q" * 450, "e", 1), (1, "q" * 450, "e", 1), (None, None, None, None), (2, "short", "e", 2)]
    out = suffix_dedup(spark, spark.createDataFrame(rows, "doc_id long, text string, lang string, n_removed int"))
    assert sorted(((r["doc_id"], r["text"], r["lang"], r["n_removed"]) for r in out.collect()), key=str) == sorted([(1, "", "e", 450), (1, "", "e", 450), (None, None, None, 0), (2, "short", "e", 0)], key=str)


def brute_words(docs, n):
    """Kept text of each document without the passages of n words that repeat."""
    found = [[m.span() for m in re.finditer(rb"[^\x20\x09-\x0D]+", (t or "").encode())] for _, t in docs]
    words = [[(t or "").encode()[a:z].lower() for a, z in at] for (_, t), at in zip(docs, found, strict=True)]
    seen = Counter(tuple(w[i : i + n]) for w in words for i in range(len(w) - n + 1))
    out = []
    for (_, t), at, w in zip(docs, found, words, strict=True):
        raw, gone = (t or "").encode(), bytearray(len((t or "").encode()))
        for i in range(len(w) - n + 1):
            if seen[tuple(w[i : i + n])] > 1:
                lo, hi = at[i][0], at[i + n - 1][1]
                gone[lo:hi] = b"\1" * (hi - lo)
        out.append(None if t is None else bytes(x for x, g in zip(raw, gone, strict=True) if not g).decode())
    return out


@pytest.mark.parametrize("seed,index_bytes", [(1, 1 << 20), (2, 1 << 20), (3, 300)])
def test_words_match_brute_force(spark, seed, index_bytes):
    rng = random.Random(seed)
    word = lambda: rng.choice(["a", "B", "é", "cd", "the", "longer-word", "x|y", "und"])
    space = lambda: rng.choice([" ", "  ", "\n", "\t"])
    passages = [[word() for _ in range(k)] for k in (9, 10, 11, 14, 40)]
    texts = [None, "", "a", "a " * 30, "  " + "the\n" * 9]
    while len(texts) < 120:
        of = [word() for _ in range(rng.randrange(25))]
        for _ in range(rng.randrange(3)):
            p = rng.choice(passages)
            of += p[: rng.randrange(7, len(p) + 1)] if rng.random() < 0.3 else p
            of += [word() for _ in range(rng.randrange(6))]
        texts.append("".join(w + space() for w in of))
    docs = list(enumerate(texts))
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    got = suffix_dedup(spark, df, length=100_000, index_bytes=index_bytes, words=10).collect()
    assert [r["text"] for r in sorted(got, key=lambda r: r["doc_id"])] == brute_words(docs, 10)


def test_pipeline_stage_finds_short_passages(spark, tmp_path):
    """Passages of over 50 words, below 400 bytes."""
    pipeline = pytest.importorskip("corpus_pipeline")
    rng = random.Random(7)
    text = lambda n: " ".join(rng.choice("abcdefghijklmnopq") + str(rng.randrange(999)) for _ in range(n))
    long, short = text(51), text(50)
    assert len(long) < 400
    docs = [(i, f"{text(30)} start{i} {p} end{i} {text(30)}", "en", "s", 0) for i, p in enumerate([long] * 3 + [short] * 3 + [text(60)])]
    out = pipeline.drop_repeats(spark, spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long"), str(tmp_path)).collect()
    got = {r["doc_id"]: r["text"] for r in out}
    assert got == {d: t.replace(long, "") for d, t, *_ in docs}
    assert all(r["n_chars"] == len(r["text"]) for r in out)


def test_query_finds_short_passages(spark, tmp_path):
    """The query's text loses passages of over 50 words below 400 bytes; the contract's columns stay those of 400-byte strings."""
    from lexmill.llm.queries import op2_suffix_dedup

    rng = random.Random(11)
    text = lambda n: " ".join(rng.choice("abcdefghijklmnopq") + str(rng.randrange(999)) for _ in range(n))
    short, few, long = text(51), text(50), text(120)
    assert len(short) < 400 < len(long)
    docs = [(i, f"{text(30)} start{i} {p} end{i} {text(30)}") for i, p in enumerate([short] * 3 + [few] * 3 + [long, long, text(60)])] + [(9, None), (10, "")]
    spark.createDataFrame(docs, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = {r["doc_id"]: r for r in op2_suffix_dedup(spark, str(tmp_path)).collect()}
    assert sorted((tuple(r)[:5] for r in got.values()), key=str) == brute(docs, 400)
    assert [got[d]["kept"] for d, _ in docs] == brute_kept(docs, 400)
    # strings that repeat hold what stands around a passage, too
    assert {d: r["text"] for d, r in got.items()} == {d: t and t.replace(short, "").replace(f" {long} end", "") for d, t in docs}


@pytest.mark.parametrize("seed", [1, 2])
def test_words_in_small_indexes(spark, seed):
    """Groups of more words than an index holds are split."""
    rng = random.Random(seed)
    passage = [rng.choice("abcdefgh") for _ in range(25)]
    docs = []
    for i in range(150):
        of = [rng.choice("abcdefgh") for _ in range(rng.randrange(15))] + passage[rng.randrange(12) : rng.randrange(13, 26)] + [rng.choice("abcdefgh") for _ in range(rng.randrange(15))]
        docs.append((i, " ".join(of)))
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    got = suffix_dedup(spark, df, length=100_000, words=10, index_words=40).collect()
    assert [r["text"] for r in sorted(got, key=lambda r: r["doc_id"])] == brute_words(docs, 10)
