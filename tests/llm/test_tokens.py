"""Tokenising operators against the libraries."""

import base64
import hashlib
import zlib

import numpy as np
import pytest

P = pytest.importorskip("public_tokenizers")

from lexmill.llm.bpe import RankFile, bpe_round_trip  # noqa: E402
from lexmill.llm.packing import best_fit_packing, pack, sweep  # noqa: E402
from lexmill.llm.token_files import BLOCK, decode, encode, read_token_files, write_token_files  # noqa: E402

TEXTS = [
    "",
    None,
    "Hello there, it's a test.  Two  spaces\n\nand lines\t42!",
    "Été à l'école: «ça va?» ß ñ Ünï — naïve…",
    "русский текст и 中文字 😀 <|endoftext|>",
    "a" * 700,
    " ".join(f"word{i}" for i in range(3000)),
    "\x1c odd \x85 spaces ​ here",
]


def library(name):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(P.path(name))
    return lambda text: t.encode(text or "", add_special_tokens=False).ids


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def table(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string")


def test_bpe_equals_tiktoken(spark):
    import tiktoken

    path = P.path("byte_bpe_multi_50k.tiktoken")
    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    enc = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    got = {r["doc_id"]: r for r in bpe_round_trip(table(spark, list(enumerate(TEXTS))), path, P.PATTERN, with_output=True).collect()}
    for i, text in enumerate(TEXTS):
        want = enc.encode_ordinary(text or "")
        assert got[i]["ids"] == want and got[i]["n_tokens"] == len(want)
        assert got[i]["ids_sha256"] == hashlib.sha256(",".join(map(str, want)).encode()).hexdigest()
        assert bytes(got[i]["decoded"]) == (text or "").encode()
        assert got[i]["decoded_sha256"] == hashlib.sha256((text or "").encode()).hexdigest()


def test_recursion_contracts_leftmost_least(tmp_path):
    ranks = {bytes([b]): b for b in range(256)} | {b"ab": 300, b"bc": 299, b"abc": 301, b"aa": 302}
    path = tmp_path / "own.tiktoken"
    path.write_bytes(b"\n".join(base64.b64encode(k) + b" " + str(v).encode() for k, v in ranks.items()))
    file = RankFile(str(path))
    words = [b"abc", b"aaaaa", b"aab", b"x"]
    ids = file.encode(words)
    assert ids == [[301], [302, 302, 97], [97, 300], [120]]
    assert file.decode(ids) == words


def test_simple8b_round_trip():
    rng = np.random.default_rng(0)
    for n in (0, 1, 5, BLOCK, BLOCK + 1, 5000):
        ids = rng.integers(0, 1 << rng.integers(1, 60, n, dtype=np.int64), dtype=np.uint64) if n else np.zeros(0, np.uint64)
        if n > 4:
            ids[3] = (1 << 63) + 7
            ids[4] = 1 << 60
        words, blocks, literals = encode(ids)
        assert (decode(words, literals) == ids).all()
        if n > BLOCK:
            assert (decode(words[blocks[1] :], literals) == ids[BLOCK:]).all()
    assert len(encode(np.ones(6000, np.uint64))[0]) < 150  # sixty ids a word inside a block


def test_token_files(spark, tmp_path):
    ids = library("word_bpe_49k.json")
    rows = list(enumerate(TEXTS))[::-1] + [(3, "again"), (None, "no id")]
    path = str(tmp_path / "files")
    write_token_files(table(spark, rows).repartition(3), path, P.path("word_bpe_49k.json"))
    got = sorted(read_token_files(spark, path).collect(), key=lambda r: r["start"])
    at = 0
    for r in got:
        assert r["start"] == at
        at += r["n_tokens"]
    assert [r["doc_id"] for r in got] == sorted([r[0] for r in rows], key=lambda d: -1 if d is None else d)
    by_id = {r["doc_id"]: r for r in got if r["doc_id"] not in (3, None)}
    for i, text in enumerate(TEXTS):
        if i != 3:
            want = ids(text) + [1]
            assert by_id[i]["n_tokens"] == len(want) and by_id[i]["ids_crc32"] == crc(want)
    write_token_files(table(spark, []), str(tmp_path / "none"), P.path("word_bpe_49k.json"))
    assert read_token_files(spark, str(tmp_path / "none")).collect() == []


def valid(rows, capacity):
    by = {}
    for r in rows:
        by.setdefault(r["sequence_id"], []).append(r)
    for members in by.values():
        at = 0
        for r in sorted(members, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert at <= capacity
    return len(by)


def test_packing(spark):
    ids = library("byte_bpe_50k.json")
    rows = list(enumerate(TEXTS * 4)) + [(1, "twice"), (1, "twice"), (None, "no id")]
    out = best_fit_packing(spark, table(spark, rows), P.path("byte_bpe_50k.json"), with_ids=True).collect()
    valid(out, 1024)
    for i in range(4, 8):
        want = ids(TEXTS[i]) + [2]
        parts = sorted((r for r in out if r["doc_id"] == i), key=lambda r: r["piece"])
        assert [r["piece"] for r in parts] == list(range(len(parts)))
        assert all(r["length"] == 1024 for r in parts[1:])
        assert b"".join(bytes(r["ids"]) for r in parts) == np.array(want, "<u4").tobytes()
        for r in parts:
            assert r["ids_crc32"] == crc(want[r["start"] : r["start"] + r["length"]])
    assert sum(r["doc_id"] is None for r in out) == 1 and sum(r["doc_id"] == 1 for r in out) == 3
    assert best_fit_packing(spark, table(spark, []), P.path("byte_bpe_50k.json")).collect() == []


def best_fit_decreasing(sizes, capacity):
    import bisect

    gaps, n = [], 0
    for s in sorted(sizes, reverse=True):
        i = bisect.bisect_left(gaps, s)
        room = capacity if i == len(gaps) else gaps.pop(i)
        n += i == len(gaps) and room == capacity
        bisect.insort(gaps, room - s)
    return n


@pytest.mark.parametrize("bands", [100_000, 8])
def test_packing_is_as_tight_as_best_fit_decreasing(spark, bands):
    rng = np.random.default_rng(3)
    sizes = np.concatenate([rng.integers(1, 65, 700), np.full(400, 20)])
    cut = spark.createDataFrame([(i, 0, 0, int(s), 0) for i, s in enumerate(sizes)], "doc_id long, piece int, start long, length long, ids_crc32 long")
    out = pack(spark, cut, 64, single_sweep_runs=bands).collect()
    assert len(out) == len(sizes)
    assert valid(out, 64) <= 1.02 * best_fit_decreasing(sizes.tolist(), 64) + 1


def test_sweep_prefers_the_longest_that_fits():
    matches, waiting, gaps = sweep([(5, 0, 1), (7, 0, 2), (9, 0, 1)], [(7, 0, 1), (8, 1, 1)])
    assert [(m[0], m[3]) for m in matches] == [(7, 7), (7, 8)]
    assert sorted(waiting) == [(5, 0, 1), (9, 0, 1)] and gaps == [(1, 1, 1)]


def test_long_pieces_equal_tiktoken(spark):
    import random

    import tiktoken

    path = P.path("byte_bpe_multi_50k.tiktoken")
    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    enc = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    rng = random.Random(5)
    some = sorted(t for t in ranks if 2 <= len(t) <= 6 and t.isalpha())[::7]
    texts = ["".join(rng.choice("abcdefghij") for _ in range(3000)), "ab" * 2000, "é" * 900, "-" * 700 + "=" * 301, "a" * 60_000]
    for _ in range(30):
        few = rng.sample(some, rng.choice([2, 3, 8, 40]))
        texts.append(b"".join(rng.choice(few) for _ in range(150)).decode("latin-1"))
    rows = [*enumerate(texts), (0, texts[0]), (None, "word"), (None, None)]
    got = bpe_round_trip(spark.createDataFrame([(d, t, 1) for d, t in rows], "doc_id long, text string, n_tokens int"), path, P.PATTERN, with_output=True).collect()
    assert len(got) == len(rows)
    for r in got:
        if r["doc_id"] is not None:
            assert r["ids"] == enc.encode_ordinary(texts[r["doc_id"]])
            assert bytes(r["decoded"]) == texts[r["doc_id"]].encode()
    assert bpe_round_trip(table(spark, []), path, P.PATTERN).collect() == []
