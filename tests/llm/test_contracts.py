"""The contracts of the registered queries: each one as registered, repeated ids, clashing names, special tokens, evasions."""

import os
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from lexmill.llm import toxicity as tox
from lexmill.llm.embed_dedup import embedding_dedup
from lexmill.llm.knn import voronoi_knn
from lexmill.llm.line_dedup import line_dedup
from lexmill.llm.ngram_join import ngram_groups
from lexmill.llm.suffix_dedup import suffix_dedup

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
OWN = sorted(n for n in entry.queries() if n.startswith("op") or n == "pipeline")
COLUMNS = {
    "op1": ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"],
    "op2": ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"],
    "op3": ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
    "op4": ["doc_id", "start", "n_tokens", "ids_crc32"],
    "op5": ["page_id", "host", "path", "rule", "verdict"],
    "op6": ["query_id", "rank", "vec_id", "score"],
    "op8": ["doc_id", "held_out", "score", "predicted"],
    "op9": ["vec_id", "n_links", "component_id", "kept"],
    "op10": ["doc_id", "n_shingles", "component_id"],
}


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")
@pytest.mark.parametrize("name", OWN)
def test_as_registered(spark, name):
    import duckdb

    got = entry.queries()[name](spark, SF)
    rows = got.collect()
    assert rows and set(COLUMNS.get(name.split("_")[0], [])) <= set(got.columns)
    table = {"op5": "pages", "op6": None, "op9": "embeddings"}.get(name.split("_")[0], "documents")
    con = duckdb.connect()
    for t in ("documents", "embeddings", "pages", "labels"):
        con.sql(f"create view {t} as select * from read_parquet('{SF}/{t}.parquet')")
    if table and name not in ("op1_best_fit_packing", "pipeline"):
        assert len(rows) == con.sql(f"select count(*) from {table}").fetchall()[0][0]
    if name in entry.oracle_sql():
        want = con.sql(entry.oracle_sql()[name])
        order = [got.columns.index(c) for c in want.columns]
        assert sorted(tuple(r[i] for i in order) for r in rows) == sorted(want.fetchall())


def test_special_tokens_are_the_library_s():
    P = pytest.importorskip("public_tokenizers")
    from tokenizers import Tokenizer

    from lexmill.llm.vocab import Encoder

    texts = ["end <|endoftext|> x", "<|endoftext|>", "a<|ENDOFTEXT|>b", "  <|startoftext|> y", "plain text", "half <|end", "<unk> <pad> [UNK]"]
    for name, kind in (("byte_bpe_50k.json", "byte"), ("word_bpe_49k.json", "word")):
        library, own = Tokenizer.from_file(P.path(name)), Encoder(P.path(name), kind)
        for text in texts:
            want = library.encode(text, add_special_tokens=False).ids
            assert np.frombuffer(own.ids(text), "<u4").tolist() == want, text


def test_repeated_vector_ids(spark):
    up, side = [1.0, 0.0, 0.0, 0.0], [0.0, 1.0, 0.0, 0.0]
    rows = [(1, up, 0, "x"), (1, side, 0, "x"), (2, up, 0, "x"), (3, side, 0, "x"), (4, side, 0, "x"), (4, side, 0, "x"), (5, up, 1, "x")]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int, id string").repartition(3)
    got = sorted(map(tuple, embedding_dedup(spark, df).collect()))
    assert got == sorted([(1, 1, 1, True), (1, 3, 1, True), (2, 1, 1, False), (3, 3, 1, False), (4, 3, 1, False), (4, 3, 1, False), (5, 0, 5, True)])


def test_search_with_repeated_ids(spark):
    rng = random.Random(4)
    rows = [(rng.randrange(12), [float(rng.randrange(-2, 3)) for _ in range(3)], "c") for _ in range(60)]
    df = spark.createDataFrame(rows, "id long, v array<double>, cell string").repartition(3)
    got = sorted(map(tuple, voronoi_knn(spark, df, df.where("id % 4 = 0"), k=5, pivots=5).collect()))
    want = []
    for n, (q, v, _) in enumerate(rows):
        if q % 4 == 0:
            scores = sorted((-int(np.dot(v, w)), i) for m, (i, w, _) in enumerate(rows) if m != n)[:5]
            want += [(q, k + 1, i, -s) for k, (s, i) in enumerate(scores)]
    assert got == sorted(want)


def test_clashing_columns(spark):
    text = "one line of several words here\nand another line of words"
    rows = [(1, text, 10, "a", "s", 1), (2, text, 11, "b", "s", 1), (3, "z" * 900, 12, "c", "s", 1), (4, "z" * 900, None, "d", "s", 1)]
    df = spark.createDataFrame(rows, "doc_id long, text string, row int, __spans string, sig string, n_lines int").repartition(2)
    lined = line_dedup(spark, df)
    assert lined.columns == ["doc_id", "text", "row", "__spans", "sig", "n_lines", "n_removed"]
    got = {r["doc_id"]: (r["text"], r["row"], r["__spans"], r["n_removed"]) for r in lined.collect()}
    assert got == {1: (text, 10, "a", 0), 2: ("", 11, "b", 2), 3: ("z" * 900, 12, "c", 0), 4: ("", None, "d", 1)}
    cut = suffix_dedup(spark, df)
    assert cut.columns == [*df.columns, "n_removed"]
    got = {r["doc_id"]: (r["text"], r["row"], r["__spans"], r["n_removed"]) for r in cut.collect()}
    assert got == {1: (text, 10, "a", 0), 2: (text, 11, "b", 0), 3: ("", 12, "c", 900), 4: ("", None, "d", 900)}
    digest = {r["doc_id"]: (r["n_bytes"], r["n_removed"], r["text"]) for r in suffix_dedup(spark, df, digest=True, with_text=True).collect()}
    assert digest[3] == (900, 900, "") and digest[1] == (len(text), 0, text)
    groups = {r["doc_id"]: r["component_id"] for r in ngram_groups(spark, df.withColumnRenamed("sig", "component")).collect()}
    assert groups == {1: 1, 2: 1, 3: 3, 4: 3}


def test_evasions_fold():
    assert tox.fold("f​oo b­ár") == " foo bar "
    assert tox.fold("\U0001d41f\U0001d428\U0001d428 ｆｏｏ") == " foo foo "
    assert tox.fold("a b—c") == " a b c "
    long = "x" * 60
    assert tox.Matcher({long + " ": 2.0}, []).features(f"a {long} b")[0] == 2.0
    assert long + " " in tox.starts(tox.fold(long))


def test_scores_equal_a_plain_matcher(spark):
    """Scores against a matcher that looks for every entry at every word start."""
    rng = random.Random(8)
    entries, phrases = {"abab": 1.5, "abab ": 2.5, "bbaa": 1.0}, ["abab bbaa"]
    model = {"lexicon": entries, "exceptions": phrases, "curve": [-2.0, 0.5, 1.0]}
    words = ["abab", "ababb", "bbaa", "bbaab", "cc"]
    docs = [(i, " ".join(rng.choices(words, k=rng.randrange(0, 30)))) for i in range(300)] + [(300, None), (301, "abab " * 20_000)]
    got = {r["doc_id"]: r["score"] for r in tox.score(spark.createDataFrame(docs, "doc_id long, text string"), model).collect()}
    for d, text in docs:
        folded = tox.fold(text or "")
        spans = [(i, i + len(p) + 1) for p in phrases for i in range(len(folded)) if folded.startswith(f" {p} ", i)] if d < 300 else []
        best = {}
        for i in (i for i, c in enumerate(folded) if c == " "):
            for e, w in entries.items():
                if folded.startswith(" " + e, i) and not any(s <= i and i + len(e) <= t for s, t in spans):
                    best[i] = max(best.get(i, 0.0), w)
        n = len(folded.split())
        total = sum(best.values())
        x = -2.0 + 0.5 * total + (total / n**0.5 if n else 0.0)
        assert got[d] == pytest.approx(1 / (1 + np.exp(-np.clip(x, -30, 30))))


def test_blank_leftovers_go(spark):
    pipeline = pytest.importorskip("corpus_pipeline")
    rows = [(1, "\n\t ", 3), (2, " \n", 0), (3, None, 1), (4, "x\n", 2), (5, "", 1)]
    got = pipeline._emptied(spark.createDataFrame(rows, "doc_id long, text string, n_removed long")).collect()
    assert sorted(r["doc_id"] for r in got) == [2, 3, 4]


def test_fold_is_the_crc(spark):
    got = spark.range(50).select("id", tox.fold_of(F.col("id")).alias("f")).collect()
    assert all(r["f"] == zlib.crc32(str(r["id"]).encode()) % 5 for r in got)
