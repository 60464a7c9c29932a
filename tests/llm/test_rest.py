"""URL filter, top-k search, toxicity, embedding dedup and the pipeline against brute force or known truth."""

import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from lexmill.llm import toxicity as tox
from lexmill.llm.embed_dedup import embedding_dedup
from lexmill.llm.knn import voronoi_knn
from lexmill.llm.queries import URL_RULES
from lexmill.llm.url_filter import url_filter

VECTORS = "vec_id long, embedding array<float>, label int"


def test_urls(spark):
    rng = random.Random(1)
    urls = [f"http://a{rng.randrange(50)}.example.{rng.choice(['org', 'com', 'net'])}/{rng.choice(['en', 'de', 'fr', 'es'])}/{rng.randrange(3000)}" for _ in range(300)]
    odd = [None, "", "no scheme", "HTTP://Sub.EXAMPLE.ORG/es/1?x=/#y", "http://example.org", "http://notexample.org/es/", "x://y?z", "a://B.com/fr/#f", "http://xorg/", "https://www.example.org/en/12"]
    rows = list(enumerate(urls + odd + odd[:2]))
    got = {r["page_id"]: r for r in url_filter(spark, spark.createDataFrame(rows, "page_id long, url string"), URL_RULES).collect()}
    assert len(got) == len(rows)
    verdicts = dict(URL_RULES)
    for i, url in rows:
        rest = url.split("://", 1)[1] if url and "://" in url else ""
        host = re.split("[/?#]", rest)[0]
        path = re.split("[?#]", rest[len(host) :])[0]
        host = "".join(c.lower() if c.isascii() else c for c in host)
        fits = [r for r in verdicts if (host == r.split("/")[0] or host.endswith("." + r.split("/")[0])) and path.startswith("/" + r.split("/", 1)[1])]
        rule = max(fits, key=len) if fits else None
        assert (got[i]["host"], got[i]["path"], got[i]["rule"]) == (host, path, rule)
        assert got[i]["verdict"] in ("allow", "block") and (not rule or got[i]["verdict"] == verdicts[rule])
    free = [r for r in got.values() if r["rule"] is None and r["host"].endswith("example.com")]
    assert free  # judged by the trees


def test_urls_without_labels(spark):
    df = spark.createDataFrame([(1, "http://x.net/a"), (2, None)], "page_id long, url string")
    assert {r["verdict"] for r in url_filter(spark, df, URL_RULES).collect()} == {"allow"}
    assert url_filter(spark, df.limit(0), URL_RULES).collect() == []


def test_trees_learn_lexical_features(spark):
    rules = [("good.com/", "allow"), ("bad.com/", "block")]
    rows = [(i, f"http://good.com/page/{i % 7}") for i in range(200)] + [(1000 + i, f"http://bad.com/a/b/c/d{i}?q={i}&r={i}&s=1") for i in range(200)]
    rows += [(5000 + i, f"http://other.com/page/{i}") for i in range(50)] + [(6000 + i, f"http://other.com/a/b/c/d{i}?q={i}&r={i}&s=2") for i in range(50)]
    got = {r["page_id"]: r["verdict"] for r in url_filter(spark, spark.createDataFrame(rows, "page_id long, url string"), rules).collect()}
    assert np.mean([got[5000 + i] == "allow" for i in range(50)]) > 0.9 and np.mean([got[6000 + i] == "block" for i in range(50)]) > 0.9


@pytest.mark.parametrize("block", [8192, 16])
def test_search_equals_brute_force(spark, monkeypatch, block):
    from lexmill.llm import knn

    monkeypatch.setattr(knn, "BLOCK_ROWS", block)
    rng = np.random.default_rng(2)
    centres = rng.normal(size=(5, 8)) * 50
    x = np.floor(centres[rng.integers(0, 5, 400)] + rng.normal(size=(400, 8)) * 6)
    x[50:80] = x[50]  # ties
    rows = [(int(i), [float(v) for v in r]) for i, r in enumerate(x)] + [(900, None), (901, []), (902, [1.0, None]), (903, [float("nan")] * 8), (904, [1.0, 2.0]), (7, [5.0] * 8)]
    df = spark.createDataFrame(rows, "id long, v array<double>").repartition(3)
    got = sorted(map(tuple, voronoi_knn(spark, df, df.where("id % 20 = 0 and id < 900"), k=5, pivots=7).collect()))
    good = [(i, np.array(v)) for i, v in rows if v and len(v) == 8 and all(c is not None and np.isfinite(c) for c in v)]
    want = []
    for q, v in good:
        if q % 20 == 0:
            scores = sorted(((-int(v @ w), i) for i, w in good if i != q))[:5]
            want += [(q, k + 1, i, -s) for k, (s, i) in enumerate(scores)]
    assert got == sorted(want)
    assert voronoi_knn(spark, df.limit(0), df.limit(0)).collect() == []


@pytest.mark.parametrize("rows", [2048, 16])
def test_embedding_groups_equal_brute_force(spark, monkeypatch, rows):
    from lexmill.llm import embed_dedup

    monkeypatch.setattr(embed_dedup, "INTERVAL_ROWS", rows)
    monkeypatch.setattr(embed_dedup, "SMALL", 8)
    rng = np.random.default_rng(4)
    base = rng.normal(size=(20, 12))
    x = base[rng.integers(0, 20, 200)] + rng.normal(size=(200, 12)) * rng.choice([0, 0.05, 0.12, 0.2], size=(200, 1))
    x = x.astype(np.float32)
    labels = [int(v) if v < 3 else None for v in rng.integers(0, 4, 200)]
    data = [(i * 2, [float(v) for v in r], y) for i, (r, y) in enumerate(zip(x, labels, strict=True))]
    odd = [(1001, None, 1), (1003, [0.0] * 12, 1), (1005, [float("inf")] * 12, 1), (1007, [1.0, None], 1), (1009, [], 1)]
    got = {r["vec_id"]: (r["n_links"], r["component_id"], r["kept"]) for r in embedding_dedup(spark, spark.createDataFrame(data + odd, VECTORS).repartition(3)).collect()}
    u = x.astype(float)
    u /= np.linalg.norm(u, axis=1)[:, None]
    link = (u @ u.T >= 0.98) & np.array([[a is not None and a == b for b in labels] for a in labels])
    np.fill_diagonal(link, False)
    comp = np.arange(200)
    for _ in range(200):
        comp = np.minimum(comp, np.where(link, comp[None, :], 10**6).min(1))
    for i in range(200):
        assert got[2 * i] == (int(link[i].sum()), 2 * int(comp[i]), bool(comp[i] == i))
    assert all(got[i] == (0, i, True) for i, *_ in odd)
    assert embedding_dedup(spark, spark.createDataFrame([], VECTORS)).collect() == []


def test_folding_and_matching():
    assert tox.fold("ID10T!! Тоxїс, naïve") == " idiot toxic naive "
    m = tox.Matcher({"idiot": 2.0, "lowei": 1.0}, ["village idiot"])
    assert m.features("an 1d1ot here")[0] == 2.0
    assert m.features("the village idiot sings")[0] == 0.0
    assert m.features("xidiot")[0] == 0.0 and m.features("loweischaft")[0] == 1.0
    assert m.features("")[0] == 0.0


def test_toxicity_is_learned(spark):
    rng = random.Random(3)
    words = ["".join(rng.choice("abcdefghij") for _ in range(6)) for _ in range(400)]
    docs, labels = [], []
    for i in range(900):
        text = " ".join(rng.choice(words) for _ in range(rng.randrange(5, 60)))
        bad = rng.random() < 0.2
        if bad:
            text += " " + rng.choice(["scumbag", "moronic", "sc4mbag".replace("4", "u")])
        docs.append((i, text, "x"))
        labels.append((i, 1, int(bad)))
    docs += [(None, None, None), (5000, "", "y"), (5001, " ".join(words) * 50, "z")]
    got = tox.toxicity(spark, spark.createDataFrame(docs, "doc_id long, text string, score string"), spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
    rows = got.collect()
    assert len(rows) == len(docs) and got.columns == ["doc_id", "held_out", "score", "predicted"]
    truth = {d: t for d, _, t in labels}
    held = [r for r in rows if r["held_out"] and r["doc_id"] in truth]
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in rows if r["doc_id"] is not None)
    assert np.mean([r["predicted"] == truth[r["doc_id"]] for r in held]) > 0.97
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5) for r in rows)
    none = tox.toxicity(spark, spark.createDataFrame(docs[:5], "doc_id long, text string, score string"), spark.createDataFrame([], "doc_id long, toxic int"))
    assert {r["predicted"] for r in none.collect()} == {0}


def test_exceptions_are_learned(spark):
    rng = random.Random(5)
    words = ["".join(rng.choice("abcdefghij") for _ in range(6)) for _ in range(300)]
    text = lambda middle="": " ".join([*rng.choices(words, k=rng.randrange(5, 20)), *middle.split(), *rng.choices(words, k=5)])
    docs, labels = [], []
    for i in range(700):
        toxic, harmless = i % 5 == 0, i % 35 == 1  # 140 toxic documents, 20 clean ones with a harmless phrase
        docs.append((i, text("zorgle" if toxic else ("zorgle lamp" if i % 70 == 1 else "zorglement") if harmless else "")))
        labels.append((i, int(toxic)))
    docs += [(10_000 + i, text("zorgle" if i < 10 else "zorgle lamp" if i < 20 else "zorglement")) for i in range(30)]
    d, lab = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, toxic int")
    model = tox.learn(spark, d, lab, exceptions=("given phrase",))
    assert {"given phrase", "zorgle lamp", "zorglement"} <= set(model["exceptions"])
    assert "zorgle" not in model["exceptions"]
    got = {r["doc_id"]: r["predicted"] for r in tox.toxicity(spark, d, lab).collect()}
    assert [got[10_000 + i] for i in range(30)] == [1] * 10 + [0] * 20


def test_exceptions_hold_what_brute_force_says():
    rng = random.Random(6)
    for _ in range(200):
        phrases = [" ".join(rng.choices(["aaaa", "aaab", "abab", "b"], k=rng.randrange(1, 4))) for _ in range(rng.randrange(4))]
        m = tox.Matcher({"aaa": 1.0, "abab ": 2.0}, phrases)
        folded = tox.fold(" ".join(rng.choices(["aaaa", "aaab", "abab", "b"], k=rng.randrange(1, 12))))
        spans = [(i, i + len(p) + 1) for p in phrases for i in range(len(folded)) if folded.startswith(f" {p} ", i)]
        want = {(i, i + len(e)) for e in ("aaa", "abab ") for i in range(len(folded)) if folded.startswith(" " + e, i)}
        want = {h for h in want if not any(s <= h[0] and h[1] <= e for s, e in spans)}
        assert {h[:2] for h in m.hits(folded)} == want


def test_pipeline_equals_brute_force(spark, tmp_path, monkeypatch):
    pytest.importorskip("corpus_pipeline")
    import corpus_pipeline
    from test_similarity import brute_groups_of, brute_lines
    from test_suffix_dedup import brute_kept

    rng = random.Random(9)
    vocabulary = [f"w{i}" for i in range(300)]
    text = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n))
    passage = text(150)
    docs, labels = [], []
    for i in range(80):
        t = "\n".join(text(rng.randrange(6, 40)) for _ in range(rng.randrange(1, 4)))
        if i % 9 == 0:
            t += "\n" + text(30) + " " + passage + " " + text(30)
        if i % 7 == 3:
            t += " filthyword"
        if i % 10 == 5:
            t = docs[-1][1]
        docs.append((i, t, "en", "s", len(t)))
        labels.append((i, 1, int("filthyword" in t)))
    docs += [(200, None, None, None, None), (201, "", "en", "s", 0)]
    spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    out = corpus_pipeline.run(spark, str(tmp_path)).collect()

    kept = [(d, t) for d, t, *_ in docs if "filthyword" not in (t or "")]
    lined = brute_lines(kept)
    kept = [(d, x) for (d, t), x in zip(kept, lined, strict=True) if x is None or x.strip() or not (t or "").strip()]
    kept = [(d, t) for (d, t), (_, _, c) in zip(kept, brute_groups_of(kept), strict=True) if c == d]
    cut = brute_kept(kept, 400)
    want = {d for (d, t), x in zip(kept, cut, strict=True) if t is None or x.strip() or not t.strip()}
    assert {r["doc_id"] for r in out} == want
    final = {d: x for (d, _), x in zip(kept, cut, strict=True)}
    from tokenizers import Tokenizer
    import public_tokenizers as P

    t = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    for d in want:
        ids = t.encode(final[d] or "", add_special_tokens=False).ids + [2]
        for r in (r for r in out if r["doc_id"] == d):
            assert r["ids_crc32"] == zlib.crc32(np.array(ids[r["start"] : r["start"] + r["length"]], "<u4").tobytes())
        assert sum(r["length"] for r in out if r["doc_id"] == d) == len(ids)


def test_pipeline_stages_keep_columns(spark, tmp_path):
    pipeline = pytest.importorskip("corpus_pipeline")
    empty = spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    for _, stage in pipeline.STAGES[:-1]:
        out = stage(spark, empty.withColumn("extra", F.lit(1)), str(tmp_path))
        assert out.columns == pipeline.COLUMNS and out.count() == 0
