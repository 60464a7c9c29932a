"""Queries look at all rows and whole texts: small tables against brute force."""

from __future__ import annotations

import hashlib

from lexmill.queries.registry import QUERIES


def put(spark, folder, name, rows, schema):
    spark.createDataFrame(rows, schema).write.parquet(f"{folder}/{name}.parquet")
    return str(folder)


LINES = "l_orderkey long, l_linenumber int, l_partkey long, l_suppkey long, l_quantity double, l_extendedprice double"


def test_grids_of_all_orders(spark, tmp_path):
    rows = [(o, n, 9 if n == o % 8 else 10, o % 7, 40.0 + o % 10, 1.0) for o in range(1, 120) for n in range(1, 8)]
    at = put(spark, tmp_path, "lineitem", rows, LINES)
    got = {tuple(r) for r in QUERIES["table_row_sum"](spark, at).collect()}
    assert got == {(o, 2, n - 1, q + n + 5, q + n) for o, n, p, _, q, _ in rows if p == 9}
    totals = {o: sum(r[4] for r in rows if r[0] == o) for o in range(2, 120, 2)}
    got = {(r["id"], r["col_no"]): r["total"] for r in QUERIES["table_total"](spark, at).collect()}
    assert got == {(o, 0): s for o, s in totals.items()}


DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def test_clusters_compare_whole_texts(spark, tmp_path):
    head = " ".join(f"w{i}" for i in range(150))  # more than 400 characters
    tails = {1: "a" * 900, 2: "b" * 900}
    docs = [(k, f"{head} {t}", "fr", "s", 0) for k, t in tails.items()] + [(k + 10, f"{x * 450} {head}", "en", "s", 0) for k, x in ((1, "c"), (2, "d"))]
    at = put(spark, tmp_path, "documents", docs, DOCS)
    got = {r["lang"]: r for r in QUERIES["cluster_jaccard"](spark, at).collect()}
    assert {k: r["min_jaccard"] for k, r in got.items()} == {"fr": round(150 / 152, 6), "en": round(150 / 152, 6)}
    tiers = {r["lang"]: (r["min_jaccard"], r["tier"], r["min_similarity"] < 0.85) for r in QUERIES["cluster_assessment"](spark, at).collect()}
    # each pair differs by more than a fifth of its text, at the end or at the front
    assert {k: v[0] for k, v in tiers.items()} == {"fr": 0.987, "en": 0.987}
    assert tiers["fr"][2]


def test_keys_of_whole_texts(spark, tmp_path):
    texts = {1: "# Un  Mot " * 60 + "fin", 2: "# Un  Mot " * 60 + "FIN\n", 3: "# Un  Mot " * 60 + "autre", 4: "court"}
    at = put(spark, tmp_path, "documents", [(k, x, "fr", "s", 0) for k, x in texts.items()], DOCS)
    got = {r["doc_id"]: r["line_sha"] for r in QUERIES["clean_keys"](spark, at).collect()}
    assert got == {k: hashlib.sha256(" ".join(x.lstrip("# ").split()).lower().encode()).hexdigest() for k, x in texts.items()}


def test_math_of_all_lines(spark, tmp_path):
    rows = [(o, n, 1, 1, float(o + n), 1.0) for o in range(1, 40) for n in range(1, o % 7 + 2)]
    at = put(spark, tmp_path, "lineitem", rows, LINES)
    got = sorted(tuple(r) for r in QUERIES["unescape_math"](spark, at).collect())
    assert got == [(o, n, f"Loi N° {n} du 1er mai, soit $x+y$ et {q} %", 1) for o, n, _, _, q, _ in rows]


def test_manifest_of_all_documents(spark, tmp_path):
    docs = [(k, f"text {k}", "fr", "s", 0) for k in range(1500)] + [(1501, "text 3", "fr", "s", 0)]
    at = put(spark, tmp_path, "documents", docs, DOCS)
    got = {r["doc_id"]: r["verdict"] for r in QUERIES["manifest_backfill"](spark, at).collect()}
    want = {k: "changed" if k % 6 == 0 else "existing" if k % 3 == 0 else "new" for k, *_ in docs}
    assert got == want | {1501: "duplicate"}


def test_command_line(spark, tmp_path, capsys):
    from lexmill.__main__ import main
    from lexmill.plans.audit import write_report

    at = put(spark, tmp_path, "documents", [(1, "un lac", "fr", "s", 6), (2, None, None, None, None)], DOCS)
    assert main(["list"]) == 0 and "quality_score *" in capsys.readouterr().out
    assert main(["run", "quality_score", "--tables", at, "--out", f"{tmp_path}/out", "--format", "json"]) == 0
    assert spark.read.json(f"{tmp_path}/out").count() == 2
    write_report(spark.createDataFrame([(1, None), (2, "x")], "a int, b string"), f"{tmp_path}/report")
    assert sorted(r[0] for r in spark.read.text(f"{tmp_path}/report").collect()) == ['{"a":1,"b":null}', '{"a":2,"b":"x"}']


def test_equal_intervals_by_key(spark, tmp_path):
    import datetime

    # orders 90 keys apart have equal intervals: only the one of least key doesn't overlap an earlier one
    day = datetime.datetime(2020, 5, 4)
    rows = [(k, c, day) for c in range(20) for k in range(c + 900, c, -90)] + [(5, 77, None), (6, 77, None), (7, 77, day)]
    at = put(spark, tmp_path, "orders", rows, "o_orderkey long, o_custkey long, o_orderdate timestamp")
    got = {(r["o_custkey"], r["o_orderkey"]) for r in QUERIES["interval_overlap"](spark, at).collect()}
    assert got == {(c, k) for k, c, d in rows if c < 77 and k > c + 90}
