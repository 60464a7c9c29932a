"""Cleaners, classifiers, pages, acts, grids and math escapes on our own sentences."""

import pytest
from pyspark.sql import functions as F

from lexmill.functions import classify as C
from lexmill.functions import clean as K
from lexmill.functions import latex
from lexmill.functions.quality import with_quality
from lexmill.operators import acts, grids
from lexmill.operators import lines as L


def values(spark, column, rows):
    df = spark.createDataFrame([(i, r) for i, r in enumerate(rows)], "i int, x string")
    return [r["y"] for r in df.select("i", column(F.col("x")).alias("y")).orderBy("i").collect()]


def test_cleaners(spark):
    assert values(spark, K.bare_line, ["## **Titre** ", "> * Art. 1 *", None]) == ["Titre", "Art. 1", None]
    assert values(spark, K.path_component, ["Été 2020/A", "--", None, "a__b"]) == ["t-2020-a", "document", "document", "a__b"]
    assert values(spark, K.fix_confusions, ["l0i du Artide 1", "N° o 3 ﬁ xe"]) == ["LOI du Article 1", "N° 3 fixe"]
    assert values(spark, K.strip_invisible, ["a​b﻿"]) == ["ab"]
    assert values(spark, K.is_banner_noise, ["p.11\nTitre I : A", "", "p.11\nun texte"]) == [True, True, False]
    assert values(spark, K.dehyphenate, ["la mai-\nson est\ngrande\n\nfin"]) == ["la maison est grande\n\nfin"]
    text = ["<p>x</p><ARTICLE a='1'>Un <b>lac</b> &amp; <script>y</script>une mer</ARTICLE>", "&lt;b"]
    assert values(spark, K.html_text, text) == ["Un lac & une mer", "<b"]


def test_quality(spark):
    rows = [(1, "Un texte propre et clair."), (2, "x � � � �"), (3, ""), (4, None), (5, "q z k v b r p w f g")]
    got = {r["i"]: r["score"] for r in with_quality(spark.createDataFrame(rows, "i int, text string")).collect()}
    assert got[1] == got[3] == got[4] == 1.0 and got[2] == 0.0 and got[5] == 0.0


def test_titles(spark):
    titles = ["Décret n° 12-2020 du 3 mai 2020 portant création", "loi organique n° 007/2021", "Convention collective des lacs", "Rapport annuel", "Texte citant la LOI", "Rien"]
    assert values(spark, C.act_type, titles) == ["DECRET", "LOI", "CONVENTION_COLLECTIVE", "RAPPORT", "LOI", "TEXTE"]
    assert [str(d) if d else None for d in values(spark, C.french_date, [*titles[:1], "le 31 février 2020", "le 1er mai 2020", "le 9 AOÛT 1999"])] == ["2020-05-03", None, None, "1999-08-09"]
    assert values(spark, C.act_keyword, titles[:3]) == ["DECRET", "LOI ORGANIQUE", "CONVENTION"]
    assert values(spark, lambda x: C.normal_number(C.act_number(x)), [titles[1], "LOI N\\* 25-80"]) == ["7-2021", "25-80"]
    assert values(spark, C.ordinal, ["premier", "12", "12 bis", "16-1", "1.11", "14 a)", "3 nouveau", "x", "7er"]) == [1, 12, None, None, None, None, None, None, 7]
    assert values(spark, C.original_number, ["5_doublon_2", "5"]) == ["5", None]
    assert values(spark, lambda x: C.source_of(x)["kind"], ["sgg/JO/a.pdf", "sgg/JOx", "code-penal/b"]) == ["journal_officiel", "inconnu", "code"]
    assert values(spark, lambda x: C.issue_filename(x)["number"], ["congo-jo-2020-007-sp.pdf", "autre.pdf"]) == ["7", None]


def test_decisions(spark):
    text = "Arrêt N° 12/2021 du 4 juin 2021 Deuxième chambre ; l'article 5 de l'Acte uniforme portant sur les lacs, puis articles 1 et 2 du Code civil."
    head = values(spark, C.decision_header, [text])[0]
    assert (head["number"], str(head["date"]), head["chamber"]) == ("12/2021", "2021-06-04", "Deuxième chambre")
    cites = values(spark, C.citations, [text])[0]
    assert [(c["article"], c["label"]) for c in cites] == [("5", "portant sur les lacs"), (None, None)]
    assert values(spark, C.parties, ["Affaire : Lac (Conseil : Maître A) contre Mer ; suite"]) == ["Lac contre Mer"]


def test_math_escapes():
    assert latex.clean("le $1^{\\text{er}}$ mai") == ("le 1er mai", [])
    assert latex.clean("$\\mathbf{N}^{\\circ}$ 3")[0] == "N° 3"
    assert latex.clean("Le $_{S}$ lacs")[0] == "Les lacs"
    assert latex.clean("soit $x+y$ et \\frac{1}{2}")[0] == "soit $x+y$ et \\frac{1}{2}"
    assert latex.clean("soit $x^{2}+y$")[1] == ["$x^{2}+y$"]
    assert latex.clean(latex.clean("5$^{\\circ}$ et 10 $\\%$")[0])[0] == latex.clean("5$^{\\circ}$ et 10 $\\%$")[0]


def test_math_escapes_more():
    """Endings, numbers and signs of our own sentences; formulas and money stay."""
    plain = {
        "au  $2^{e}$  rang": "au 2e rang",
        "la  $3^{\\mathrm{e}}$  file": "la 3e file",
        "les  $\\mathbf{n}^{\\text{os}}$  4 et 5": "les nos 4 et 5",
        "tour 2  $^{e}$  étage": "tour 2e étage",
        "soit  $12\\%$  net": "soit 12% net",
        "$Leu_{R}$  toit": "Leur toit",
        "un  $\\pmb{\\mathrm{n}}^{\\circ}$  7": "un n° 7",
    }
    for text, want in plain.items():
        assert latex.clean(text)[0] == want
        assert latex.clean(want)[0] == want
    for text in ["5 $ puis 6 $", "un $a$ b", "le  $y^{n}$  croît", "la  $w_{i}$  baisse", "soit  $\\sqrt{2}$", "prix $4\n5$ ici", "un  $\\text{a^{b}}$  x", "un  $\\mathbf{n$  x"]:
        assert latex.clean(text)[0] == text


def test_splitting_acts(spark):
    text = "\n".join([
        "Décret n° 1-2020 du 3 mai 2020 (page 4)", "Loi n° 2-2020 du 4 mai 2020 portant", "création des lacs", "Vu la charte et la", "Loi n° 9 du 6 juin 1990 ;", "Article 1 : x.", "",
        "le présent arrêté sera publié.", "arrêté sera suspendu sans suite", "", "Arrêté n° 3 du 5 mai 2020", "LE MINISTRE,", "Article 1 : y.",
    ])
    rows = acts.split_acts(spark.createDataFrame([(1, text), (2, ""), (3, None)], "d int, text string"), "d", "text").orderBy("d", "act_no").collect()
    assert [(r["d"], r["act_no"]) for r in rows] == [(1, 0), (1, 1)]
    assert [(r["title"], r["content"].split("\n")[0]) for r in rows] == [("Loi n° 2-2020 du 4 mai 2020 portant création des lacs", "Vu la charte et la"), ("Arrêté n° 3 du 5 mai 2020", "LE MINISTRE,")]


def test_act_copies(spark):
    rows = [(1, 0, "Loi n° 5", "court", "LOI"), (1, 1, "Loi n° 5", "bien plus long", "LOI"), (1, 2, "Discours", "a", "DISCOURS"), (1, 3, "Discours", "b", "DISCOURS"), (1, 4, "Loi N° 5", "bien aussi long", "LOI")]
    df = spark.createDataFrame(rows, "d int, act_no int, title string, content string, type string")
    assert sorted(r["act_no"] for r in acts.longest_copies(df, "d").collect()) == [2, 3, 4]


def test_furniture(spark):
    text = ["Une phrase", "12", "Journal officiel de la République du Congo", "", "Du jeudi 4 mai 2020", "la suite", "13", "publié au", "Journal officiel de la République du Congo."]
    df = spark.createDataFrame([(1, i, x) for i, x in enumerate(text)], "d int, line_no int, line string")
    out = L.furniture(df, "d").orderBy("line_no").collect()
    assert [r["line_no"] for r in out if r["is_furniture"]] == [1, 2, 4]
    kept = df.join(L.furniture(df, "d").where("not is_furniture").select("d", "line_no"), ["d", "line_no"])
    assert L.furniture(kept, "d").where("is_furniture").count() == 0  # a fixed point


def test_pages(spark):
    text = "avant\n[[DOC_PAGE:1]]\nune page avec assez de texte\n[[DOC_PAGE:3]]\ncourt\n[[DOC_PAGE:1]]\nencore la page une, plus longue"
    pages = L.page_texts(spark.createDataFrame([(1, text)], "d int, t string"), "d", "t")
    assert sorted((r["page"], r["content"]) for r in pages.collect()) == [(1, "encore la page une, plus longue"), (3, "court")]
    assert sorted(r["page"] for r in L.page_gaps(pages, "d").collect()) == [2, 3]
    index = [("une page avec assez", 4), ("autre ligne entière", 5)]
    df = spark.createDataFrame([(1, "## Une page avec assez de mots\nx\nautre ligne entière ici", index)], "d int, t string, i array<struct<norm:string,page:int>>")
    assert L.annotate(df, "t", "i").first()["annotated"] == "[[DOC_PAGE:4]]\n## Une page avec assez de mots\nx\n[[DOC_PAGE:5]]\nautre ligne entière ici"


def test_layout(spark):
    block = "struct<type:string,lines:array<struct<spans:array<struct<content:string,html:string>>>>>"
    rows = [(1, 0, [("title", [([("Un", None), ("titre", None)],)])], []), (1, 1, [], [("text", [([("corps", None)],)])])]
    df = spark.createDataFrame(rows, f"d int, page_idx int, para_blocks array<{block}>, preproc_blocks array<{block}>")
    assert L.layout_markdown(df, "d").first()["text"] == "[[DOC_PAGE:1]]\n# Un titre\n[[DOC_PAGE:2]]\ncorps"


def test_grids(spark):
    html = "<table><tr><td>Nom</td><td>Prix</td></tr><tr><td rowspan=2>a</td><td>1.000,5</td></tr><tr><td colspan=99>b</td></tr></table>"
    headers, rows, codes = grids.parse(html)
    assert headers == ["Nom", "Prix"] and rows == [["a", "1.000,5"], ["b"]] and codes == ["tableau_colspan_aberrant", "tableau_rowspan"]
    assert grids.parse("<table><tr>")[2] == ["tableau_non_ferme"] and grids.parse("<table></table>")[2] == ["tableau_vide"]
    text, tables, _ = grids.normalise(f"Voici\n{html}\nfin")
    assert text == "Voici\nNom | Prix\na | 1.000,5\nb\nfin" and tables[0][2:] == (1, 4)
    assert grids.normalise(text) == (text, [], [])
    assert values(spark, grids.number, ["37.000.000", "12,5", "1250.5", "3-2-1", "x"]) == [37000000.0, 12.5, 12505.0, None, None]
    df = spark.createDataFrame([(["1 an", "6 mois"], [["Destination", "tarif"]])], "h array<string>, r array<array<string>>")
    assert df.select(grids.is_subscription_grid(F.col("h"), F.col("r"))).first()[0]


@pytest.mark.parametrize("name,message,want", [("ReadTimeout", "", "transitoire"), ("ValueError", "HTTP 404", "definitive"), ("ValueError", "HTTP 422", "definitive"), ("ValueError", "HTTP 429", "transitoire"), ("ValueError", "HTTP 408", "transitoire"), ("HTTPStatusError", "HTTP 503", "transitoire"), ("X", "page 404", "definitive"), ("X", "date de consolidation introuvable", "information_manquante")])
def test_error_classes(spark, name, message, want):
    assert spark.range(1).select(C.error_class(F.lit(name), F.lit(message))).first()[0] == want


def test_chunks_and_manifests(spark, tmp_path):
    from lexmill.sources import manifest as M

    (tmp_path / "a.jsonl").write_text('{"id": "x/1", "sha256": "s", "statut": "telecharge"}\n\n{"id": "x/2", "sha256": "s"}\n{"id": "x/1", "sha256": "t", "fichier": "f"}\n')
    entries = M.read(spark, str(tmp_path / "a.jsonl"))
    assert sorted((r["id"], r["sha256"]) for r in entries.collect()) == [("x/1", "t"), ("x/2", "s")]
    M.save(entries.drop("manifest"), str(tmp_path / "out"))
    assert [r["value"] for r in spark.read.text(str(tmp_path / "out")).collect()][0] == '{"id":"x/1","fichier":"f","sha256":"t"}'
    M.export(entries.drop("manifest"), str(tmp_path / "by"))
    assert [r["namespace"] for r in spark.read.json(str(tmp_path / "by")).collect()] == ["x"]
    (tmp_path / "bin").mkdir()
    (tmp_path / "bin" / "f.pdf").write_bytes(b"%PDF-1.4")
    assert M.files(spark, str(tmp_path / "bin")).first()["length"] == 8
    rows = [(1, 0, "chunk_1_a_2.md", 2, "un"), (1, 1, "chunk_4_a_5.md", 2, "deux"), (2, 0, "x.md", 3, "a"), (2, 1, "y.md", 1, "b")]
    chunks = M.chunk_offsets(spark.createDataFrame(rows, "d int, upload_no int, name string, n_pages int, content string"), "d")
    assert sorted((r["d"], r["position"], r["offset"], r["warning"]) for r in chunks.collect()) == [(1, 1, 0, None), (1, 2, 3, "gap"), (2, 1, 0, None), (2, 2, 3, None)]
    assert M.merge_markdown(chunks.where("d = 1"), "d").first()["text"] == "<!-- chunk chunk_1_a_2.md -->\nun\n\n<!-- chunk chunk_4_a_5.md -->\ndeux"


def test_streaming_fold_equals_batch(spark, tmp_path):
    from lexmill.streaming import jobs as J

    events = [(1, 1, "reserve", 5), (1, 2, "fail", 4), (1, 3, "done", 5), (2, 4, "reserve", 1), (2, 5, "fail", 1), (2, 6, "reserve", 2)]
    df = spark.createDataFrame(events, "job_id long, seq long, event_kind string, token long")
    df.coalesce(1).write.parquet(str(tmp_path / "in"))
    stream = J.stream_states(spark.readStream.schema(df.schema).parquet(str(tmp_path / "in")))
    q = stream.writeStream.format("memory").queryName("states").outputMode("update").option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start()
    q.awaitTermination(120)
    cols = ["job_id", "status", "attempts", "token", "n_rejected"]
    got = sorted(tuple(r) for r in spark.table("states").select(*cols).collect())
    assert got == sorted(tuple(r) for r in J.fold(df, "job_id", "seq").select(*cols).collect()) == [(1, "done", 1, 5, 1), (2, "running", 2, 2, 0)]


def test_plans_and_jobs(spark):
    from lexmill.plans import promotion as P
    from lexmill.streaming import jobs as J

    names = spark.createDataFrame([("portant sur", 1), ("portant sur les lacs", 2)], "name string, ident int")
    df = spark.createDataFrame([("Portant SUR LES LACS et",), ("portant sur les mers",), ("autre",)], "label string")
    assert {r["label"]: r["ident"] for r in P.longest_prefix(df, "label", names, "name", "ident").collect()} == {"Portant SUR LES LACS et": 2, "portant sur les mers": 1, "autre": None}
    jobs = spark.sql("select * from values (1, 'k', 'pending', timestamp'2020-01-01', timestamp'2020-01-01', '', 0L, 0), (2, 'k', 'running', timestamp'2019-01-01', timestamp'2020-01-01 11:50:00', 'w', 3L, 1), (3, 'k', 'running', timestamp'2018-01-01', timestamp'2020-01-01 11:00:00', 'w', 3L, 1) t(id, kind, status, created_at, locked_at, locked_by, fencing_token, attempts)")
    out = {r["id"]: r for r in J.reserve(jobs, F.lit("2020-01-01 12:00:00").cast("timestamp"), "me").collect()}
    assert out[3]["locked_by"] == "me" and out[3]["fencing_token"] == 4 and out[3]["attempts"] == 2 and out[1]["status"] == "pending" and out[2]["locked_by"] == "w"
    assert {r["id"]: r["status"] for r in J.relaunch(jobs, F.lit(True)).collect()}[1] == "pending"
