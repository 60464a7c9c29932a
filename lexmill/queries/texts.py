"""Queries on texts: quality, cleaning, classification, pages, segments (inventory parts A-F)."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions import classify as C
from ..functions import clean as K
from ..functions.quality import quality_sql, with_quality
from ..operators import acts as acts_op
from ..operators import lines as L
from ..sources import manifest as M
from .registry import query

_COUNTS = "total_chars, replacement_count, control_count, artifact_count, total_words, single_letters"
_PEN = "p_replacement, p_control, p_artifact, p_fragmentation"


@query(f"select doc_id, {_COUNTS}, {_PEN}, score from {quality_sql('documents')}")
def quality_score(t):
    """Readability of every document."""
    return with_quality(t.documents.select("doc_id", "text")).select("doc_id", *_COUNTS.split(", "), *_PEN.split(", "), "score")


@query(f"select lang, count(*) as n_docs, count(*) filter (score < 0.9) as n_low, count(*) filter (score < 0.6) as n_flagged from {quality_sql('documents')} group by lang")
def quality_flags(t):
    """Documents below the thresholds by language."""
    return with_quality(t.documents.select("lang", "text")).groupBy("lang").agg(F.count("*").alias("n_docs"), F.count_if(F.col("score") < 0.9).alias("n_low"), F.count_if(F.col("score") < 0.6).alias("n_flagged"))


_PAGES_SQL = "(select doc_id, (i - 1) // 2 + 1 as page, string_agg(line, chr(10) order by i) as content from (select doc_id, unnest(string_split(text, chr(10))) as line, generate_subscripts(string_split(text, chr(10)), 1) as i from documents) group by 1, 2)"
_SINGLE_SQL = "len(list_filter(regexp_extract_all(content, '\\p{L}+'), lambda w: length(w) = 1 and not contains('aàylcdnsjmtAÀYLCDNSJMT', w)))"


def _pages(t):
    """Two lines of a document stand for a page."""
    rows = L.lines_of(t.documents, "doc_id", "text").withColumn("page", F.floor(F.col("line_no") / 2) + 1)
    return rows.groupBy("doc_id", "page").agg(F.array_sort(F.collect_list(F.struct("line_no", "line"))).alias("l")).select("doc_id", "page", F.array_join(F.transform("l", lambda x: x["line"]), "\n").alias("content"))


@query(f"select doc_id, page, n_words, n_single from (select doc_id, page, len(regexp_extract_all(content, '\\p{{L}}+')) as n_words, {_SINGLE_SQL} as n_single from {_PAGES_SQL}) where n_words >= 50 and n_single > 0.01 * n_words")
def degraded_pages(t):
    """Pages of which too many words are single letters (threshold 1 % here)."""
    return L.degraded_pages(_pages(t), "doc_id", most=0.01).select("doc_id", "page", "n_words", "n_single")


@query(
    f"""with p as {_PAGES_SQL}, per as (select doc_id, count(*) as n_pages, sum(length(content)) as n_chars from p group by 1),
    bad as (select doc_id, count(*) as n_bad from (select doc_id, len(regexp_extract_all(content, '\\p{{L}}+')) as w, {_SINGLE_SQL} as s from p) where w >= 50 and s > 0.035 * w group by 1),
    q as (select doc_id, score from {quality_sql('documents')})
    select doc_id, n_pages, n_chars::bigint as n_chars, coalesce(n_bad, 0) as n_bad,
      case when n_chars < 300 * n_pages then 'few_chars' when score < 0.6 then 'low_score' when coalesce(n_bad, 0) >= 2 then 'degraded_pages' else 'native' end as reason
    from per join q using (doc_id) left join bad using (doc_id)"""
)
def triage(t):
    """Route of each document and why."""
    return L.triage(_pages(t), with_quality(t.documents.select("doc_id", "text")), "doc_id").select("doc_id", "n_pages", "n_chars", "n_bad", "reason")


@query(f"select doc_id, sha256(string_agg('[[DOC_PAGE:' || page || ']]' || chr(10) || content, chr(10) order by page)) as sha from {_PAGES_SQL} group by 1")
def render_pages(t):
    """Pages put together with marker lines."""
    return L.render_pages(_pages(t).withColumn("page", F.col("page").cast("int")), "doc_id").select("doc_id", F.sha2("text", 256).alias("sha"))


@query(
    """select doc_id, sha256(lower(trim(regexp_replace(text, '\\s+', ' ', 'g')))) as line_sha,
    coalesce(nullif(regexp_replace(regexp_replace(regexp_replace(lower(source || ' ' || lang || '!'), '[^a-z0-9_-]+', '-', 'g'), '-{2,}', '-', 'g'), '^[-_]+|[-_]+$', '', 'g'), ''), 'document') as slug,
    'flux:' || coalesce(nullif(regexp_replace(regexp_replace(regexp_replace(lower(source || ' ' || lang || '!'), '[^a-z0-9_-]+', '-', 'g'), '-{2,}', '-', 'g'), '^[-_]+|[-_]+$', '', 'g'), ''), 'document') as document_key
    from documents"""
)
def clean_keys(t):
    """Normalised text and keys of each document."""
    return _clean_keys(t, F.col("text"))


def _clean_keys(t, text):
    name = F.concat("source", F.lit(" "), "lang", F.lit("!"))
    return t.documents.select("doc_id", F.sha2(K.match_line(text), 256).alias("line_sha"), K.path_component(name).alias("slug"), K.document_key(F.lit("FLUX"), name).alias("document_key"))


@query(
    "select doc_id, sha256(replace(replace(text, chr(8203), ''), chr(65279), '')) as sha_visible, sha256(translate(lower(text), 'àâäáãçéèêëíìîïñóòôöõúùûüýÿ', 'aaaaaceeeeiiiinooooouuuuyy')) as sha_folded, "
    "len(regexp_extract_all(text, '\\p{Lu}')) >= 0.8 * len(regexp_extract_all(text, '\\p{L}')) and len(regexp_extract_all(text, '\\p{L}')) > 0 as capitals, contains(text, '<table') as has_table from documents"
)
def clean_texts(t):
    """Invisible characters, folding, capitals, table prefilter."""
    return t.documents.select("doc_id", F.sha2(K.strip_invisible(F.col("text")), 256).alias("sha_visible"), F.sha2(K.fold(F.col("text")), 256).alias("sha_folded"), K.is_upper_dominant(F.col("text")).alias("capitals"), K.has_table_exact(F.col("text")).alias("has_table"))


@query("select doc_id, sha256(replace(replace(replace(text || ' L0I Artide', 'L0I', 'LOI'), 'Artide', 'Article'), 'ﬁ ', 'fi')) as sha from documents")
def fix_confusions(t):
    """Known confusions of recognition put right."""
    return t.documents.select("doc_id", F.sha2(K.fix_confusions(F.concat("text", F.lit(" L0I Artide"))), 256).alias("sha"))


@query(
    """select page_id, sha256(trim(regexp_replace(replace(replace(replace(replace(replace(replace(regexp_replace(regexp_replace(
      case when regexp_matches(html, '(?is)<article\\b[^>]*>.*?</article\\s*>') then regexp_extract(html, '(?is)<article\\b[^>]*>(.*?)</article\\s*>', 1) else html end,
      '(?is)<script\\b[^>]*>.*?</script\\s*>|<style\\b[^>]*>.*?</style\\s*>', ' ', 'g'), '(?s)<[^>]*>', ' ', 'g'),
      '&nbsp;', ' '), '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&#39;', ''''), '&amp;', '&'), '[ \\t\\n\\r\\f\\v]+', ' ', 'g'), ' ')) as sha from pages"""
)
def html_text(t):
    """Text of a page."""
    return t.pages.select("page_id", F.sha2(K.html_text(F.col("html")), 256).alias("sha"))


@query(
    """select page_id, min(i) - 1 as pos, url from (select page_id, i, case when href like '//%' then 'https:' || href when href like '/%' then 'https://base.example' || href
      when href not like 'http%' then 'https://base.example/' || regexp_replace(href, '^[./]+', '') else href end as url from (
      select page_id, unnest(h) as href, generate_subscripts(h, 1) as i from (select page_id, regexp_extract_all(html, 'href="([^"#]+)"', 1) as h from pages)))
    group by page_id, url"""
)
def link_extract(t):
    """Distinct absolute links of a page in order."""
    return M.links(t.pages, "page_id", "html", 'href="([^"#]+)"', "https://base.example")


_WORDS = ["Décret", "LOI", "Arrêté", "Convention collective", "Acte uniforme portant", "Ordonnance", "Note", "Code", "Texte avec LOI", "Avis", "Arrête :", "Arrété"]
_TITLE_SQL = "(select *, case o_orderkey % 12 " + " ".join(f"when {i} then '{w}'" for i, w in enumerate(_WORDS)) + " end || ' N° ' || (o_orderkey % 997) || '-' || year(o_orderdate) || ' du ' || day(o_orderdate) || ' ' || (['janvier','février','mars','avril','mai','juin','juillet','août','septembre','octobre','novembre','décembre'])[month(o_orderdate)] || ' ' || year(o_orderdate) || case when o_orderkey % 7 = 0 then ' OHADA' when o_orderkey % 7 = 1 then ' CEMAC' else '' end as title from orders)"


def _titles(t):
    """Titles made from orders."""
    months = F.array(*map(F.lit, ["janvier", "février", "mars", "avril", "mai", "juin", "juillet", "août", "septembre", "octobre", "novembre", "décembre"]))
    d, k = F.col("o_orderdate"), F.col("o_orderkey")
    word = F.element_at(F.array(*map(F.lit, _WORDS)), (k % 12 + 1).cast("int"))
    tail = F.when(k % 7 == 0, " OHADA").when(k % 7 == 1, " CEMAC").otherwise("")
    return t.orders.withColumn("title", F.concat(word, F.lit(" N° "), (k % 997).cast("string"), F.lit("-"), F.year(d), F.lit(" du "), F.day(d), F.lit(" "), F.element_at(months, F.month(d)), F.lit(" "), F.year(d), tail))


@query(
    f"""select o_orderkey, type, case type when 'CONVENTION_COLLECTIVE' then 'CONV' when 'ACTE_UNIFORME' then 'AU' when 'LOI' then 'LOI' when 'DECRET' then 'DEC' when 'ARRETE' then 'ARR' when 'ORDONNANCE' then 'ORD' else 'TEXTE' end as code,
      deduced, scope, reference, date, number_key, keyword, act_number from (select o_orderkey,
      case o_orderkey % 12 when 0 then 'DECRET' when 1 then 'LOI' when 2 then 'ARRETE' when 3 then 'CONVENTION_COLLECTIVE' when 4 then 'ACTE_UNIFORME' when 5 then 'ORDONNANCE' when 6 then 'NOTE' when 7 then 'TEXTE' when 8 then 'LOI' when 9 then 'AVIS' when 10 then 'TEXTE' else 'ARRETE' end as type,
      case o_orderkey % 12 when 0 then 'DEC' when 1 then 'LOI' when 2 then 'ARR' when 3 then 'CONV' when 4 then 'AU' when 5 then 'ORD' when 7 then 'CODE' when 10 then 'ARR' else 'TEXTE' end as deduced,
      case when o_orderkey % 7 = 0 then 'ohada' when o_orderkey % 12 = 4 then 'ohada' when o_orderkey % 7 = 1 then 'communautaire' else 'national' end as scope,
      case when o_orderkey % 12 in (0, 1, 2, 5, 8) then (o_orderkey % 997) || '-' || year(o_orderdate) end as reference,
      o_orderdate::date as date, (o_orderkey % 997) || '-' || year(o_orderdate) as number_key,
      case o_orderkey % 12 when 0 then 'DECRET' when 1 then 'LOI' when 2 then 'ARRETE' when 3 then 'CONVENTION' when 5 then 'ORDONNANCE' when 9 then 'AVIS' when 10 then 'ARRETE' when 11 then 'ARRETE' end as keyword,
      (o_orderkey % 997) || '-' || year(o_orderdate) as act_number from orders)"""
)
def title_ladder(t):
    """What a title tells."""
    title, kind = F.col("title"), F.col("type")  # the ladder of types runs once, as a column
    return _titles(t).select("o_orderkey", "title", C.act_type(title).alias("type")).select(
        "o_orderkey", "type", C.type_code(kind).alias("code"), C.deduced_code(F.lit(None).cast("string"), title).alias("deduced"), C.legal_scope(title, F.lit(None).cast("string")).alias("scope"),
        C.reference(title).alias("reference"), C.french_date(title).alias("date"), C.act_number_key(title).alias("number_key"), C.act_keyword(title).alias("keyword"), C.normal_number(C.act_number(title)).alias("act_number"),
    )


@query(
    f"""with d as (select case o_orderkey % 12 when 0 then 'DEC' when 1 then 'LOI' when 2 then 'ARR' when 3 then 'CONV' when 4 then 'AU' when 5 then 'ORD' when 7 then 'CODE' when 10 then 'ARR' else 'TEXTE' end as code, o_orderkey from orders where o_orderstatus = 'O')
    select code, count(*) as n, list_sort(list(o_orderkey))[:2] as first_ids from d group by code"""
)
def type_backfill(t):
    """Untyped documents by deduced code."""
    rows = _titles(t).where("o_orderstatus = 'O'").withColumn("code", C.deduced_code(F.lit(None).cast("string"), F.col("title")))
    place = F.row_number().over(Window.partitionBy("code").orderBy("o_orderkey"))  # only the two least of each code leave a task
    least = rows.select("code", "o_orderkey").withColumn("k", place).where("k <= 2").groupBy("code").agg(F.array_sort(F.collect_list("o_orderkey")).alias("first_ids"))
    return rows.groupBy("code").agg(F.count("*").alias("n")).join(least, "code").select("code", "n", "first_ids")


@query(
    """select l_orderkey, l_linenumber, case l_partkey % 8 when 0 then null when 1 then l_linenumber when 2 then null when 3 then null when 4 then null when 5 then l_linenumber when 6 then null else 1 end::int as ordinal,
    case when l_partkey % 8 = 6 then l_linenumber::varchar end as original from lineitem"""
)
def article_ordinal(t):
    """Place of an article number in its series, and the number before its suffix."""
    n = F.col("l_linenumber").cast("string")
    forms = [F.concat(n, F.lit(" nouveau")), n, F.concat(n, F.lit(" bis")), F.concat(n, F.lit("-1")), F.concat(n, F.lit(".2")), F.concat(n, F.lit("er")), F.concat(n, F.lit("_doublon_2")), F.lit("premier")]
    raw = F.element_at(F.array(*forms), (F.col("l_partkey") % 8 + 1).cast("int"))
    ordinal = F.when(C.original_number(raw).isNotNull(), F.lit(None)).otherwise(C.ordinal(raw))
    return t.lineitem.select("l_orderkey", "l_linenumber", ordinal.cast("int").alias("ordinal"), C.original_number(raw).alias("original"))


@query("select o_orderkey, year(o_orderdate) as year, (o_orderkey % 60)::varchar as number, o_orderkey % 5 = 0 as special, case when o_orderkey % 5 = 0 then 'Journal officiel n° ' || (o_orderkey % 60) || '-' || year(o_orderdate) || ' — spécial' else 'Journal officiel n° ' || (o_orderkey % 60) || '-' || year(o_orderdate) end as title from orders")
def issue_names(t):
    """Grammar of issue file names and titles."""
    y, n = F.year("o_orderdate").cast("string"), (F.col("o_orderkey") % 60).cast("string")
    base = F.concat(F.lit("congo-jo-"), y, F.lit("-"), F.lpad(n, 2, "0"), F.when(F.col("o_orderkey") % 5 == 0, "-sp").otherwise(""))
    x = C.issue_filename(F.concat(base, F.lit(".pdf")))
    return t.orders.select("o_orderkey", x["year"].alias("year"), x["number"].alias("number"), x["special"].alias("special"), C.issue_title(y, n, base).alias("title"))


@query("select o_orderkey, o_orderdate::date as date from orders where o_orderkey % 3 > 0 union all select o_orderkey, null from orders where o_orderkey % 3 = 0")
def masthead(t):
    """Date of an issue, where the ordinal of its volume fits the year."""
    d = F.col("o_orderdate")
    off = F.when(F.col("o_orderkey") % 3 == 0, 1900).otherwise(1958 + (F.col("o_orderkey") % 3 - 1))
    months = F.array(*map(F.lit, ["janvier", "février", "mars", "avril", "mai", "juin", "juillet", "août", "septembre", "octobre", "novembre", "décembre"]))
    text = F.concat(F.lit("[[DOC_PAGE:1]]\nJOURNAL\n"), F.lpad(((F.year(d) - off) % 100).cast("string"), 2, "0"), F.lit("e ANNEE - N° 3\nDu jeudi "), F.day(d), F.lit(" "), F.element_at(months, F.month(d)), F.lit(" "), F.year(d), F.lit("\n"))
    return t.orders.select("o_orderkey", C.masthead_date(text).alias("date"))


@query("select o_orderkey, (o_orderkey % 300) || '/' || year(o_orderdate) as number, o_orderdate::date as date, case when o_orderkey % 2 = 0 then 'Première chambre' end as chamber, case when o_orderkey % 2 = 0 then 2 else 1 end as n_citations, 'portant sur le droit ' || (o_orderkey % 4) as label from orders")
def decisions(t):
    """Head and citations of decisions."""
    d, k = F.col("o_orderdate"), F.col("o_orderkey")
    months = F.array(*map(F.lit, ["janvier", "février", "mars", "avril", "mai", "juin", "juillet", "août", "septembre", "octobre", "novembre", "décembre"]))
    text = F.concat(
        F.lit("COUR Arrêt N° "), (k % 300).cast("string"), F.lit(" du "), F.day(d), F.lit(" "), F.element_at(months, F.month(d)), F.lit(" "), F.year(d), F.when(k % 2 == 0, " Première chambre").otherwise(""),
        F.lit(" ; vu l'article 12 de l'Acte uniforme portant sur le droit "), (k % 4).cast("string"), F.lit(", "), F.lit("vu l'article 12  de l'Acte uniforme portant sur le droit "), (k % 4).cast("string"), F.lit(" ; "),
        F.when(k % 2 == 0, "et articles 3, 4 et 5 du Code civil.").otherwise("fin."),
    )
    head, cites = C.decision_header(text), C.citations(text)
    return t.orders.select("o_orderkey", head["number"].alias("number"), head["date"].alias("date"), head["chamber"].alias("chamber"), F.size(cites).alias("n_citations"), cites[0]["label"].alias("label"))


@query(
    f"""with l as (select doc_id, unnest(string_split(text, chr(10))) as line, generate_subscripts(string_split(text, chr(10)), 1) as i from documents),
    m as (select *, (i - 1) // 3 + 1 as page from l where (i - 1) // 3 % 4 <> 2 ),
    p as (select doc_id, page, length(regexp_replace(regexp_replace(string_agg(line, chr(10) order by i), '^\\s+', ''), '\\s+$', '')) as n from m group by 1, 2),
    s as (select doc_id, unnest(generate_series(min(page), max(page))) as page from p group by doc_id)
    select doc_id, page from s left join p using (doc_id, page) where coalesce(n, 0) < 20"""
)
def page_coverage(t):
    """Pages with too little text, absent ones included (three lines a page, every third page of four taken out)."""
    rows = L.lines_of(t.documents, "doc_id", "text").withColumn("p", F.floor(F.col("line_no") / 3).cast("int")).where("p % 4 <> 2")
    marked = rows.withColumn("line", F.when(F.col("line_no") % 3 == 0, F.concat(F.lit("[[DOC_PAGE:"), (F.col("p") + 1).cast("string"), F.lit("]]\n"), "line")).otherwise(F.col("line")))
    docs = L.join_lines(marked, "doc_id", F.lit(True))
    return L.page_gaps(L.page_texts(docs, "doc_id", "text"), "doc_id").select("doc_id", F.col("page").cast("long").alias("page"))


@query(
    f"""with p as {_PAGES_SQL}, r as (select distinct o_orderkey % 1000 as doc_id, o_orderkey % 9 + 1 as a, o_orderkey % 9 + 1 + o_custkey % 2 as b from orders)
    select doc_id, page from p where length(content) >= 20 and not exists (select 1 from r where r.doc_id = p.doc_id and p.page between a and b)"""
)
def structure_coverage(t):
    """Pages with text that no leaf covers."""
    r = t.orders.select((F.col("o_orderkey") % 1000).alias("doc_id"), (F.col("o_orderkey") % 9 + 1).alias("page"), (F.col("o_orderkey") % 9 + 1 + F.col("o_custkey") % 2).alias("page_end"))
    return L.structure_gaps(_pages(t), r, "doc_id")


@query(
    """select event_id, user_id, coalesce(case when event_id % 3 = 0 then event_id % 50 + 1 end, last_value(case when event_id % 3 = 0 then event_id % 50 + 3 end ignore nulls) over (partition by user_id order by event_id rows between unbounded preceding and 1 preceding), 1) as page_start,
    greatest(1, coalesce(case when event_id % 3 = 0 then event_id % 50 + 1 end, 1) - user_id % 7) as rebased from events"""
)
def page_carry(t):
    """Start page of each act, carried forward; pages rebased."""
    own = F.col("event_id") % 3 == 0
    e = t.events.withColumns({"a": F.when(own, F.col("event_id") % 50 + 1), "b": F.when(own, F.col("event_id") % 50 + 3)})
    out = L.carry_pages(e, "user_id", "event_id", "a", "b")
    return out.select("event_id", "user_id", F.col("page_start").cast("long").alias("page_start"), L.rebase(F.coalesce("a", F.lit(1)), F.col("user_id") % 7).alias("rebased"))


@query(
    """with l as (select l_orderkey, l_linenumber - 1 as i, case when l_linenumber % 3 = 1 and l_partkey % 2 = 0 then 'H' when l_partkey % 3 = 0 then 'F' when l_partkey % 5 = 0 then 'B' else 'T' end as c, row_number() over (partition by l_orderkey order by l_linenumber, l_partkey, l_suppkey, l_extendedprice) as r from lineitem),
    g as (select *, sum(case when c = 'T' then 1 else 0 end) over (partition by l_orderkey order by r) as run from l),
    m as (select *, max(case when c = 'H' then 1 else 0 end) over (partition by l_orderkey, run) as anchored from g)
    select l_orderkey, count(*) filter (c in ('H', 'F') and anchored = 1) as n_furniture, count(*) as n_lines from m group by 1"""
)
def furniture_islands(t):
    """Lines of page furniture, islands around a running head."""
    c = F.when((F.col("l_linenumber") % 3 == 1) & (F.col("l_partkey") % 2 == 0), "Journal officiel de la République du Congo").when(F.col("l_partkey") % 3 == 0, "123").when(F.col("l_partkey") % 5 == 0, "").otherwise("Le texte de la loi.")
    w = Window.partitionBy("l_orderkey").orderBy("l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice")
    rows = t.lineitem.select("l_orderkey", c.alias("line"), F.row_number().over(w).alias("line_no"))
    return L.furniture(rows, "l_orderkey").groupBy("l_orderkey").agg(F.count_if("is_furniture").alias("n_furniture"), F.count("*").alias("n_lines"))


@query(
    """with l as (select l_orderkey, row_number() over (partition by l_orderkey order by l_linenumber, l_partkey, l_suppkey, l_extendedprice) - 1 as i,
      case when l_partkey % 6 = 0 then 'toc' when l_partkey % 6 in (1, 2) then 'art' when l_partkey % 6 = 3 then 'vu' when l_partkey % 6 = 4 then 'entry' else 'text' end as c from lineitem),
    f as (select l_orderkey, min(i) filter (c = 'art') as fa, min(i) filter (c = 'toc') as ft from l group by 1),
    x as (select l.*, case when fa is null or ft < fa then ft end as lead, fa from l join f using (l_orderkey)),
    m as (select l_orderkey, any_value(lead) as lead, min(i) filter (c in ('art', 'vu') and i > lead) as lead_end, max(i) filter (c = 'toc' and i > fa) as tail from x group by 1),
    s as (select l_orderkey, avg(case when c = 'entry' then 1.0::double else 0 end) as share from l join m using (l_orderkey) where i > tail group by 1)
    select l_orderkey, case when lead_end is not null then lead end as lead_start, lead_end, case when share >= 0.5 then tail end as tail_start from m left join s using (l_orderkey)"""
)
def toc_cut(t):
    """Bounds of tables of contents."""
    k = F.col("l_partkey") % 6
    line = F.when(k == 0, "# SOMMAIRE").when(k.isin(1, 2), "Article 3 : texte").when(k == 3, "Vu la charte ;").when(k == 4, "Des lacs .... 12").otherwise("Un lac est calme.")
    w = Window.partitionBy("l_orderkey").orderBy("l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice")
    rows = t.lineitem.select("l_orderkey", line.alias("line"), (F.row_number().over(w) - 1).alias("line_no"))
    return L.contents_cut(rows, "l_orderkey")


@query(
    f"""with x as (select o_custkey, row_number() over (partition by o_custkey order by o_orderkey) as start_line, o_orderkey % 12 as k, o_orderkey, title from {_TITLE_SQL})
    select o_custkey, start_line, case k when 0 then 'DEC' when 1 then 'LOI' when 2 then 'ARR' when 5 then 'ORD' when 7 then 'CODE' else 'TEXTE' end as type_code from x where k in (0, 1, 2, 5, 7, 9)"""
)
def boundaries(t):
    """suggested starts of acts in compilations (the titles of a customer's orders, one a line)."""
    w = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("o_orderkey", "title"))), lambda x: x["title"]), "\n")
    docs = _titles(t).groupBy("o_custkey").agg(w.alias("text"))
    return L.boundaries(docs, "o_custkey", "text").select("o_custkey", "start_line", "type_code")


@query(
    """with l as (select doc_id, unnest(string_split(text, chr(10))) as line, generate_subscripts(string_split(text, chr(10)), 1) as i from documents),
    b as (select doc_id, i as a, lead(i) over (partition by doc_id order by i) as z, row_number() over (partition by doc_id order by i) as segment from l where length(line) % 4 = 0)
    select l.doc_id, segment, min(a) as line_start, max(i) as line_end, count(*) as line_count from l join b on l.doc_id = b.doc_id and i >= a and (z is null or i < z) group by 1, 2"""
)
def slices(t):
    """half-open segments between marks."""
    lines = L.lines_of(t.documents, "doc_id", "text").withColumn("line_no", F.col("line_no") + 1)
    marks = lines.where(F.length("line") % 4 == 0).select("doc_id", F.col("line_no").alias("start_line"))
    return L.slices(lines, marks, "doc_id").select("doc_id", "segment", "line_start", "line_end", "line_count")


@query("select event_id, user_id, event_type from (select *, lag(event_type) over (partition by user_id order by event_id) as was from events) where was is null or was <> event_type")
def collapse_repeats(t):
    """consecutive equal titles become one."""
    return L.collapse_repeats(t.events.select("event_id", "user_id", "event_type"), "user_id", "event_id", "event_type")


@query(
    """with a as (select doc_id, source, case when doc_id % 4 > 0 then doc_id % 5 end as n, length(text) as len from documents)
    select doc_id, source from (select *, row_number() over (partition by source, n order by len desc, doc_id) as r from a) where n is null or r = 1"""
)
def dedup_longest(t):
    """the longest copy of each numbered act of a source."""
    k = F.col("doc_id")
    title = F.when(k % 4 > 0, F.concat(F.lit("Loi n° "), (k % 5).cast("string"))).otherwise("Discours")
    rows = t.documents.select("doc_id", "source", "text", title.alias("title"), F.lit("LOI").alias("type"))
    return acts_op.longest_copies(rows, "source", content="text", order="doc_id").select("doc_id", "source")


@query(
    """with c as (select doc_id % 40 as doc, doc_id, length(text) % 7 + 1 as n_pages from documents), o as (select *, row_number() over (partition by doc order by doc_id) as position, sum(n_pages) over (partition by doc order by doc_id) as z from c)
    select doc, doc_id, position, (z - n_pages)::bigint as "offset", case when doc_id % 3 = 0 and position > 1 then 'gap' when doc_id % 3 = 1 and position > 1 then 'overlap' end as warning from (
      select *, z from o)"""
)
def chunk_offsets(t):
    """Order, offset and contiguity of chunk files."""
    rows = t.documents.select((F.col("doc_id") % 40).alias("doc"), "doc_id", (F.length("text") % 7 + 1).alias("n_pages"))
    w = Window.partitionBy("doc").orderBy("doc_id").rowsBetween(Window.unboundedPreceding, 0)
    z = F.sum("n_pages").over(w)
    shift = F.when(F.col("doc_id") % 3 == 0, 1).when(F.col("doc_id") % 3 == 1, -1).otherwise(0)
    named = rows.withColumns({"upload_no": F.col("doc_id"), "z": z}).withColumn("x", F.col("z") - F.col("n_pages") + 1)
    # a chunk's name says where it begins; the one before it ends earlier or later than that by the shift of this one
    nxt = F.lead(shift).over(Window.partitionBy("doc").orderBy("doc_id"))
    named = named.withColumn("name", F.format_string("chunk_%d_a_%d.md", F.col("x"), F.col("z") - F.coalesce(nxt, F.lit(0))))
    return M.chunk_offsets(named, "doc").select("doc", "doc_id", "position", "offset", "warning")


@query(
    """with x as (select o_orderkey, 'k' || (o_orderkey % 500) as id, o_totalprice, o_custkey from orders)
    select id, max(o_orderkey) as last_order from x group by id"""
)
def manifest_keep_last(t):
    """The last line of an id counts."""
    rows = t.orders.select(F.concat(F.lit("k"), (F.col("o_orderkey") % 500).cast("string")).alias("id"), "o_orderkey")
    return M.keep_last(rows, ["id"], "o_orderkey").select("id", F.col("o_orderkey").alias("last_order"))


@query("select sha256(c_mktsegment || c_nationkey) as sha256, arg_min(c_name, (c_nationkey, c_name)) as id from customer group by 1")
def checksum_index(t):
    """The first id of each checksum."""
    rows = t.customer.select(F.sha2(F.concat("c_mktsegment", F.col("c_nationkey").cast("string")), 256).alias("sha256"), F.col("c_nationkey").alias("manifest"), F.col("c_name").alias("id"))
    return M.checksum_index(rows)


@query(
    """with f as (select 'd' || doc_id as id, sha256(text) as sha256, doc_id from documents), e as (select 'd' || doc_id as id, sha256(case when doc_id % 6 = 0 then text || '~' else text end) as sha256 from documents where doc_id % 3 = 0),
    s as (select distinct sha256 from e)
    select f.doc_id, case when e.sha256 = f.sha256 then 'existing' when e.sha256 is not null then 'changed' when s.sha256 is not null then 'duplicate' else 'new' end as verdict from f left join e on e.id = f.id left join s on s.sha256 = f.sha256"""
)
def manifest_backfill(t):
    """Verdict of scanned files against a manifest that knows a third of them, half of those with another checksum."""
    d = t.documents.select("doc_id", F.concat(F.lit("d"), F.col("doc_id").cast("string")).alias("id"), "text")
    old = F.when(F.col("doc_id") % 6 == 0, F.concat("text", F.lit("~"))).otherwise(F.col("text"))
    manifest = d.where("doc_id % 3 = 0").select("id", F.sha2(old, 256).alias("sha256"))
    return M.backfill(d.select("doc_id", "id", F.sha2("text", 256).alias("sha256")), manifest).select("doc_id", "verdict")


@query("select o_orderdate::date as jo_annee, o_custkey % 9 as jo_numero, list_sort(list(distinct o_orderkey)) as variants from orders group by 1, 2 having count(distinct o_orderkey) > 1")
def issue_variants(t):
    """Issues that several files stand for."""
    rows = t.orders.select(F.to_date("o_orderdate").alias("jo_annee"), (F.col("o_custkey") % 9).alias("jo_numero"), F.col("o_orderkey").alias("id"))
    return M.variants(rows)


@query(
    """with e as (select user_id, event_id, event_type = 'click' as hit, sum((event_type = 'click')::int) over (partition by user_id order by event_id) as h from events), r as (select *, count(*) filter (not hit) over (partition by user_id, h order by event_id) as run from e),
    z as (select *, max((run >= 3)::int) over (partition by user_id order by event_id rows between unbounded preceding and 1 preceding) as ended from r) select user_id, event_id from z where coalesce(ended, 0) = 0"""
)
def until_misses(t):
    """A10: an enumeration ends after three misses in a row."""
    return M.until_misses(t.events.select("user_id", "event_id", (F.col("event_type") == "click").alias("hit")), "user_id", "event_id", "hit", 3).select("user_id", "event_id")


@query("select p_partkey, len(q) as n_query, len(list_intersect(q, x))::double / greatest(len(q), 1) >= 0.35 as fuzzy from (select p_partkey, list_distinct(['  b', ' br', 'bra', 'ran', 'and', 'nd ']) as q, list_distinct(flatten(list_transform(list_filter(string_split(regexp_replace(lower(p_brand || ' ' || p_type), '[^a-z0-9]+', ' ', 'g'), ' '), lambda w: w <> ''), lambda w: list_transform(range(1, length(w) + 2), lambda i: substring('  ' || w || ' ', i, 3))))) as x from part)")
def fuzzy_words(t):
    """Trigram similarity filter."""
    q = F.lit("brand")
    return t.part.select("p_partkey", F.size(K.trigrams(q)).alias("n_query"), (K.word_similarity(q, F.concat("p_brand", F.lit(" "), "p_type")) >= 0.35).alias("fuzzy"))


@query("select doc_id, len(list_distinct(regexp_extract_all(translate(lower(text), 'àâäáãçéèêëíìîïñóòôöõúùûüýÿ', 'aaaaaceeeeiiiinooooouuuuyy'), '\\p{L}+'))) as n_a, 1 as n_b from documents")
def search_vector(t):
    """Weighted tokens of a content and its tags."""
    v = K.search_vector(F.col("text"), F.col("lang"))
    return t.documents.select("doc_id", F.size(v["a"]).alias("n_a"), F.size(v["b"]).alias("n_b"))


@query("select n, least(1800.0, 30.0 * pow(2.0, greatest(0, n - 1))) as seconds, count(*) as n_orders from (select o_orderkey % 12 as n from orders) group by n")
def backoff(t):
    """Exponential backoff with a cap."""
    return t.orders.select((F.col("o_orderkey") % 12).alias("n")).groupBy("n").agg(F.count("*").alias("n_orders")).select("n", C.backoff(F.col("n")).alias("seconds"), "n_orders")


@query("select event_id, case when ts < date_trunc('day', ts) + interval 2 hour then date_trunc('day', ts) + interval 2 hour else date_trunc('day', ts) + interval 26 hour end as next_run from events")
def next_run(t):
    """The next daily run."""
    return t.events.select("event_id", C.next_run(F.col("ts"), 2).alias("next_run"))


@query("select event_id, case event_id % 9 when 0 then 'transitoire' when 1 then 'transitoire' when 2 then 'information_manquante' when 3 then 'definitive' when 5 then 'transitoire' when 6 then 'transitoire' when 7 then 'transitoire' else 'definitive' end as error_class from events")
def error_classes(t):
    """Failure classes."""
    k = F.col("event_id") % 9
    name = F.when(k == 0, "ReadTimeout").otherwise("ValueError")
    message = F.when(k == 1, "échec de stockage MinIO").when(k == 2, "validation du schéma en échec").when(k == 3, "HTTP 404")
    message = message.when(k == 5, "HTTP 408").when(k == 6, "HTTP 429 : quota").when(k == 7, "HTTP 503").when(k == 8, "HTTP 422").otherwise("autre")
    return t.events.select("event_id", C.error_class(name, message).alias("error_class"))


@query(
    f"""with o as (select o_custkey, o_orderkey, title, o_orderkey % 12 as k, o_orderkey % 12 in (0, 1, 2, 5, 6, 9, 10) as opens from {_TITLE_SQL}),
    g as (select *, sum(opens::int) over (partition by o_custkey order by o_orderkey rows unbounded preceding) as act, count(*) filter (opens) over (partition by o_custkey) as n from o),
    a as (select o_custkey, act - 1 as act_no, max(title) filter (opens) as title, max(k) filter (opens) as k, max(o_orderkey) filter (opens) as o,
      length('Vu la charte ;|Article 1 : texte.') + coalesce(sum(length(title) + length('||# |Vu la charte ;|Article 1 : texte.')) filter (not opens), 0) + max((act < n)::int) as n_chars from g where act > 0 group by o_custkey, act),
    r as (select a.o_custkey, act_no::int as act_no, title, n_chars::int as n_chars, case k when 0 then 'DECRET' when 1 then 'LOI' when 2 then 'ARRETE' when 5 then 'ORDONNANCE' when 6 then 'NOTE' when 9 then 'AVIS' else 'TEXTE' end as type,
      (o % 997) || '-' || year(o_orderdate) as number from a join orders on o_orderkey = o)
    select o_custkey, act_no, title, type, n_chars from r qualify row_number() over (partition by o_custkey, type, number order by n_chars desc, act_no) = 1"""
)
def split_acts(t):
    """acts of gazettes made of a customer's titles and texts."""
    body = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("o_orderkey", "title"))), lambda x: F.concat(F.lit("# "), x["title"], F.lit("\nVu la charte ;\nArticle 1 : texte."))), "\n\n")
    return acts_op.split_acts(_titles(t).groupBy("o_custkey").agg(body.alias("text")), "o_custkey", "text").select("o_custkey", "act_no", "title", "type", F.length("content").alias("n_chars"))


@query("select l_orderkey, l_linenumber, 'Loi N° ' || l_linenumber || ' du 1er mai, soit $x+y$ et ' || l_quantity || ' %' as text, 1 as n_refused from lineitem")
def unescape_math(t):
    """Math escapes that are plain text."""
    from ..functions.latex import unescape

    text = F.concat(F.lit("Loi $\\mathbf{N}^{\\circ}$ "), F.col("l_linenumber").cast("string"), F.lit(" du $1^{\\text{er}}$ mai, soit $x+y$ et "), (F.col("l_quantity")).cast("string"), F.lit(" $\\%$"))
    x = unescape(text)
    return t.lineitem.select("l_orderkey", "l_linenumber", x["text"].alias("text"), F.size(x["refused"]).alias("n_refused"))


@query(
    """with l as (select doc_id, unnest(string_split(text, chr(10))) as line, generate_subscripts(string_split(text, chr(10)), 1) as i from documents), n as (select *, (i - 1) // 4 + 1 as page, length(trim(regexp_replace(regexp_replace(line, '^[#>\\s*_]+', ''), '\\s+', ' ', 'g'))) >= 8 as known from l),
    m as (select *, known and row_number() over (partition by doc_id, page, known order by i) = 1 as marks from n)
    select doc_id, count(*) filter (marks)::int as n_marks, sha256(string_agg(case when marks then '[[DOC_PAGE:' || page || ']]' || chr(10) else '' end || line, chr(10) order by i)) as sha from m group by 1"""
)
def annotate_pages(t):
    """Page markers put into a text by aligned lines."""
    lines = L.lines_of(t.documents, "doc_id", "text").withColumn("page", (F.floor(F.col("line_no") / 4) + 1).cast("int"))
    index = L.page_index(lines, "doc_id").groupBy("doc_id").agg(F.array_sort(F.collect_list(F.struct("line_no", "norm", "page"))).alias("i"))
    index = index.select("doc_id", F.transform("i", lambda x: F.struct(x["norm"].alias("norm"), x["page"].alias("page"))).alias("index"))
    out = L.annotate(t.documents.select("doc_id", "text").join(index, "doc_id", "left"), "text", "index")
    return out.select("doc_id", F.regexp_count("annotated", F.lit(r"\[\[DOC_PAGE:")).alias("n_marks"), F.sha2("annotated", 256).alias("sha"))
