"""Queries on stored records: ingest, citations, audits, acquisition (inventory parts A, D, F-H, J, K, M-O)."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..operators import hierarchy as H
from ..operators import ingest as I
from ..plans import audit as A
from ..plans import citations as Z
from ..sources import acquire as Q
from .registry import query

# ingest -----------------------------------------------------------------------------------------------------------------

#: Lines of an order are the articles of an act; three numbers go round, so that numbers repeat.
_LINES_SQL = "(select l_orderkey, l_partkey, row_number() over (partition by l_orderkey order by l_linenumber, l_partkey, l_extendedprice) as n, count(*) over (partition by l_orderkey) as many from lineitem)"
_PRICES = "<table><tr><td>Destination</td><td>Tarif</td></tr><tr><td>1 an</td><td>6 mois</td></tr></table>"


def _acts(t):
    w = Window.partitionBy("l_orderkey").orderBy("l_linenumber", "l_partkey", "l_extendedprice")
    rows = t.lineitem.select("l_orderkey", "l_partkey", F.row_number().over(w).alias("n"))
    table = F.when((F.col("n") == 2) & (F.col("l_orderkey") % 5 == 0), F.lit(" " + _PRICES)).otherwise("")
    line = F.concat(F.lit("Article "), (F.col("n") % 3 + 1).cast("string"), F.lit(" : La part "), F.col("l_partkey"), F.lit(" est livrée."), table)
    body = rows.groupBy("l_orderkey").agg(F.array_sort(F.collect_list(F.struct("n", line.alias("x")))).alias("l"))
    text = F.concat(F.lit("[[DOC_PAGE:1]]\nVu la charte ;\nTITRE I : DES PARTS\n"), F.array_join(F.transform("l", lambda x: x["x"]), "\n"), F.lit("\nFait à Lacville, le 3 mai 2020\nJean Pêcheur"))
    return body.select("l_orderkey", text.alias("text"))


@query(
    f"""with l as {_LINES_SQL}, a as (
      select l_orderkey, n + 1 as node_id, (n % 3 + 1)::varchar as base, 'n_1.n_' || (n + 1) as path, null as content_format, 'La part ' || l_partkey || ' est livrée.' as content, n = 2 and l_orderkey % 5 = 0 as listed from l
      union all select distinct l_orderkey, 0, 'PREAMBULE', 'n_0', 'preamble', 'Vu la charte ;', false from l
      union all select distinct l_orderkey, many + 2, 'SIGNATURE', 'n_' || (many + 2), 'signature', 'Fait à Lacville, le 3 mai 2020' || chr(10) || 'Jean Pêcheur', false from l)
    select l_orderkey, node_id::int as node_id, path, content_format, case when k > 1 then base || '_doublon_' || (k - 1) else base end as article_number,
      sha256(content || case when listed then ' Destination | Tarif' || chr(10) || '1 an | 6 mois' else '' end) as sha
    from (select *, row_number() over (partition by l_orderkey, base order by node_id) as k from a)"""
)
def ingest_articles(t):
    """Articles that an act is stored as: number, path, locator, plain content."""
    nodes = H.parse_acts(H.prepared(_acts(t), "text"), "l_orderkey", "text", whole=True)
    out = I.ingest(nodes, "l_orderkey")["articles"]
    return out.select("l_orderkey", "node_id", "path", F.col("locator.content_format").alias("content_format"), "article_number", F.sha2("content", 256).alias("sha"))


@query(
    f"""with l as {_LINES_SQL}, r as (select l_orderkey, n, row_number() over (partition by l_orderkey, n % 3 order by n) as k from l)
    select l_orderkey, (n + 1)::int as node_id, 'article_doublon' as kind from r where k > 1
    union all select l_orderkey, 3, 'tableau_ours_journal_officiel' from l where n = 2 and l_orderkey % 5 = 0"""
)
def ingest_flags(t):
    """Flags of changed numbers and of price lists that pose as articles."""
    return I.ingest(H.parse_acts(_acts(t), "l_orderkey", "text"), "l_orderkey")["flags"].select("l_orderkey", "node_id", "kind")


@query(
    """with o as (select o_custkey, o_orderkey, o_totalprice from orders where o_orderstatus <> 'P')
    select o_custkey, o_orderkey, o_totalprice from o where o_custkey not in (select c_custkey from customer where c_custkey % 4 = 0) union all select c_custkey, -c_custkey, c_acctbal from customer where c_custkey % 4 = 0"""
)
def replace_structure(t):
    """The structure of the documents at hand is replaced as a whole."""
    stored = t.orders.where("o_orderstatus <> 'P'").select("o_custkey", "o_orderkey", "o_totalprice")
    new = t.customer.where("c_custkey % 4 = 0").select(F.col("c_custkey").alias("o_custkey"), (-F.col("c_custkey")).alias("o_orderkey"), F.col("c_acctbal").alias("o_totalprice"))
    return I.replace_structure(stored, new, "o_custkey")


_STORED_SQL = "(select o_custkey as doc, o_orderkey % 6 as number, o_orderkey as id, o_orderkey % 5 as content, row_number() over (partition by o_custkey order by o_orderkey) as ord from orders where o_orderkey % 4 <> 0)"
_WANTED_SQL = "(select o_custkey as doc, o_orderkey % 6 as number, o_orderkey % 5 + (o_orderkey % 7 = 0)::int as content, row_number() over (partition by o_custkey order by o_orderkey) as ord from orders where o_orderkey % 3 <> 0)"


@query(
    f"""with a as (select *, count(*) over (partition by doc, number) > 1 as twice from {_STORED_SQL}), b as (select *, count(*) over (partition by doc, number) > 1 as twice from {_WANTED_SQL}),
    v as (select coalesce(a.doc, b.doc) as doc, coalesce(a.number, b.number) as number, a.id, case when coalesce(a.twice, false) or coalesce(b.twice, false) then 'ambiguous' when a.ord is null then 'added'
      when b.ord is null then 'removed' when a.content <> b.content then 'changed' when a.ord <> b.ord then 'moved' else 'kept' end as verdict from a full join b on a.doc = b.doc and a.number = b.number)
    select doc, number, case when verdict <> 'removed' then id end as id, verdict from v"""
)
def rebuild_plan(t):
    """Rebuild by unique number: what keeps its id, what is new, what goes."""
    place = F.row_number().over(Window.partitionBy("o_custkey").orderBy("o_orderkey"))
    k = F.col("o_orderkey")
    stored = t.orders.where("o_orderkey % 4 <> 0").select(F.col("o_custkey").alias("doc"), (k % 6).alias("number"), k.alias("id"), (k % 5).alias("content"), place.alias("order"))
    wanted = t.orders.where("o_orderkey % 3 <> 0").select(F.col("o_custkey").alias("doc"), (k % 6).alias("number"), (k % 5 + (k % 7 == 0).cast("int")).alias("content"), place.alias("order"))
    return I.rebuild(stored, wanted, "doc")


@query(f"with l as {_LINES_SQL}, r as (select l_orderkey, n, n % 3 + 1 as base, row_number() over (partition by l_orderkey, n % 3 order by n) as k from l) select l_orderkey, n, base || '_doublon_' || (k - 1) as number from r where k > 1")
def reclassify_flags(t):
    """Duplicate flags worked out again from stored numbers."""
    w = Window.partitionBy("l_orderkey").orderBy("l_linenumber", "l_partkey", "l_extendedprice")
    rows = t.lineitem.select("l_orderkey", F.row_number().over(w).alias("n")).withColumn("base", (F.col("n") % 3 + 1).cast("string"))
    rows = H.unique_numbers(rows, "l_orderkey", "base", "n", "number").withColumn("id", F.concat_ws(":", "l_orderkey", "n"))
    out = I.reclassify(rows, "l_orderkey", "id", "number", "n")
    return out.select("l_orderkey", F.element_at(F.split("id", ":"), -1).cast("int").alias("n"), "number")


@query("select o_custkey, count(*) filter (o_orderkey % 3 = 0) as n_empty from orders join lineitem on l_orderkey = o_orderkey where l_returnflag <> 'R' group by 1")
def empty_articles(t):
    """Articles of a document whose current version has no text."""
    versions = t.lineitem.select(F.col("l_orderkey").alias("o_orderkey"), F.when(F.col("l_orderkey") % 3 == 0, "  ").otherwise("texte").alias("content"), F.when(F.col("l_returnflag") == "R", F.lit(1)).alias("end"))
    return I.empty_contents(t.orders.select("o_custkey", "o_orderkey"), versions, "o_custkey", "o_orderkey", "content", "end")


@query(
    """with v as (select o_orderkey, 'Texte ' || o_orderkey || case o_orderkey % 4 when 0 then '' when 1 then ' --- ' || repeat('x', 40) when 2 then ' ---' else '' end as before, o_orderkey % 4 as k from orders),
    p as (select o_orderkey, before, case when k = 3 then '' else split_part(before, ' ---', 1) end as after from v)
    select o_orderkey, case when after = '' then 'emptied' when length(after) * 2 < length(before) then 'truncated' else 'changed' end as verdict from p where before <> after"""
)
def normalisation_plan(t):
    """Proposed contents; unchanged ones are left out, emptied and shortened ones are marked."""
    k = F.col("o_orderkey")
    before = F.concat(F.lit("Texte "), k.cast("string"), F.when(k % 4 == 1, F.concat(F.lit(" --- "), F.repeat(F.lit("x"), 40))).when(k % 4 == 2, " ---").otherwise(""))
    rows = t.orders.select("o_orderkey", before.alias("content"))
    after = F.when(k % 4 == 3, "").otherwise(F.split_part("content", F.lit(" ---"), F.lit(1)))
    return I.normalisation_plan(rows, "o_orderkey", "content", after).select("o_orderkey", "verdict")


# citations --------------------------------------------------------------------------------------------------------------


def _decisions(t):
    n = t.nation.select("n_nationkey", "n_name")
    k = F.col("o_orderkey")
    text = F.concat(F.lit("La Cour, vu l'article "), (k % 7 + 1).cast("string"), F.lit(" de l'Acte uniforme portant sur le lac "), F.lower("n_name"), F.lit(", rejette ; puis article 12 du Code civil."))
    rows = t.orders.withColumn("n_nationkey", (k % 25).cast("int")).join(n, "n_nationkey")
    return rows.select(k.alias("document_id"), "n_nationkey", F.when(k % 11 != 0, text).alias("content"))


@query(
    """select o_orderkey as document_id, 'l''article ' || (o_orderkey % 7 + 1) || ' de l''Acte uniforme portant sur le lac ' || lower(n_name) as raw, case when n_nationkey % 2 = 0 and o_orderkey % 7 < 5 then n_nationkey * 10 + o_orderkey % 7 + 1 end as cited_id
      from orders join nation on n_nationkey = o_orderkey % 25 where o_orderkey % 11 <> 0
    union all select o_orderkey, 'article 12 du Code civil', null from orders where o_orderkey % 11 <> 0"""
)
def citation_plan(t):
    """References of decisions resolved to live articles of uniform acts."""
    texts = _decisions(t)
    docs = texts.select("document_id", F.lit("JURIS").alias("type_code"), F.lit(None).cast("date").alias("deleted_at")).distinct()
    own = texts.select(F.col("document_id").alias("article_id"), "document_id", F.lit(None).cast("date").alias("deleted_at"))
    current = Z.current_texts(docs, own, texts.select(F.col("document_id").alias("article_id"), "content"), "JURIS")
    acts = t.nation.select(F.col("n_nationkey").alias("act_id"), F.concat(F.lit("Acte uniforme portant sur le lac "), "n_name", F.lit(" (révisé)")).alias("title"))
    rows = t.nation.select(F.col("n_nationkey").alias("document_id"), F.explode(F.sequence(F.lit(1), F.lit(5))).alias("no"))
    articles = rows.select((F.col("document_id") * 10 + F.col("no")).alias("article_id"), "document_id", F.col("no").cast("string").alias("number"), F.when(F.col("document_id") % 2 == 1, F.current_date()).alias("deleted_at"))
    return Z.citation_plan(current, acts, articles).select("document_id", "raw", "cited_id")


@query("select count(*) filter (n_nationkey % 2 = 0 and o_orderkey % 7 < 5) as n_resolved, 2 * count(*) - count(*) filter (n_nationkey % 2 = 0 and o_orderkey % 7 < 5) as n_unresolved, (select count(*) from orders where o_orderkey % 11 = 0) as n_without_text from orders join nation on n_nationkey = o_orderkey % 25 where o_orderkey % 11 <> 0")
def citation_counts(t):
    """Resolved, unresolved, without text."""
    texts = _decisions(t)
    acts = t.nation.select(F.col("n_nationkey").alias("act_id"), F.concat(F.lit("Acte uniforme portant sur le lac "), "n_name").alias("title"))
    rows = t.nation.where("n_nationkey % 2 = 0").select(F.col("n_nationkey").alias("document_id"), F.explode(F.sequence(F.lit(1), F.lit(5))).alias("no"))
    articles = rows.select((F.col("document_id") * 10 + F.col("no")).alias("article_id"), "document_id", F.col("no").cast("string").alias("number"), F.lit(None).cast("date").alias("deleted_at"))
    return Z.plan_counts(Z.citation_plan(texts, acts, articles), texts)


@query("select document_key, min(o_orderkey) as id from (select o_custkey || '/' || year(o_orderdate) as document_key, o_orderkey from orders) where document_key not in (select c_custkey || '/1995' from customer) group by 1")
def new_decisions(t):
    """Decisions that aren't stored yet, one of each key."""
    rows = t.orders.select(F.concat_ws("/", "o_custkey", F.year("o_orderdate")).alias("document_key"), F.col("o_orderkey").alias("id"))
    stored = t.customer.select(F.concat_ws("/", "c_custkey", F.lit("1995")).alias("document_key"))
    return Z.decision_articles(rows, stored).select("document_key", "id")


# audits -----------------------------------------------------------------------------------------------------------------


def _store(t):
    docs = t.customer.select(F.col("c_custkey").alias("document_id"), F.when(F.col("c_custkey") % 9 == 0, "published").otherwise("draft").alias("curation_status"), F.col("c_mktsegment").alias("category"))
    articles = t.orders.select(F.col("o_orderkey").alias("article_id"), F.col("o_custkey").alias("document_id"), F.when(F.col("o_orderstatus") == "P", F.current_date()).alias("deleted_at"))
    versions = t.lineitem.select(F.col("l_orderkey").alias("article_id"), F.when((F.col("l_returnflag") == "R") & (F.col("l_linenumber") == 1), "validated").otherwise("pending").alias("validation_status"))
    return docs, articles, versions


_PROTECTED_SQL = "(select c_custkey as document_id from customer where c_custkey % 9 = 0 union select o_custkey from orders join lineitem on l_orderkey = o_orderkey where o_orderstatus <> 'P' and l_returnflag = 'R' and l_linenumber = 1)"


@query(f"select * from {_PROTECTED_SQL}")
def protected_documents(t):
    """Documents that hold an editor's work."""
    return A.protected(*_store(t))


@query(f"select o_orderkey as id, o_custkey as document_id, case when p.document_id is null then 'live' when o_orderkey % 5 = 0 then 'promote' when o_orderkey % 5 = 1 then 'discard' else 'staging' end as action from orders left join {_PROTECTED_SQL} p on p.document_id = o_custkey")
def replay_staging(t):
    """Where a new reading goes, and what becomes of a staged one."""
    k = F.col("o_orderkey")
    runs = t.orders.select(k.alias("id"), F.col("o_custkey").alias("document_id"), F.when(k % 5 == 0, "promote").when(k % 5 == 1, "discard").alias("asked"))
    return A.staged(runs, A.protected(*_store(t))).select("id", "document_id", "action")


@query("select event_id, case when event_type in ('click', 'view') then 'failed' else event_type end as status, case when event_type in ('click', 'view') then 'orphaned: service restart' when event_id % 2 = 0 then 'old' end as error from events")
def reap_runs(t):
    """Runs left in a passing state by a restart fail, with a note."""
    meta = F.when(F.col("event_id") % 2 == 0, F.create_map(F.lit("error"), F.lit("old"), F.lit("try"), F.lit("1")))
    rows = t.events.select("event_id", F.col("event_type").alias("status"), meta.alias("meta"))
    return A.reap(rows, "status", ["click", "view"], note="orphaned: service restart").select("event_id", "status", F.col("meta")["error"].alias("error"))


@query("select s_suppkey, string_agg(distinct p_brand, ', ' order by p_brand) as tags from supplier join lineitem on l_suppkey = s_suppkey join part on p_partkey = l_partkey group by 1")
def tags_of(t):
    """Names of the tags of each row in one text."""
    tags = t.part.select(F.col("p_partkey").alias("tag_id"), F.col("p_brand").alias("name"))
    links = t.lineitem.select(F.col("l_suppkey").alias("s_suppkey"), F.col("l_partkey").alias("tag_id"))
    return A.tag_names(tags, links, "s_suppkey")


@query("select o_orderkey from orders where o_orderkey % 50 in (select n_nationkey from nation)")
def by_json_sha(t):
    """Documents whose provenance holds a known checksum."""
    docs = t.orders.select("o_orderkey", F.to_json(F.struct((F.col("o_orderkey") % 50).cast("string").alias("sha256"))).alias("provenance"))
    return A.by_json_field(docs, "provenance", "$.sha256", t.nation.select(F.col("n_nationkey").cast("string").alias("sha")), "sha").select("o_orderkey")


@query("select c_custkey as document_id, c_custkey in (select o_custkey from orders where o_orderstatus = 'F') as has_preamble, c_custkey in (select o_custkey from orders where o_orderkey % 10 = 0) as has_artifact from customer")
def preamble_audit(t):
    """Which documents have a preamble, which an artefact."""
    docs = t.customer.select(F.col("c_custkey").alias("document_id"))
    of = lambda cond: t.orders.where(cond).select(F.col("o_custkey").alias("document_id"))
    return A.membership(docs, "document_id", {"has_preamble": of("o_orderstatus = 'F'"), "has_artifact": of("o_orderkey % 10 = 0")})


@query("select c_mktsegment as category, count(*) filter (c_custkey % 9 = 0) as published, count(*) filter (c_custkey % 9 <> 0) as draft from customer group by 1")
def audit_counts(t):
    """Documents of each category by curation status."""
    return A.counts_by(_store(t)[0], "category", "curation_status", ["published", "draft"])


@query("select e.event_id, case when e.event_id % 3 = 0 then c_custkey else o_custkey end as owner from events e left join customer on 'd' || c_custkey = 'd' || (e.event_id % 400) left join orders on o_orderkey = e.event_id % 900")
def dangling_refs(t):
    """The document that a reference to a document or an article belongs to."""
    k = F.col("event_id")
    refs = t.events.select("event_id", F.when(k % 3 == 0, F.concat(F.lit("d"), (k % 400).cast("string"))).otherwise(F.concat(F.lit("a"), (k % 900).cast("string"))).alias("ref"))
    docs = t.customer.select(F.concat(F.lit("d"), F.col("c_custkey").cast("string")).alias("document_id"))
    articles = t.orders.select(F.concat(F.lit("a"), F.col("o_orderkey").cast("string")).alias("article_id"), F.concat(F.lit("d"), F.col("o_custkey").cast("string")).alias("document_id"))
    return A.dangling(refs, docs, articles).select("event_id", F.substring("owner", 2, 20).cast("long").alias("owner"))


@query("select o_orderpriority || '/' || (o_orderkey % 100) as source, list_sort(list(distinct o_custkey)) as documents from orders group by 1 having count(distinct o_custkey) >= 2")
def shared_sources(t):
    """Sources that several documents were made of."""
    media = t.orders.select(F.concat_ws("/", "o_orderpriority", (F.col("o_orderkey") % 100)).alias("source"), "o_custkey")
    return A.shared_sources(media, "source", "o_custkey")


@query("select o_orderkey, case o_orderkey % 5 when 1 then 'malformed' when 2 then 'unknown_field' when 3 then 'missing_field' when 4 then 'malformed' end as error, case when o_orderkey % 5 = 0 then 'Loi' end as nature from orders")
def validate_records(t):
    """Metadata records under a strict schema."""
    k = F.col("o_orderkey")
    texts = ['{"nature": "Loi", "numero": "3", "articles": [{"numero": "1", "contenu": "x", "page": 2}]}', '{"nature": "Loi", ', '{"nature": "Loi", "autre": 1}', '{"numero": "3"}', '{"nature": "Loi", "articles": "x"}']
    rows = t.orders.select("o_orderkey", F.element_at(F.array(*map(F.lit, texts)), (k % 5 + 1).cast("int")).alias("json"))
    return A.validated_records(rows, "json").select("o_orderkey", "error", F.col("record.nature").alias("nature"))


@query("select coalesce(a.c_custkey, b.s_suppkey) as id, coalesce(a.name, b.s_name) as name, coalesce(a.c_nationkey, b.s_nationkey) as nation from (select c_custkey, case when c_custkey % 2 = 0 then c_name end as name, c_nationkey from customer where c_custkey > 3) a full join supplier b on a.c_custkey = b.s_suppkey")
def fill_missing(t):
    """An upsert that only fills what is missing."""
    stored = t.customer.where("c_custkey > 3").select(F.col("c_custkey").alias("id"), F.when(F.col("c_custkey") % 2 == 0, F.col("c_name")).alias("name"), F.col("c_nationkey").alias("nation"))
    return A.fill(stored, t.supplier.select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"), F.col("s_nationkey").alias("nation")), "id")


@query("select 'slug' as key_kind, lower(c_name) as key_value from customer union select 'segment', c_mktsegment from customer union select 'nation', c_nationkey::varchar from customer")
def target_snapshot(t):
    """Key sets of a target."""
    c = t.customer.withColumn("slug", F.lower("c_name"))
    return A.snapshot({"slug": (c, "slug"), "segment": (c, "c_mktsegment"), "nation": (c, "c_nationkey")})


@query("select o_orderkey as key, case when o_orderkey % 3 = 0 then 'copy' when o_orderkey % 3 = 1 then 'present' else 'differs' end as verdict from orders")
def copy_objects(t):
    """What copying objects comes to, by key and checksum."""
    k = F.col("o_orderkey")
    objects = t.orders.select(k.alias("key"), F.sha2(k.cast("string"), 256).alias("sha"))
    there = t.orders.where("o_orderkey % 3 <> 0").select(k.alias("key"), F.sha2(F.when(k % 3 == 1, k.cast("string")).otherwise("x"), 256).alias("sha"))
    return A.copy_verdicts(objects, there, "key", "sha").select("key", "verdict")


@query("select o_custkey, 0 as step, 'articles' as table_name, count(*) as n_rows from orders where o_custkey % 3 = 0 group by 1 union all select o_custkey, 1, 'versions', count(*) from orders join lineitem on l_orderkey = o_orderkey where o_custkey % 3 = 0 group by 1")
def push_order(t):
    """Rows to append, table by table in the order of their keys."""
    articles = t.orders.select("o_custkey", "o_orderkey")
    versions = t.lineitem.select(F.col("l_orderkey").alias("o_orderkey")).join(articles, "o_orderkey")
    return A.push_order({"articles": articles, "versions": versions}, t.customer.where("c_custkey % 3 = 0").select(F.col("c_custkey").alias("o_custkey")), "o_custkey")


@query(
    """select c_custkey as journal_id, n_documents, n_structured, case when c_custkey % 10 = 0 then 'no_text' when n_documents = 0 then 'to_do' when n_structured = n_documents then 'done' else 'partial' end as verdict
    from (select c_custkey, count(o_orderkey) as n_documents, count(*) filter (o_orderkey % 6 > 0) as n_structured from customer left join orders on o_custkey = c_custkey group by 1)"""
)
def journal_backfill(t):
    """What a second structuring of each journal would do."""
    journals = t.customer.select(F.col("c_custkey").alias("journal_id"), (F.col("c_custkey") % 10 != 0).alias("has_text"))
    docs = t.orders.select(F.col("o_custkey").alias("journal_id"), (F.col("o_orderkey") % 6).alias("n_articles"))
    return A.backfill_verdicts(journals, docs).select("journal_id", "n_documents", "n_structured", "verdict")


@query(
    """select action, count(*) as n from (select case when source in ('src1', 'src2') then 'excluded' when doc_id % 5 in (0, 1) and doc_id % 7 <> 0 and (doc_id % 5 = 0 or doc_id % 3 > 0) then 'done' else 'process' end as action from documents) group by 1"""
)
def batch_actions(t):
    """What a parsing run does with each entry."""
    k = F.col("doc_id")
    entries = t.documents.select(k.alias("id"), F.col("source").alias("kind"), F.sha2("text", 256).alias("sha256"))
    metrics = t.documents.select(k.alias("id"), F.when(k % 7 == 0, "x").otherwise(F.sha2("text", 256)).alias("source_sha256"), F.element_at(F.array(*map(F.lit, ["native", "ocr", "failed", "erreur", "?"])), (k % 5 + 1).cast("int")).alias("method"), F.lit(True).alias("has_md"), (k % 3 > 0).alias("has_json"))
    return A.batch_plan(entries, metrics, ["src1", "src2"], ["native", "ocr"]).groupBy("action").agg(F.count("*").alias("n"))


@query("select o_custkey, list(m order by o_orderkey)[:5] as messages, greatest(0, count(*) - 5) as n_more from (select o_custkey, o_orderkey, 'acte ' || o_orderkey as m from orders) group by 1")
def first_messages(t):
    """The first five messages of each document and how many there are beyond."""
    rows = t.orders.select("o_custkey", "o_orderkey", F.concat(F.lit("acte "), F.col("o_orderkey")).alias("m"))
    return A.first_and_rest(rows, "o_custkey", "m", "o_orderkey").select("o_custkey", "messages", F.col("n_more").cast("long").alias("n_more"))


# acquisition ------------------------------------------------------------------------------------------------------------


@query(
    """select o_custkey, (row_number() over (partition by o_custkey order by o_orderkey) - 1)::int as pos, 'ccja-' || strftime(o_orderdate, '%Y%m%d') || '-' || o_orderkey as slug, 'https://base.example/arret/ccja-' || strftime(o_orderdate, '%Y%m%d') || '-' || o_orderkey as url,
      case when o_orderkey % 4 = 0 then null else o_orderkey || '/' || year(o_orderdate) end as number, strftime(o_orderdate, '%Y-%m-%d') as date from orders"""
)
def decision_listing(t):
    """Decisions that a page of results lists."""
    k, d = F.col("o_orderkey"), F.col("o_orderdate")
    entry = F.concat(F.lit('<a class="a-unstyled" href="/arret/ccja-'), F.date_format(d, "yyyyMMdd"), F.lit("-"), k, F.lit('">Cour,\n  arrêt'), F.when(k % 4 > 0, F.concat(F.lit(", "), k, F.lit("/"), F.year(d))).otherwise(""), F.lit("</a>"))
    pages = t.orders.groupBy("o_custkey").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("o_orderkey", entry.alias("x")))), lambda s: s["x"]), "<br>").alias("html"))
    return Q.listing(pages, "o_custkey", "html", "https://base.example").select("o_custkey", "pos", "slug", "url", "number", "date")


@query("select c_custkey, case when c_custkey % 3 > 0 then 'https://base.example/q?a=1&page=' || c_custkey end as next, case when c_custkey % 2 = 0 then 'texte-' || c_custkey || '.pdf' else 'sans-nom.pdf' end as file from customer")
def next_pages(t):
    """Next page of a listing, name of the file behind an address."""
    k = F.col("c_custkey")
    html = F.when(k % 3 > 0, F.concat(F.lit('<p><a href="/q?a=1&amp;page='), k, F.lit('"> Suivant</a>'))).otherwise("<p>fin</p>")
    url = F.when(k % 2 == 0, F.concat(F.lit("https://base.example/x/texte-"), k, F.lit(".pdf?v=2"))).otherwise(F.concat(F.lit("https://base.example/voir?id="), k))
    return t.customer.select("c_custkey", Q.next_page(html, "https://base.example").alias("next"), Q.file_name(url, F.lit("sans-nom.pdf")).alias("file"))


@query(
    """with i as (select year(o_orderdate) as year, 'u' || (o_orderkey % 300) as url, case when year(o_orderdate) < 1994 then 0 when year(o_orderdate) < 1996 then 1 else 2 end as rank from orders where year(o_orderdate) between 1993 and 1997)
    select url, arg_min(year, rank * 10000 + year) as year, (['index', 'autoindex', 'enumeration'])[min(rank) + 1] as source from i group by 1"""
)
def series_plan(t):
    """Addresses of a series, enumerated only for years that no listing knows."""
    rows = t.orders.select(F.year("o_orderdate").alias("year"), F.concat(F.lit("u"), (F.col("o_orderkey") % 300).cast("string")).alias("url"))
    return Q.series_plan(rows.where("year < 1994"), rows.where("year between 1994 and 1995"), rows, [1993, 1994, 1995, 1996, 1997])


#: Fixed patterns of the query: subjects of a compilation and their canonical titles.
_SUBJECTS = [(r"S[UÛ]RET[EÉ]S", "Sûretés"), (r"M[EÉ]DIATION", "Médiation")]


def _layout(t):
    k = F.col("o_orderkey")
    titles = ["Acte uniforme sur les lacs", "DES SÛRETÉS EN MER", "la mediation", "Loi N° 4 du 3 mai", "Avertissement", "ACTE UNIFORME " + "x" * 90]
    title = F.element_at(F.array(*map(F.lit, titles)), (k % 6 + 1).cast("int"))
    page = (F.row_number().over(Window.partitionBy("o_custkey").orderBy("o_orderkey")) - 1).alias("page_idx")
    block = F.struct(F.when(k % 5 == 0, "text").otherwise("title").alias("type"), F.array(F.struct(F.array(F.struct(title.alias("content")), F.struct(F.lit(" ").alias("content"))).alias("spans"))).alias("lines"))
    return t.orders.select("o_custkey", "o_orderkey", page, F.array(block, block).alias("preproc_blocks"))


_LAYOUT_SQL = "(select o_custkey, row_number() over (partition by o_custkey order by o_orderkey) as page, (['Acte uniforme sur les lacs', 'Sûretés', 'Médiation', 'Loi N° 4 du 3 mai'])[o_orderkey % 6 + 1] as suggested, case when o_orderkey % 6 = 3 then 'LOI' else 'AU' end as type_code, o_orderkey % 5 > 0 and o_orderkey % 6 < 4 as starts from orders)"


@query(f"select o_custkey, page::int as start_page, suggested, type_code from {_LAYOUT_SQL} where starts")
def layout_boundaries(t):
    """starts of acts in a compilation by its layout."""
    return Q.layout_boundaries(_layout(t), "o_custkey", _SUBJECTS).select("o_custkey", "start_page", "suggested", "type_code")


@query(f"with p as (select o_custkey, page, sum(starts::int) over (partition by o_custkey order by page rows unbounded preceding) as act from {_LAYOUT_SQL}) select o_custkey, min(page)::int as page_start, count(*) as n_pages from p where act > 0 group by o_custkey, act")
def layout_slices(t):
    """pages of each act of a compilation."""
    pages = _layout(t)
    marks = Q.layout_boundaries(pages, "o_custkey", _SUBJECTS)
    out = Q.page_slices(pages.select("o_custkey", "page_idx"), marks, "o_custkey")
    return out.groupBy("o_custkey", "page_start").agg(F.count("*").alias("n_pages"))


@query("select o_custkey, page, o_orderkey from (select o_custkey, o_orderkey, row_number() over (partition by o_custkey order by o_orderkey)::int as page from orders) where page between 2 and 5")
def page_range(t):
    """Pages of a range, from 1, both ends included."""
    page = F.row_number().over(Window.partitionBy("o_custkey").orderBy("o_orderkey")).alias("page")
    return Q.page_range(t.orders.select("o_custkey", page, "o_orderkey"), "o_custkey", 2, 5)


@query("select o_custkey, count(*)::int as n_chunks, sha256(string_agg('acte ' || o_orderkey, chr(10) order by o_orderkey)) as sha from orders group by 1")
def merged_folders(t):
    """Chunk files of a folder put together by their first page."""
    chunks = t.orders.select("o_custkey", F.concat(F.lit("chunk_"), F.col("o_orderkey"), F.lit("_a_9.md")).alias("name"), F.concat(F.lit("acte "), F.col("o_orderkey")).alias("content"))
    return Q.merge_folder(chunks, "o_custkey", "name", "content").select("o_custkey", "n_chunks", F.sha2("content", 256).alias("sha"))


@query("with h as (select o_custkey, o_orderkey, 1 + o_orderkey % 3 as r from orders) select a.o_custkey, a.o_orderkey, max(b.o_orderkey) as parent from h a left join h b on b.o_custkey = a.o_custkey and b.o_orderkey < a.o_orderkey and b.r < a.r group by 1, 2")
def heading_parents(t):
    """Parent of each heading of a flat list by its level."""
    rows = t.orders.select("o_custkey", "o_orderkey", (F.col("o_orderkey") % 3 + 1).alias("r"))
    return H.heading_tree(rows, "o_custkey", "o_orderkey", "r").select("o_custkey", "o_orderkey", "parent")
