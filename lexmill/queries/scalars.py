"""Queries of functions that stand alone: keys, names, dates, uploads, small pieces of text, and small joins."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions import classify as C
from ..functions import clean as K
from ..operators import acts as acts_op
from ..operators import grids as G
from ..operators import hierarchy as H
from ..operators import ingest as I
from ..operators import lines as L
from ..plans import promotion as P
from ..sources import manifest as M
from ..streaming import jobs as J
from .records import _acts
from .registry import query


@query(
    """select c_custkey, lower(c_mktsegment) || '/n-' || c_nationkey || '/' || c_name as object_key, case c_custkey % 4 when 0 then 'Lac_' || c_custkey || '.pdf' when 1 then 'a_b-' || c_custkey || '.PDF' when 2 then 'document.pdf' else 'été_' || c_custkey end as file,
      case c_custkey % 4 when 0 then 'p-' || c_custkey when 1 then null when 2 then 'a' else 'b-c' end as parent from customer"""
)
def stored_names(t):
    """Object keys, safe file names, parents by path."""
    k = F.col("c_custkey").cast("string")
    of = lambda *x: F.element_at(F.array(*x), (F.col("c_custkey") % 4 + 1).cast("int"))
    name = of(F.concat(F.lit("/up/..Lac "), k, F.lit(".pdf")), F.concat(F.lit("C:\\x\\a b-"), k, F.lit(".PDF")), F.lit("/"), F.concat(F.lit("été "), k))
    path = of(F.concat(F.lit("n_r.n_p_"), k, F.lit(".n_x")), F.lit("n_root"), F.lit("n_a.n_b"), F.lit("n_a.n_b_c.n_d"))
    return t.customer.select("c_custkey", K.object_key(F.col("c_mktsegment"), F.concat(F.lit("N "), "c_nationkey"), F.col("c_name")).alias("object_key"), C.sanitize_filename(name).alias("file"), C.parent_of_path(path).alias("parent"))


@query(
    """select o_orderkey, case when o_orderkey % 3 = 0 then o_orderdate::date end as date, o_orderkey % 5 in (0, 1, 3) as real_title, case o_orderkey % 4 when 0 then 'empty' when 1 then 'no_header' when 2 then 'too_large' else 'accepted' end as verdict from orders"""
)
def checked_inputs(t):
    """Dates, titles and uploads that are what they say."""
    k, d = F.col("o_orderkey"), F.date_format("o_orderdate", "yyyy-MM-dd")
    date = F.when(k % 3 == 0, d).when(k % 3 == 1, "2020-02-31").otherwise(F.concat(d, F.lit(" ")))
    rest = F.element_at(F.array(*map(F.lit, [" N° 3", " du 3 mai 2020", " de la rive", " DES GRANDS LACS", " Ab"])), (k % 5 + 1).cast("int"))
    content = F.when(k % 4 == 0, "").when(k % 4 == 1, F.concat(F.repeat(F.lit("x"), 1020), F.lit("%PDF-1.4"))).when(k % 4 == 2, F.concat(F.lit("%PDF-1.4"), F.repeat(F.lit("y"), 2000))).otherwise("\n%PDF-1.7 ...").cast("binary")
    return t.orders.select("o_orderkey", C.iso_date(date).alias("date"), C.is_real_title(rest).alias("real_title"), C.reception(content, 2000).alias("verdict"))


@query(
    """select doc_id, sha256(replace(replace(replace(translate(lower('Été ' || source), 'é', 'e'), ' ', ''), chr(9), ''), chr(10), '')) as sha, 'la maison est ' || source || chr(10) || chr(10) || 'fin' as joined, ['la', 'mer', 'src'] as words, doc_id % 2 = 0 as noise, doc_id % 3 = 0 as has_table,
      case when doc_id % 2 = 0 then 'Lac ' || doc_id || ' contre Mer' end as parties from documents"""
)
def small_texts(t):
    """Haystacks, joined lines, words, page noise, table marks, parties of a case."""
    k, s = F.col("doc_id"), F.col("source")
    noise = F.when(k % 2 == 0, "p. 12\n\nTITRE IV : des lacs").otherwise("p. 12\nUn texte.")
    table = F.when(k % 3 == 0, "x <TABLE border=1>").otherwise("x tablette <tab>")
    case = F.when(k % 2 == 0, F.concat(F.lit("Affaire : Lac "), k.cast("string"), F.lit(" (Conseil : Maître A) contre Mer ; suite"))).otherwise("Affaire : Lac, avocat B, contre Mer ;")
    return t.documents.select(
        "doc_id", F.sha2(K.haystack(F.concat(F.lit("Été\t\n "), s)), 256).alias("sha"), K.dehyphenate(F.concat(F.lit("la mai-\nson est\n"), s, F.lit("\n\nfin"))).alias("joined"),
        K.words(F.concat(F.lit("la 12 mer, "), F.regexp_replace(s, r"\d", ""))).alias("words"), K.is_banner_noise(noise).alias("noise"), K.has_table(table).alias("has_table"), C.parties(case).alias("parties"),
    )


@query("select o_custkey, sha256(string_agg('[[DOC_PAGE:' || p || ']]' || chr(10) || case when o_orderkey % 2 = 0 then '# ' else '' end || 'acte ' || o_orderkey, chr(10) order by p)) as sha from (select *, row_number() over (partition by o_custkey order by o_orderkey) as p from orders) group by 1")
def layout_text(t):
    """Layout pages as text with markers."""
    k = F.col("o_orderkey")
    span = lambda x: F.struct(x.alias("content"), F.lit(None).cast("string").alias("html"))
    block = F.struct(F.when(k % 2 == 0, "title").otherwise("text").alias("type"), F.array(F.struct(F.array(span(F.lit("acte ")), span(k.cast("string"))).alias("spans"))).alias("lines"))
    none = F.array().cast("array<struct<type:string,lines:array<struct<spans:array<struct<content:string,html:string>>>>>>")
    page = (F.row_number().over(Window.partitionBy("o_custkey").orderBy("o_orderkey")) - 1).alias("page_idx")
    pages = t.orders.select("o_custkey", page, F.when(k % 3 == 0, F.array(block)).otherwise(none).alias("para_blocks"), F.array(block).alias("preproc_blocks"))
    return L.layout_markdown(pages, "o_custkey").select("o_custkey", F.sha2("text", 256).alias("sha"))


@query(
    """with l as (select l_orderkey, row_number() over (partition by l_orderkey order by l_linenumber, l_partkey, l_extendedprice) as n from lineitem), c as (select l_orderkey, max(n) as m from l group by 1)
    select l_orderkey, 'PREAMBULE' as number, 1 as n from c union all select l_orderkey, (n % 3 + 1)::varchar, count(*) from l group by 1, 2 union all select l_orderkey, 'SIGNATURE', 1 from c"""
)
def leaf_numbers(t):
    """Leaves of an act by the number they show."""
    nodes = H.parse_acts(_acts(t), "l_orderkey", "text")
    return H.leaves(nodes).groupBy("l_orderkey", "number").agg(F.count("*").alias("n"))


@query("select distinct l_orderkey, 'Vu la charte ;' as content from lineitem")
def root_preambles(t):
    """Preambles at the root of an act."""
    return H.root_texts(H.parse_acts(_acts(t), "l_orderkey", "text"), "PREAMBULE").select("l_orderkey", "content")


@query("select o_custkey, count(*)::int - 1 as matched from orders group by 1 having count(*) > 1")
def aligned_trees(t):
    """Matching blocks of two readings of a tree, the second without its first node."""
    rows = t.orders.groupBy("o_custkey").agg(F.array_sort(F.collect_list(F.col("o_orderkey").cast("string"))).alias("a")).where("size(a) > 1")
    out = H.align_trees(rows.withColumn("b", F.slice("a", 2, 1_000_000)), "a", "b")
    return out.select("o_custkey", F.aggregate("blocks", F.lit(0), lambda s, x: s + x["size"]).alias("matched"))


@query("select l_orderkey, l_linenumber, l_partkey, case when l_suppkey % 2 = 0 then -l_suppkey else l_suppkey end as institution from lineitem")
def remapped_ids(t):
    """Ids replaced by a mapping."""
    mapping = t.supplier.where("s_suppkey % 2 = 0").select(F.col("s_suppkey").alias("old"), (-F.col("s_suppkey")).alias("new"))
    return P.remap(t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", F.col("l_suppkey").alias("institution")), "institution", mapping).select("l_orderkey", "l_linenumber", "l_partkey", "institution")


@query("select event_id, case when event_type = 'click' and event_id % 2 = 0 then 'pending' when event_type = 'click' then 'failed' else 'done' end as status, case when event_type = 'click' and event_id % 2 = 0 then 0 else 3 end as attempts from events")
def relaunched_jobs(t):
    """Only failed jobs go back to the queue."""
    jobs = t.events.select("event_id", F.when(F.col("event_type") == "click", "failed").otherwise("done").alias("status"), F.lit(3).alias("attempts"))
    return J.relaunch(jobs, F.col("event_id") % 2 == 0).select("event_id", "status", "attempts")


@query("select coalesce(s_suppkey, c_custkey) as id, coalesce(s_name, c_name) as titre from (select * from customer where c_custkey > 2) full join supplier on s_suppkey = c_custkey")
def manifest_upsert(t):
    """New entries replace those of their id."""
    entries = t.customer.where("c_custkey > 2").select(F.col("c_custkey").alias("id"), F.col("c_name").alias("titre"))
    return M.upsert(entries, t.supplier.select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("titre")))


@query("select c_custkey as id, case when c_custkey % 3 = 0 then 'md/' || c_custkey when c_custkey % 2 = 0 then 'old/' || c_custkey end as path from customer")
def artefact_paths(t):
    """Path of each entry's artefact, by id or by the older name."""
    k = F.col("c_custkey")
    entries = t.customer.select(k.alias("id"), F.col("c_name").alias("basename"))
    primary = t.customer.where("c_custkey % 3 = 0").select(k.alias("id"), F.concat(F.lit("md/"), k).alias("path"))
    return M.artefact(primary, t.customer.where("c_custkey % 2 = 0").select(F.col("c_name").alias("basename"), F.concat(F.lit("old/"), k).alias("path")), entries)


@query(
    """with k as (select o_custkey, o_orderkey, 'flux:' || (o_orderkey % 20) as base, row_number() over (partition by o_custkey, o_orderkey % 20 order by o_orderkey) as k from orders)
    select o_custkey, o_orderkey, base || case when k > 1 then '_acte_' || k else '' end as document_key from k where base || case when k > 1 then '_acte_' || k else '' end not in ('flux:3', 'flux:4_acte_2')"""
)
def new_act_keys(t):
    """Keys of acts made unique; keys that are taken are left alone."""
    rows = t.orders.select("o_custkey", "o_orderkey", F.concat(F.lit("flux:"), (F.col("o_orderkey") % 20).cast("string")).alias("base"))
    taken = t.region.where("r_regionkey < 2").select(F.when(F.col("r_regionkey") == 0, "flux:3").otherwise("flux:4_acte_2").alias("document_key"))
    return acts_op.new_acts(acts_op.key_suffix(rows, "o_custkey", "o_orderkey", "base"), taken).select("o_custkey", "o_orderkey", "document_key")


@query("select o_orderkey, case when o_orderpriority in (select distinct p from (values ('1-URGENT'), ('2-HIGH')) v(p)) then o_orderpriority end as code from orders")
def known_codes(t):
    """Codes that the dimension doesn't hold are void."""
    dim = t.region.where("r_regionkey < 2").select(F.when(F.col("r_regionkey") == 0, "1-URGENT").otherwise("2-HIGH").alias("code_key"))
    return C.known_codes(t.orders.select("o_orderkey", F.col("o_orderpriority").alias("code")), "code", dim, "code_key").select("o_orderkey", "code")


@query("select o_custkey, count(*) as n_versions from orders join lineitem on l_orderkey = o_orderkey group by 1")
def version_counts(t):
    """Versions of each document's articles."""
    return t.orders.select("o_orderkey", "o_custkey").join(t.lineitem.select(F.col("l_orderkey").alias("o_orderkey")), "o_orderkey").groupBy("o_custkey").agg(F.count("*").alias("n_versions"))


@query(
    """with l as (select o_custkey, o_orderkey % 4 as n, o_orderkey, row_number() over (partition by o_custkey order by o_orderkey) as part, row_number() over (partition by o_custkey, o_orderkey % 4 order by o_orderkey) as k from orders)
    select o_custkey, part::int as part, n || case when k = 1 then '' when k = 2 then '_dup' else '_dup' || (k - 1) end as number, 'Texte ' || o_orderkey as content from l"""
)
def header_split(t):
    """articles cut at header lines."""
    k = F.col("o_orderkey")
    text = F.concat(F.lit("tête\n"), F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("o_orderkey"))), lambda x: F.concat(F.lit("Art. "), (x["o_orderkey"] % 4).cast("string"), F.lit("\nTexte "), x["o_orderkey"].cast("string"))), "\n"))
    lines = L.lines_of(t.orders.groupBy("o_custkey").agg(text.alias("text")), "o_custkey", "text")
    return L.split_by_header(lines, "o_custkey", r"^Art\. (\d+)$").select("o_custkey", F.col("part").cast("int").alias("part"), "number", "content")


@query("select o_orderkey, case when o_orderkey % 3 = 0 then 'DE: acte ' || o_orderkey || ' ' end as segment from orders")
def marked_segments(t):
    """what stands between two marks."""
    k = F.col("o_orderkey")
    text = F.when(k % 3 == 0, F.concat(F.lit("x DE: acte "), k, F.lit(" FIN y FIN"))).when(k % 3 == 1, "FIN DE: z").otherwise("rien")
    return t.orders.select("o_orderkey", L.between_marks(text, "DE:", "FIN").alias("segment"))


@query("select o_orderkey, o_custkey, o_totalprice from orders")
def copied_columns(t):
    """The columns that both sides have, in the target's order, some left out."""
    target = t.orders.select("o_orderkey", "o_custkey", F.lit(1).alias("own"), "o_totalprice", "o_orderstatus").limit(0)
    return P.copy_columns(t.orders, target, ("o_orderstatus",))
