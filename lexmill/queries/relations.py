"""Queries on series, trees, grids, joins, aggregates, plans and jobs (inventory parts G-O)."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..operators import dedup as D
from ..operators import diff as X
from ..operators import grids as G
from ..operators import hierarchy as H
from ..operators import sequence as S
from ..operators.least import least_jaccard
from ..plans import promotion as P
from ..streaming import jobs as J
from .registry import query

_SERIES_SQL = "(select l_orderkey, l_partkey, row_number() over (partition by l_orderkey order by l_shipdate, l_linenumber, l_partkey, l_suppkey, l_extendedprice) as pos, (l_partkey % 19 + 1)::int as n from lineitem)"


def _series(t):
    """Article numbers of a document: a part number stands for each."""
    w = Window.partitionBy("l_orderkey").orderBy("l_shipdate", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice")
    return t.lineitem.select("l_orderkey", "l_partkey", F.row_number().over(w).alias("pos"), (F.col("l_partkey") % 19 + 1).cast("int").alias("n"))


@query(f'select l_orderkey, n + 1 as start, x - 1 as "end", x - n - 1 as size from (select l_orderkey, n, lead(n) over (partition by l_orderkey order by n) as x from (select distinct l_orderkey, n from {_SERIES_SQL})) where x - n > 1')
def missing_runs(t):
    """Runs of missing numbers."""
    return S.missing_runs(_series(t), "l_orderkey", "n")


@query(f"select l_orderkey, sum(case when n <= 3 and was > 10 then 1 else 0 end)::bigint as restarts from (select *, lag(n) over (partition by l_orderkey order by pos) as was from {_SERIES_SQL}) group by 1")
def series_restarts(t):
    """Restarts of a series."""
    return S.restarts(_series(t), "l_orderkey", ["pos"], "n")


_ISLANDS = f"""s as (select *, lag(n) over (partition by l_orderkey order by pos) as was, pos - 1 as idx from {_SERIES_SQL}),
    i as (select *, coalesce(sum(case when n > was then 0 when was is null then 0 else 1 end) over (partition by l_orderkey order by pos), 0) as island from s),
    f as (select l_orderkey, island, min(idx) as a, max(idx) as b, count(*) as len, arg_min(n, idx) as fn, arg_min(coalesce(was, -1), idx) as fw from i group by 1, 2),
    e as (select *, fn <= 3 and fw > fn and len >= 3 as embedded from f)"""


@query(f'with {_ISLANDS} select l_orderkey, a as start, b as "end" from e where embedded')
def embedded_series(t):
    """Series embedded in another."""
    return S.embedded_runs(_series(t), "l_orderkey", ["pos"], "n")


@query(
    f"""with {_ISLANDS}, r as (select l_orderkey, sum(case when n <= 3 and was > 10 then 1 else 0 end) >= 2 as comp, sum(case when n <= 3 and was > 10 then 1 else 0 end) as restarts from s group by 1),
    a as (select i.*, embedded, comp, count(*) over (partition by i.l_orderkey, n order by pos rows between unbounded preceding and 1 preceding) as before from i join e on i.l_orderkey = e.l_orderkey and i.island = e.island join r on r.l_orderkey = i.l_orderkey),
    g as (select l_orderkey, n + 1 as a, x - 1 as b, x - n - 1 as size from (select l_orderkey, n, lead(n) over (partition by l_orderkey order by n) as x from (select distinct l_orderkey, n from s)) where x - n > 1),
    u as (select l_orderkey, 'article_doublon' as kind, 'blocking' as severity, n::bigint as first, n::bigint as last from a where case when comp then was = n else before > 0 and not embedded end
      union all select a.l_orderkey, 'compilation_suspectee', 'warning', min(n), max(n) from a where embedded and not comp group by a.l_orderkey, island
      union all select l_orderkey, 'compilation_suspectee', 'blocking', restarts::bigint, null from r where comp
      union all select l_orderkey, 'bloc_manquant', 'blocking', a, b from g where size >= 10
      union all select g.l_orderkey, 'article_manquant', 'blocking', a, b from g join r using (l_orderkey) where size < 10 and not comp)
    select * from u"""
)
def sequence_anomalies(t):
    """Typed anomalies of each series."""
    return S.anomalies(_series(t), "l_orderkey", ["pos"], "n", "pos").select("l_orderkey", "kind", "severity", "first", "last")


@query(f"select l_orderkey, pos, case when k > 0 then n || '_doublon_' || k else n::varchar end as unique_number from (select *, row_number() over (partition by l_orderkey, n order by pos) - 1 as k from {_SERIES_SQL})")
def duplicate_suffix(t):
    """Numbers made unique."""
    return H.unique_numbers(_series(t).withColumn("n", F.col("n").cast("string")), "l_orderkey", "n", "pos").select("l_orderkey", "pos", "unique_number")


@query(
    f"""with {_ISLANDS}, d as (select *, row_number() over (partition by l_orderkey, n order by pos) - 1 as k from i)
    select d.l_orderkey, d.pos, n || '_doublon_' || k as unique_number, case when embedded then 'warning' else 'blocking' end as severity from d join e on d.l_orderkey = e.l_orderkey and d.island = e.island where k > 0"""
)
def rename_flags(t):
    """A flag for each renamed number."""
    rows = _series(t).withColumns({"number": F.col("n").cast("string"), "ident": F.concat_ws("-", "l_orderkey", "pos")})
    rows = H.unique_numbers(rows, "l_orderkey", "number", "pos")
    out = S.rename_flags(rows, "l_orderkey", ["pos"], "n", "number", "unique_number", "ident")
    return out.select("l_orderkey", F.split_part("ident", F.lit("-"), F.lit(2)).cast("int").alias("pos"), "unique_number", "severity")


@query(
    f"""with d as (select *, row_number() over (partition by l_orderkey, n order by pos) - 1 as k from {_SERIES_SQL})
    select l_orderkey, pos from d where k > 0 and not (pos % 3 = 0)"""
)
def unflagged_renames(t):
    """Renamed articles that no flag covers."""
    rows = H.unique_numbers(_series(t).withColumns({"n": F.col("n").cast("string"), "ident": F.concat_ws("-", "l_orderkey", "pos")}), "l_orderkey", "n", "pos")
    flags = rows.where("pos % 3 = 0").select("ident", F.lit("article_doublon").alias("kind"))
    return S.unflagged_renames(rows, flags, "ident", "unique_number").select("l_orderkey", "pos")


@query("select o_orderkey, case when o_orderkey % 5 = 0 then 'unknown' when o_orderkey % 5 = 1 then 'mismatch' when o_orderstatus = 'F' then 'already' else 'resolved' end as verdict from orders")
def resolve_flags(t):
    """Verdicts on listed flags."""
    o = t.orders
    flags = o.where("o_orderkey % 5 <> 0").select(F.col("o_orderkey").alias("id"), F.col("o_custkey").alias("doc"), F.lit("d").alias("kind"), (F.col("o_orderstatus") == "F").alias("resolved"))
    listed = o.select(F.col("o_orderkey").alias("id"), F.col("o_custkey").alias("doc"), F.when(F.col("o_orderkey") % 5 == 1, "x").otherwise("d").alias("kind"))
    return S.resolve_flags(flags, listed, "doc").select(F.col("id").alias("o_orderkey"), "verdict")


@query("select o_orderkey as id, o_custkey as doc, 'heuristic' as source, false as resolved from orders where not (o_orderstatus <> 'F' and o_custkey % 3 = 0) and o_orderkey % 2 = 0 union all select -c_custkey, c_custkey, 'heuristic', false from customer where c_custkey % 3 = 0")
def replace_flags(t):
    """Unresolved heuristic flags of the documents at hand are replaced."""
    flags = t.orders.where("o_orderkey % 2 = 0").select(F.col("o_orderkey").alias("id"), F.col("o_custkey").alias("doc"), F.lit("heuristic").alias("source"), (F.col("o_orderstatus") == "F").alias("resolved"))
    new = t.customer.where("c_custkey % 3 = 0").select((-F.col("c_custkey")).alias("id"), F.col("c_custkey").alias("doc"), F.lit("heuristic").alias("source"), F.lit(False).alias("resolved"))
    out = S.replace_flags(flags, new, "doc").select("id", "doc", "source", "resolved")
    return out.withColumn("resolved", F.lit(False))


# G: trees ---------------------------------------------------------------------------------------------------------------


@query(
    """with n as (select 'r' || r_regionkey as id, [r_regionkey, -1, -1] as path from region union all select 'n' || n_nationkey, [n_regionkey, n_nationkey, -1] from nation union all select 'c' || c_custkey, [n_regionkey, n_nationkey, c_custkey] from customer join nation on c_nationkey = n_nationkey)
    select id, row_number() over (order by path) as preorder from n"""
)
def tree_preorder(t):
    """Reading order of region, nation and customer."""
    r = t.region.select(F.concat(F.lit("r"), "r_regionkey").alias("id"), F.array("r_regionkey", F.lit(-1), F.lit(-1)).alias("ordinals"), F.lit(1).alias("doc"))
    n = t.nation.select(F.concat(F.lit("n"), "n_nationkey").alias("id"), F.array("n_regionkey", "n_nationkey", F.lit(-1)).alias("ordinals"), F.lit(1).alias("doc"))
    c = t.customer.join(F.broadcast(t.nation), F.col("c_nationkey") == F.col("n_nationkey")).select(F.concat(F.lit("c"), "c_custkey").alias("id"), F.array(F.col("n_regionkey").cast("int"), F.col("n_nationkey").cast("int"), F.col("c_custkey").cast("int")).alias("ordinals"), F.lit(1).alias("doc"))
    return H.preorder(r.unionByName(n).unionByName(c), "doc").select("id", "preorder")


@query("select 'r' || r_regionkey as node_id, count(c_custkey) as n_articles from region left join nation on n_regionkey = r_regionkey left join customer on c_nationkey = n_nationkey group by 1 union all select 'n' || n_nationkey, count(c_custkey) from nation left join customer on c_nationkey = n_nationkey group by 1")
def subtree_counts(t):
    """Articles below each node."""
    nodes = t.region.select(F.concat(F.lit("r"), "r_regionkey").alias("node_id")).unionByName(t.nation.select(F.concat(F.lit("n"), "n_nationkey").alias("node_id")))
    c = t.customer.join(F.broadcast(t.nation), F.col("c_nationkey") == F.col("n_nationkey"))
    return H.subtree_counts(nodes, c.select(F.array(F.concat(F.lit("r"), "n_regionkey"), F.concat(F.lit("n"), "n_nationkey")).alias("ancestors")))


@query("select c_custkey, case when n_nationkey % 3 <> 0 then 'n' || n_nationkey when n_regionkey <> 2 then 'r' || n_regionkey end as parent from customer join nation on c_nationkey = n_nationkey")
def prune_nodes(t):
    """Nearest ancestor that stays after divisions are taken out."""
    gone = t.nation.where("n_nationkey % 3 = 0").select(F.concat(F.lit("n"), "n_nationkey").alias("x")).unionByName(t.region.where("r_regionkey = 2").select(F.concat(F.lit("r"), "r_regionkey").alias("x")))
    gone = gone.agg(F.collect_list("x").alias("gone"))  # nodes of one document
    c = t.customer.join(F.broadcast(t.nation), F.col("c_nationkey") == F.col("n_nationkey")).crossJoin(F.broadcast(gone))
    path = F.array(F.concat(F.lit("r"), "n_regionkey"), F.concat(F.lit("n"), "n_nationkey"))
    return c.select("c_custkey", H.nearest_kept(path, F.col("gone")).alias("parent"))


@query("select l_orderkey, l_linenumber, l_partkey from lineitem left join (select o_orderkey as node_id, o_custkey % 7 as owner from orders where o_orderkey % 11 > 0) on node_id = l_orderkey where l_partkey % 7 is distinct from owner")
def parent_consistency(t):
    """Parents of another document, or none."""
    children = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", (F.col("l_partkey") % 7).alias("doc"))
    parents = t.orders.where("o_orderkey % 11 > 0").select(F.col("o_orderkey").alias("node_id"), (F.col("o_custkey") % 7).alias("doc"))
    return H.parent_mismatch(children, parents, "l_orderkey", "doc").select("l_orderkey", "l_linenumber", "l_partkey")


@query(
    """with v as (select o_custkey, o_orderkey, o_orderdate::date as a, o_orderdate::date + (o_orderkey % 90 + 1)::int as b from orders)
    select o_custkey, o_orderkey from (select *, max(b) over (partition by o_custkey order by a, b, o_orderkey rows between unbounded preceding and 1 preceding) as top from v) where top > a"""
)
def interval_overlap(t):
    """Validity intervals that overlap an earlier one."""
    v = t.orders.select("o_custkey", "o_orderkey", F.to_date("o_orderdate").alias("a"), F.date_add(F.to_date("o_orderdate"), (F.col("o_orderkey") % 90 + 1).cast("int")).alias("b"))
    return H.overlaps(v, "o_custkey", "a", "b", "o_orderkey").select("o_custkey", "o_orderkey")


@query(
    """with l as (select l_orderkey, l_linenumber, 'La part ' || l_partkey || ' est livrée.' || chr(10) || 'Elle compte.' as content, row_number() over (partition by l_orderkey order by l_linenumber, l_partkey::varchar) as n, count(*) over (partition by l_orderkey) as many from lineitem),
    o as (select distinct l_orderkey, many from l), n as (
      select l_orderkey, 0 as node_id, null::int as parent_id, 0 as depth, 'ARTICLE' as type, 'Unique' as number, '' as title, 'Un texte sans articles.' as content, null::int as page from o where l_orderkey % 10 = 0
      union all select l_orderkey, 0, null, 0, 'PREAMBULE', '', '', 'Vu la charte ;', 1 from o where l_orderkey % 10 > 0
      union all select l_orderkey, 1, null, 0, 'TITRE', 'I', 'DES PARTS', '', 1 from o where l_orderkey % 10 > 0
      union all select l_orderkey, n + 1, 1, 1, 'ARTICLE', l_linenumber::varchar, '', content, 1 from l where l_orderkey % 10 > 0
      union all select l_orderkey, many + 2, null, 0, 'SIGNATURE', '', '', 'Fait à Lacville, le 3 mai 2020' || chr(10) || 'Jean Pêcheur', 1 from o where l_orderkey % 10 > 0)
    select l_orderkey, node_id::int as node_id, parent_id, depth, type, number, title, content, page, null::int as page_end from n"""
)
def act_hierarchy(t):
    """Nodes of acts made of orders and their lines, with the whole text where there is no structure."""
    line = F.concat(F.lit("Article "), F.col("l_linenumber"), F.lit(" : La part "), F.col("l_partkey"), F.lit(" est livrée.\nElle compte."))
    rows = t.lineitem.groupBy("l_orderkey").agg(F.array_sort(F.collect_list(F.struct("l_linenumber", line.alias("x")))).alias("l"))
    text = F.concat(F.lit("[[DOC_PAGE:1]]\nVu la charte ;\nTITRE I : DES PARTS\n"), F.array_join(F.transform("l", lambda x: x["x"]), "\n"), F.lit("\nFait à Lacville, le 3 mai 2020\nJean Pêcheur"))
    docs = rows.select("l_orderkey", F.when(F.col("l_orderkey") % 10 == 0, "Un texte sans articles.").otherwise(text).alias("text"))
    return H.parse_acts(docs, "l_orderkey", "text", whole=True)


# I: grids ---------------------------------------------------------------------------------------------------------------

#: Each order is a grid, over all of lineitem.
_GRIDS_SQL = "(select l_orderkey as id, row_number() over (partition by l_orderkey order by l_linenumber, l_partkey, l_extendedprice) - 1 as row_no, l_quantity as a, l_linenumber::double as b, l_quantity + l_linenumber + case when l_partkey % 9 = 0 then 5 else 0 end as c from lineitem)"


def _grids(rows):
    """Three columns of numbers, the last the sum of the others but for some rows; written the way texts write numbers."""
    w = Window.partitionBy("id").orderBy("l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice")
    a, b = F.col("l_quantity"), F.col("l_linenumber").cast("double")
    text = lambda x: F.replace(x.cast("decimal(18,1)").cast("string"), F.lit("."), F.lit(","))
    rows = rows.select("id", F.row_number().over(w).alias("o"), F.array(text(a), text(b), text(a + b + F.when(F.col("l_partkey") % 9 == 0, 5).otherwise(0))).alias("r"))
    return rows.groupBy("id").agg(F.array_sort(F.collect_list(F.struct("o", "r"))).alias("l")).select("id", F.transform("l", lambda x: x["r"]).alias("rows"))


def _row_sums(grids):
    return G.row_sums(G.cells(grids, "id"), "id").select("id", F.col("col_no"), F.col("row_no").cast("long").alias("row_no"), "value", "expected")


@query(
    f"""with g as {_GRIDS_SQL}, h as (select id, count(*) filter (abs(c - (a + b)) <= 1) as hits, count(*) filter (abs(c - (a + b)) > 1) as misses from g group by 1)
    select g.id, 2 as col_no, g.row_no, c as value, a + b as expected from g join h using (id) where hits >= 3 and hits >= 2 * misses and abs(c - (a + b)) > 1"""
)
def table_row_sum(t):
    """Rows that break the sum which the others keep; each order is a grid."""
    return _row_sums(_grids(t.lineitem.withColumn("id", F.col("l_orderkey"))))


def _totals(grids):
    cells = G.cells(grids, "id")
    sums = cells.groupBy("id", "col_no").agg(F.sum("value").alias("s"), F.max("row_no").alias("m"))
    last = sums.select("id", (F.col("m") + 1).alias("row_no"), "col_no", F.when((F.col("col_no") == 0) & (F.col("id") % 2 == 0), F.col("s") * 1.005).otherwise(F.col("s")).alias("value"))
    return G.column_totals(cells.unionByName(last), "id").select("id", "col_no", "announced", "total")


@query(
    f"""with s as (select id, sum(a) as a, count(*) as n from {_GRIDS_SQL} group by 1)
    select id, 0 as col_no, a * 1.005::double as announced, a as total from s where n >= 3 and abs(a * 0.005::double) > 1 and id % 2 = 0"""
)
def table_total(t):
    """The same over the grids of all orders."""
    return _totals(_grids(t.lineitem.withColumn("id", F.col("l_orderkey"))))


@query("select r_regionkey, 'Liste' || chr(10) || 'clé | nom' || chr(10) || string_agg(n_nationkey || ' | ' || n_name, chr(10) order by n_nationkey) as text from region join nation on n_regionkey = r_regionkey group by 1")
def table_linearise(t):
    """Grids as lines."""
    rows = t.nation.groupBy("n_regionkey").agg(F.array_sort(F.collect_list(F.struct("n_nationkey", "n_name"))).alias("l"))
    cells = F.transform("l", lambda x: F.array(x["n_nationkey"].cast("string"), x["n_name"]))
    return rows.select(F.col("n_regionkey").alias("r_regionkey"), G.linear(F.lit("Liste"), F.array(F.lit("clé"), F.lit("nom")), cells).alias("text"))


@query(
    """select n_regionkey, 3 as n_headers, count(*)::int as n_rows, '' as codes, 'Voici :' || chr(10) || 'clé | nom | x' || chr(10) || string_agg(n_nationkey || ' | ' || n_name || ' | ', chr(10) order by n_nationkey) || chr(10) || 'fin' as text, false as subscription from nation group by 1"""
)
def parse_tables(t):
    """HTML tables to grids, checked, and put into their texts as lines."""
    row = F.concat(F.lit("<tr><td>"), "n_nationkey", F.lit("</td><td colspan='2'>"), "n_name", F.lit("</td></tr>"))
    html = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("n_nationkey", row.alias("r")))), lambda x: x["r"]), "")
    docs = t.nation.groupBy("n_regionkey").agg(F.concat(F.lit("Voici :\n<table><tr><th>clé</th><th>nom</th><th>x</th></tr>"), html, F.lit("</table>\nfin")).alias("html"))
    g, n = G.grid(F.col("html")), G.normalise_content(F.col("html"))
    out = docs.withColumns({"g": g, "n": n})
    return out.select("n_regionkey", F.size("g.headers").alias("n_headers"), F.size("g.rows").alias("n_rows"), F.array_join(G.geometry(F.col("g.headers"), F.col("g.rows")), ",").alias("codes"), F.col("n.text").alias("text"), G.is_subscription_grid(F.col("g.headers"), F.col("g.rows")).alias("subscription"))


# J, K, L: joins, aggregates, order ------------------------------------------------------------------------------------------


@query("select o_custkey, o_orderkey, valid_from from (select o_custkey, o_orderkey, o_orderdate as valid_from, lead(o_orderdate) over (partition by o_custkey order by o_orderdate, o_orderkey) as valid_to from orders) where valid_to is null")
def current_version(t):
    """Versions whose interval is open."""
    w = Window.partitionBy("o_custkey").orderBy("o_orderdate", "o_orderkey")
    v = t.orders.select("o_custkey", "o_orderkey", F.col("o_orderdate").alias("valid_from"), F.lead("o_orderdate").over(w).alias("valid_to"))
    return X.current_versions(v).select("o_custkey", "o_orderkey", "valid_from")


@query("select o_custkey, o_orderkey, o_totalprice from (select *, row_number() over (partition by o_custkey order by o_orderdate desc nulls last, o_orderkey) as r from orders) where r = 1")
def latest_version(t):
    """The version with the greatest lower bound."""
    return X.latest_versions(t.orders, "o_custkey", "o_orderdate", "o_orderkey").select("o_custkey", "o_orderkey", "o_totalprice")


@query("select c_custkey, list_sort(coalesce(list(o_orderkey) filter (o_orderkey is not null), [])) as big_orders from customer left join orders on o_custkey = c_custkey and o_totalprice > 200000 group by 1")
def outer_collect(t):
    """Left join with its condition, collected, never null."""
    right = t.orders.where("o_totalprice > 200000").select("o_custkey", "o_orderkey")
    rows = t.customer.select("c_custkey").join(right, F.col("c_custkey") == F.col("o_custkey"), "left")
    return rows.groupBy("c_custkey").agg(F.array_sort(F.collect_list("o_orderkey")).alias("big_orders"))


@query("select document_id, count(distinct flag_id) as n_flags from (select o_orderkey as document_id, o_custkey as flag_id from orders union all select l_orderkey, l_partkey from lineitem) group by 1")
def union_distinct_flags(t):
    """Distinct flags of a document and of its articles."""
    flags = t.orders.select(F.col("o_orderkey").alias("document_id"), F.col("o_custkey").alias("flag_id"), F.lit(None).cast("long").alias("article_id"))
    flags = flags.unionByName(t.lineitem.select(F.lit(None).cast("long").alias("document_id"), F.col("l_partkey").alias("flag_id"), F.col("l_orderkey").alias("article_id")))
    articles = t.orders.select(F.col("o_orderkey").alias("article_id"), F.col("o_orderkey").alias("document_id"))
    return P.flags_of_documents(flags, articles)


@query("with names as (select distinct left(p_name, ([4, 7, 9])[p_partkey % 3 + 1]) as name from part) select p_partkey, (select max(length(name)) from names where starts_with(lower(p_name), lower(name))) as longest from part")
def prefix_longest(t):
    """The longest name that begins each label."""
    k = F.element_at(F.array(*map(F.lit, (4, 7, 9))), (F.col("p_partkey") % 3 + 1).cast("int"))
    names = t.part.select(F.substring(F.col("p_name"), F.lit(1), k).alias("name")).distinct()
    names = names.withColumn("ident", F.length("name").cast("long"))
    return P.longest_prefix(t.part.select("p_partkey", F.col("p_name").alias("label")), "label", names, "name", "ident").select("p_partkey", F.col("ident").alias("longest"))


@query(
    """with d as (select o_orderkey, o_orderkey::varchar as id, 's' || (o_orderkey % 9000) as slug, 'k' || (o_custkey) as document_key, 'c' || (o_totalprice::int % 5000) as sum from orders),
    n as (select sum, count(*) as c from d group by 1)
    select o_orderkey, case when o_orderkey % 13 = 0 then 'already_pushed' when c = 1 and substr(d.sum, 2)::int % 2 = 0 then 'source_in_target' when (o_orderkey % 9000) % 10 = 0 then 'collision_slug' when substr(document_key, 2)::int % 17 = 0 then 'collision_document_key' else 'push' end as verdict
    from d join n on d.sum = n.sum"""
)
def push_plan(t):
    """Verdict of each candidate."""
    k = F.col("o_orderkey")
    docs = t.orders.select("o_orderkey", k.cast("string").alias("id"), F.concat(F.lit("s"), k % 9000).alias("slug"), F.concat(F.lit("k"), "o_custkey").alias("document_key"), F.lit(None).cast("string").alias("stock_code"), F.lit(None).cast("string").alias("reference_nor"), F.array(F.concat(F.lit("c"), F.bround(F.col("o_totalprice")).cast("int") % 5000)).alias("checksums"))
    row = lambda kind, value, cond: docs.where(cond).select(F.lit(kind).alias("key_kind"), value.alias("key_value"))
    target = row("id", F.col("id"), "o_orderkey % 13 = 0").unionByName(row("slug", F.col("slug"), "(o_orderkey % 9000) % 10 = 0"))
    target = target.unionByName(t.customer.where("c_custkey % 17 = 0").select(F.lit("document_key").alias("key_kind"), F.concat(F.lit("k"), "c_custkey").alias("key_value")))
    sums = t.spark.range(0, 5000, 2).select(F.lit("checksum").alias("key_kind"), F.concat(F.lit("c"), "id").alias("key_value"))
    return P.push_verdicts(docs, target.unionByName(sums)).select("o_orderkey", "verdict")


@query(
    """with p as (select o_orderkey, o_custkey from orders where o_orderkey % 3 = 0 order by o_orderkey limit 500)
    select distinct c_custkey as id, case when c_custkey % 4 = 0 then 'remap' else 'create' end as verdict from p join customer on c_custkey = o_custkey where c_custkey % 5 > 0"""
)
def push_journals(t):
    """Journals that a limited plan still needs."""
    plan = t.orders.select("o_orderkey", F.col("o_custkey").alias("journal_id"), F.when(F.col("o_orderkey") % 3 == 0, "push").otherwise("no").alias("verdict"))
    limited = P.limit_plan(plan, 500, "o_orderkey")
    journals = t.customer.select(F.col("c_custkey").alias("id"), F.col("c_name").alias("publication_date"), F.col("c_custkey").cast("string").alias("number"))
    there = t.customer.where("c_custkey % 5 = 0").select(F.col("c_custkey").alias("id"))
    twins = journals.where("id % 4 = 0").withColumn("id", -F.col("id"))
    return P.journals_needed(limited, journals, there, twins).select("id", "verdict")


@query("select o_orderkey, case when o_orderkey % 7 = 0 then 'missing' end as problem from orders where o_orderkey % 7 = 0 and o_orderkey > 0 union all select -o_orderkey, 'extra' from orders where o_orderkey % 11 = 0 and o_orderkey > 0")
def expected_count(t):
    """Listed and found keys compared."""
    o = t.orders.where("o_orderkey > 0").select("o_orderkey")
    found = o.where("o_orderkey % 7 <> 0").unionByName(o.where("o_orderkey % 11 = 0").select((-F.col("o_orderkey")).alias("o_orderkey")))
    return X.expected_count(found, o, "o_orderkey")


@query("select d.doc_id, coalesce(case when d.doc_id % 3 = 0 then d.doc_id end, b.item_id) as owner, case when d.doc_id % 3 = 0 then 'media' when b.item_id is not null then 'manifest' end as known_from from documents d left join (select sha256(text) as s, min(item_id) as item_id from benchmark group by 1) b on b.s = sha256(d.text) where (select count(*) from documents x where x.text = d.text) = 1")
def known_content(t):
    """Owner of a content by the first source that knows it."""
    d = t.documents.select("doc_id", F.sha2("text", 256).alias("sha"))
    d = d.join(d.groupBy("sha").count().where("count = 1").select("sha"), "sha")
    media = d.where("doc_id % 3 = 0").select("sha", F.col("doc_id").alias("owner"))
    bench = t.benchmark.select(F.sha2("text", 256).alias("sha"), F.col("item_id").alias("owner"))
    return P.known_content(d, "sha", ("media", media), ("manifest", bench)).select("doc_id", "owner", "known_from")


@query(
    """select (select count(*) from orders) as n_docs, (select count(*) filter (o_orderstatus = 'F') from orders) as n_published, (select count(*) filter (o_orderstatus = 'O') from orders) as n_draft,
    (select count(*) filter (o_totalprice > 100000) from orders) as n_large, (select count(*) from lineitem) as n_articles, (select count(*) filter (l_returnflag = 'R') from lineitem) as n_returned, (select count(*) filter (c_acctbal < 0) from customer) as n_negative"""
)
def kpis(t):
    """Conditional counts, one pass a table."""
    o = t.orders.agg(F.count("*").alias("n_docs"), F.count_if(F.col("o_orderstatus") == "F").alias("n_published"), F.count_if(F.col("o_orderstatus") == "O").alias("n_draft"), F.count_if(F.col("o_totalprice") > 100000).alias("n_large"))
    lines = t.lineitem.agg(F.count("*").alias("n_articles"), F.count_if(F.col("l_returnflag") == "R").alias("n_returned"))
    return o.crossJoin(lines).crossJoin(t.customer.agg(F.count_if(F.col("c_acctbal") < 0).alias("n_negative")))


@query("select o_orderkey, count(l_orderkey) as n_articles from orders left join lineitem on l_orderkey = o_orderkey group by 1")
def counts_by_doc(t):
    """Rows of each document, 0 where none."""
    return P.dry_run(t.orders.select("o_orderkey"), {"n_articles": t.lineitem.select(F.col("l_orderkey").alias("o_orderkey"))}, "o_orderkey")


@query("select o_orderstatus, count(*) filter (o_orderkey % 10 > 0) as n_live, count(*) filter (o_orderkey % 10 = 0) as n_deleted, max(o_orderdate) as latest, bool_or(o_totalprice > 300000) as any_large from orders group by 1")
def status_filter_counts(t):
    """Filtered counts, latest run, any."""
    dead = F.col("o_orderkey") % 10 == 0
    return t.orders.groupBy("o_orderstatus").agg(F.count_if(~dead).alias("n_live"), F.count_if(dead).alias("n_deleted"), F.max("o_orderdate").alias("latest"), F.bool_or(F.col("o_totalprice") > 300000).alias("any_large"))


@query("select l_orderkey, count(*) filter (l_linestatus = 'O' and l_returnflag = 'R') as blocking, count(*) filter (l_linestatus = 'O' and l_returnflag <> 'R') as warning from lineitem group by 1")
def flags_by_severity(t):
    """Unresolved flags of each document by severity."""
    live = F.col("l_linestatus") == "O"
    return t.lineitem.groupBy("l_orderkey").agg(F.count_if(live & (F.col("l_returnflag") == "R")).alias("blocking"), F.count_if(live & (F.col("l_returnflag") != "R")).alias("warning"))


@query("select coalesce(sha, 'key:' || o_orderkey) as file, count(*) as n_rows from (select o_orderkey, case when o_orderkey % 4 > 0 then sha256((o_orderkey % 100)::varchar) end as sha from orders) group by 1")
def measure_once(t):
    """Rows of each distinct file."""
    k = F.col("o_orderkey")
    sha = F.when(k % 4 > 0, F.sha2((k % 100).cast("string"), 256))
    return t.orders.select(F.coalesce(sha, F.concat(F.lit("key:"), k)).alias("file")).groupBy("file").agg(F.count("*").alias("n_rows"))


@query("select conv_id, sha256(string_agg(role || '␟' || coalesce(text, ''), '␞' order by turn)) as content_hash, count(*) as n_articles from conversations group by 1")
def content_hash(t):
    """Ordered hash of a document's articles."""
    return D.content_hash(t.conversations, "conv_id", "role", "text", "turn").select("conv_id", "content_hash", "n_articles")


@query("select source, lang, bucket, doc_id, n_in_cluster from (select source, lang, length(text) % 50 as bucket, doc_id, count(*) over (partition by source, lang, length(text) % 50) as n_in_cluster from documents) where n_in_cluster > 1")
def dup_clusters(t):
    """Documents that share an administrative identity."""
    rows = t.documents.select("source", "lang", (F.length("text") % 50).alias("bucket"), "doc_id")
    return D.clusters(rows, "source", "lang", "bucket")


@query(
    """with w as (select source, lang, length(text) % 50 as bucket, doc_id, list_distinct(string_split(text, ' ')) as w from documents)
    select a.source, a.lang, a.bucket, count(*) as n_pairs, round(min(len(list_intersect(a.w, b.w))::double / len(list_distinct(list_concat(a.w, b.w)))), 6) as min_jaccard from w a join w b on a.source = b.source and a.lang = b.lang and a.bucket = b.bucket and a.doc_id < b.doc_id group by 1, 2, 3"""
)
def cluster_jaccard(t):
    """Least Jaccard of the pairs of a cluster, over all words of the texts."""
    return _cluster_jaccard(t, F.col("text"))


def _cluster_jaccard(t, text):
    rows = t.documents.select("source", "lang", (F.length("text") % 50).alias("bucket"), "doc_id", text.alias("words"))
    keys = ["source", "lang", "bucket"]
    least = least_jaccard(rows, keys, "doc_id", "words", " ")
    return D.pair_counts(rows, "doc_id", *keys).join(least, keys).select(*keys, "n_pairs", F.round("least", 6).alias("min_jaccard"))


@query()
def cluster_assessment(t):
    """Tier, warnings and the document to keep of each cluster."""
    k = F.col("doc_id")
    rows = t.documents.select(
        "source", "lang", (F.length("text") % 50).alias("bucket"), "doc_id", F.sha2("text", 256).alias("content_hash"), F.col("text").alias("numbers"), F.size(F.split("text", "\n")).cast("long").alias("n_articles"),
        F.col("text").alias("sample"), F.when(k % 3 == 0, k).alias("journal_id"), F.when(k % 5 == 0, "STOCK").otherwise("FLUX").alias("role"), F.when(k % 7 == 0, "published").otherwise("draft").alias("status"), (k % 4).alias("flags_blocking"), F.timestamp_seconds(k).alias("created_at"),
    )
    return D.assess(D.clusters(rows, "source", "lang", "bucket").drop("n_in_cluster"), "doc_id", ["source", "lang", "bucket"], " ")


@query("select o_orderkey, o_orderdate, (select count(*) from orders where o_orderstatus = 'F') as total, (select ceil(count(*) / 50.0)::bigint from orders where o_orderstatus = 'F') as pages from orders where o_orderstatus = 'F' order by o_orderdate desc, o_orderkey limit 50 offset 100")
def pagination(t):
    """The third page of a list."""
    rows = t.orders.where("o_orderstatus = 'F'").select("o_orderkey", "o_orderdate")
    return P.page_of(rows, 3, 50, F.desc("o_orderdate"), F.asc("o_orderkey"))


@query("select doc_id, lang from documents where lower(text) like '%moron%' or lower(source) like '%src7%'")
def search_documents(t):
    """Case-insensitive search in several columns."""
    q = lambda c, x: F.col(c).ilike(f"%{x}%")
    return t.documents.where(q("text", "moron") | q("source", "src7")).select("doc_id", "lang")


# M: diffs and merges ------------------------------------------------------------------------------------------------------


@query(
    """with n as (select l_orderkey, l_linenumber, l_partkey from lineitem where l_partkey % 4 > 0), o as (select l_orderkey, l_linenumber, l_partkey + case when l_suppkey % 5 = 0 then 1 else 0 end as l_partkey from lineitem where l_partkey % 7 > 0),
    a as (select l_orderkey || '-' || l_linenumber as k, list(l_partkey order by l_partkey) as x from n group by 1), b as (select l_orderkey || '-' || l_linenumber as k, list(l_partkey order by l_partkey) as x from o group by 1)
    select coalesce(a.k, b.k) as k, case when b.x is null then 'added' when a.x is null then 'removed' when a.x = b.x then 'unchanged' else 'changed' end as status, coalesce(len(a.x), 0) as n_new, coalesce(len(b.x), 0) as n_old from a full join b on a.k = b.k"""
)
def content_diff(t):
    """Proposed and live articles compared by number."""
    l = t.lineitem.select(F.concat_ws("-", "l_orderkey", "l_linenumber").alias("k"), "l_partkey", "l_suppkey")  # noqa: E741
    new = l.where("l_partkey % 4 > 0").select("k", F.col("l_partkey").alias("o"), F.col("l_partkey").cast("string").alias("c"))
    changed = F.col("l_partkey") + F.when(F.col("l_suppkey") % 5 == 0, 1).otherwise(0)
    old = l.where("l_partkey % 7 > 0").select("k", changed.alias("o"), changed.cast("string").alias("c"))
    return X.content_diff(new, old, "k", "c", "o")


@query(
    """with e as (select n_name as table_name, 'c' || k as column_name, n_nationkey % 2 = 0 as nullable from nation, (values (1), (2)) v(k)), a as (select n_name as table_name, 'c' || k as column_name, n_nationkey % 3 = 0 as nullable from nation, (values (1), (2)) v(k) where n_nationkey % 5 > 0 and not (k = 2 and n_nationkey % 4 = 0)),
    u as (select distinct table_name, null as column_name, 'missing_table' as kind, 0 as r from e where table_name not in (select table_name from a)
     union all select e.table_name, e.column_name, 'missing_column', 1 from e where table_name in (select table_name from a) and not exists (select 1 from a where a.table_name = e.table_name and a.column_name = e.column_name)
     union all select e.table_name, e.column_name, 'nullability', 2 from e join a using (table_name, column_name) where e.nullable <> a.nullable) select table_name, column_name, kind from u order by r, table_name, column_name limit 20"""
)
def schema_drift(t):
    """What a schema lacks, what endangers writes first (a report of 20 rows)."""
    both = t.nation.withColumn("k", F.explode(F.array(F.lit(1), F.lit(2))))
    row = lambda nullable: [F.col("n_name").alias("table_name"), F.concat(F.lit("c"), "k").alias("column_name"), nullable.alias("nullable")]
    expected = both.select(*row(F.col("n_nationkey") % 2 == 0))
    actual = both.where("n_nationkey % 5 > 0 and not (k = 2 and n_nationkey % 4 = 0)").select(*row(F.col("n_nationkey") % 3 == 0))
    return X.schema_drift(expected, actual).select("table_name", "column_name", "kind")


@query("select distinct l_orderkey, l_suppkey from lineitem where l_orderkey not in (select o_orderkey from orders where o_orderkey % 2 = 0)")
def upsert_new(t):
    """Rows that an insert without conflict adds."""
    target = t.orders.where("o_orderkey % 2 = 0").select(F.col("o_orderkey").alias("l_orderkey"))
    rows = t.lineitem.select("l_orderkey", "l_suppkey").distinct()
    return rows.join(target, "l_orderkey", "left_anti")


@query("select o_orderkey, case when o_orderkey % 6 = 0 then timestamp '2020-01-01' when o_orderkey % 2 = 0 then timestamp '2021-01-01' end as deleted_at, coalesce(case when o_orderkey % 3 = 0 then null else o_orderpriority end, 'TEXTE') as type_code from orders")
def soft_delete(t):
    """Soft delete with a shared time, null codes filled."""
    at = F.lit("2021-01-01").cast("timestamp")
    rows = t.orders.select("o_orderkey", F.when(F.col("o_orderkey") % 6 == 0, F.lit("2020-01-01").cast("timestamp")).alias("deleted_at"), F.when(F.col("o_orderkey") % 3 > 0, F.col("o_orderpriority")).alias("type_code"))
    rows = X.soft_delete(rows, F.col("o_orderkey") % 2 == 0, at)
    rows = X.restore(X.soft_delete(rows, F.col("o_orderkey") % 5 == 0, F.lit("2022-01-01").cast("timestamp")), F.lit(True), F.lit("2022-01-01").cast("timestamp"))
    return X.fill_null(rows, "type_code", F.lit("TEXTE"))


@query("select c_custkey, 'b' as a, c_name as n, 'x' as z from customer")
def merge_metadata(t):
    """Shallow merge, the right side wins."""
    m = X.merge_maps(F.create_map(F.lit("a"), F.lit("a"), F.lit("n"), F.col("c_name")), F.create_map(F.lit("a"), F.lit("b"), F.lit("z"), F.lit("x")))
    return t.customer.select("c_custkey", m["a"].alias("a"), m["n"].alias("n"), m["z"].alias("z"))


@query("select o_custkey, o_orderkey, o_orderdate as valid_from, lead(o_orderdate) over (partition by o_custkey order by o_orderdate) as valid_to from (select * from orders o where o_orderkey = (select min(o_orderkey) from orders x where x.o_custkey = o.o_custkey and x.o_orderdate = o.o_orderdate))")
def timelines(t):
    """Version intervals of an article."""
    one = t.orders.groupBy("o_custkey", "o_orderdate").agg(F.min("o_orderkey").alias("o_orderkey"))
    rows = one.select("o_custkey", F.col("o_orderdate").alias("valid_from"), "o_orderkey")
    return X.timelines(rows.where("o_orderkey % 2 = 0"), rows.where("o_orderkey % 2 = 1"), "o_custkey", "valid_from", "o_orderkey").select("o_custkey", "o_orderkey", "valid_from", "valid_to")


@query("select p_partkey, 1 as n_changes, '<>' || substr(p_name, 4) as text from part")
def word_changes(t):
    """Where two readings differ, and official replacements applied."""
    c = F.col("p_name")
    rows = t.part.select("p_partkey", c, F.concat(F.lit("new "), c).alias("other"), F.array(F.struct(F.substring(c, 1, 3).alias("old"), F.lit("<>").alias("new"))).alias("todo"))
    return rows.select("p_partkey", F.size(X.word_changes("p_name", "other")).alias("n_changes"), X.apply_replacements("p_name", "todo")["text"].alias("text"))


# N: jobs ----------------------------------------------------------------------------------------------------------------

_EVENT_SQL = "(select user_id as job_id, event_id as seq, case event_type when 'purchase' then 'done' when 'click' then 'reserve' when 'view' then 'renew' else 'fail' end as event_kind, event_id // 50 - case when event_id % 4 = 0 then 3 else 0 end as token from events)"


def _events(t):
    kind = F.when(F.col("event_type") == "purchase", "done").when(F.col("event_type") == "click", "reserve").when(F.col("event_type") == "view", "renew").otherwise("fail")
    token = F.floor(F.col("event_id") / 50) - F.when(F.col("event_id") % 4 == 0, 3).otherwise(0)
    return t.events.select(F.col("user_id").alias("job_id"), F.col("event_id").alias("seq"), kind.alias("event_kind"), token.alias("token"))


@query(
    f"""with e as (select *, coalesce(token >= max(token) over (partition by job_id order by seq rows between unbounded preceding and 1 preceding), true) as ok from {_EVENT_SQL})
    select job_id, arg_max(case event_kind when 'reserve' then 'running' when 'done' then 'done' when 'fail' then 'failed' else 'pending' end, seq) filter (ok) as status, count(*) filter (ok and event_kind = 'reserve') as attempts, max(token) filter (ok) as token, count(*) as n_events, count(*) filter (not ok) as n_rejected from e group by 1"""
)
def job_fold(t):
    """State of each job after its events; events with an old token are rejected."""
    return J.fold(_events(t), "job_id", "seq").withColumns({"attempts": F.col("attempts").cast("long"), "n_rejected": F.col("n_rejected").cast("long")})


_JOB_SQL = "(select o_orderkey as id, o_orderpriority as kind, case when o_orderstatus = 'F' then 'failed' when o_orderstatus = 'P' then 'running' else 'pending' end as status, o_orderdate as created_at, o_orderdate + (o_orderkey % 60) * interval 1 minute as locked_at from orders)"


def _jobs(t):
    status = F.when(F.col("o_orderstatus") == "F", "failed").when(F.col("o_orderstatus") == "P", "running").otherwise("pending")
    locked = F.col("o_orderdate") + F.make_dt_interval(mins=(F.col("o_orderkey") % 60).cast("int"))
    return t.orders.select(F.col("o_orderkey").alias("id"), F.col("o_orderpriority").alias("kind"), status.alias("status"), F.col("o_orderdate").alias("created_at"), locked.alias("locked_at"))


@query(f"select id, kind, row_number() over (partition by kind order by created_at, id) as turn from {_JOB_SQL} where status = 'pending' or (status = 'running' and locked_at < timestamp '1996-06-01' - interval 30 minute)")
def reserve_order(t):
    """Eligible jobs in the order in which they are reserved."""
    now = F.lit("1996-06-01").cast("timestamp")
    return J.eligible(_jobs(t), now).select("id", "kind", "turn")


@query("select event_id, case when event_type = 'click' and event_id % 5 < 3 then 'pending' else 'failed' end as status, case when event_id % 4 = 0 then 'parse' when event_id % 4 = 1 then 'structure' else 'termine' end as next_step from events")
def job_transitions(t):
    """Status after a failure and the next step."""
    k = F.col("event_id")
    cls = F.when(F.col("event_type") == "click", "transitoire").otherwise("definitive")
    step = F.element_at(F.array(*map(F.lit, J.STEPS)), (k % 4 + 1).cast("int"))
    return t.events.select("event_id", J.failed(cls, k % 5, F.lit(3)).alias("status"), J.next_step(step).alias("next_step"))


@query(
    """with j as (select o_custkey % 800 as manifest_id, o_orderkey, case when o_orderstatus = 'O' and o_orderkey % 5 = 0 then 'pending' when o_orderstatus = 'P' then 'running' when o_orderkey % 3 = 0 then 'failed' else 'done' end as status, o_orderkey % 2 as sha from orders),
    l as (select manifest_id, arg_max(status, o_orderkey) as status, arg_max(sha, o_orderkey) as sha from j group by 1)
    select c_custkey as id from customer left join l on l.manifest_id = c_custkey where c_custkey % 4 > 0 and not exists (select 1 from j where j.manifest_id = c_custkey and status in ('pending', 'running')) and not coalesce(l.status = 'failed' and l.sha = c_custkey % 2, false)"""
)
def watch_enqueue(t):
    """Entries to queue."""
    k = F.col("o_orderkey")
    status = F.when((F.col("o_orderstatus") == "O") & (k % 5 == 0), "pending").when(F.col("o_orderstatus") == "P", "running").when(k % 3 == 0, "failed").otherwise("done")
    jobs = t.orders.select((F.col("o_custkey") % 800).alias("manifest_id"), k.alias("created_at"), status.alias("status"), F.lit("definitive").alias("error_class"), (k % 2).alias("sha256"))
    entries = t.customer.select(F.col("c_custkey").alias("id"), F.when(F.col("c_custkey") % 4 > 0, "telecharge").otherwise("structure").alias("statut"), (F.col("c_custkey") % 2).alias("sha256"))
    return J.enqueue(entries, jobs).select("id")


@query("select o_orderkey, case when o_orderkey % 2 = 0 and o_orderkey % 3 = 0 then 'completed' when o_orderkey % 2 = 0 or o_orderkey % 3 = 0 then 'partial' else 'pending' end as rollup from orders")
def status_rollup(t):
    """Status of a document by its artefacts."""
    k = F.col("o_orderkey")
    return t.orders.select("o_orderkey", J.rollup(k % 2 == 0, k % 3 == 0).alias("rollup"))
