"""Planning what to fetch: listings of decisions, series of issues, single texts, and compilations read as layout."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.classify import boundary_code, heading_line

#: An entry of a listing, the number that ends its title, the date in its slug, and the link to the next page.
ENTRY = r'<a\s+class="a-unstyled"\s+href="(/arret/[^"]+)">([^<]+)</a>'
NUMBER, SLUG_DATE, NEXT = r"(\d+/\d{4})\s*$", r"-(\d{4})(\d{2})(\d{2})-", r'<a href="([^"]+)">\s*Suivant'
#: The longest title of an act in a compilation.
TITLE_LENGTH = 90


def _absolute(href: Column, base: str) -> Column:
    return F.when(href.startswith("http"), href).otherwise(F.concat(F.lit(base), href))


def listing(pages: DataFrame, key: str, html: str, base: str) -> DataFrame:
    """Decisions that a page of results lists, in order: pos, slug, url, title, number, date (each null where it isn't named)."""
    hrefs, titles = (F.regexp_extract_all(F.col(html), F.lit(ENTRY), k) for k in (1, 2))
    rows = pages.select(key, F.posexplode(F.arrays_zip(hrefs.alias("href"), titles.alias("title"))).alias("pos", "x"))
    title = F.trim(F.regexp_replace(F.col("x.title"), r"(?U)\s+", " "))
    slug = F.regexp_replace(F.col("x.href"), r"^/arret/", "")
    number, year = F.regexp_extract(title, NUMBER, 1), F.regexp_extract(slug, SLUG_DATE, 1)
    date = F.concat_ws("-", year, F.regexp_extract(slug, SLUG_DATE, 2), F.regexp_extract(slug, SLUG_DATE, 3))
    return rows.select(key, "pos", slug.alias("slug"), _absolute(F.col("x.href"), base).alias("url"), title.alias("title"), F.nullif(number, F.lit("")).alias("number"), F.when(year != "", date).alias("date"))


def next_page(html: Column, base: str) -> Column:
    """Address of the next page of a listing; null on the last."""
    href = F.replace(F.regexp_extract(html, NEXT, 1), F.lit("&amp;"), F.lit("&"))
    return F.when(href != "", _absolute(href, base))


def file_name(url: Column, fallback: Column) -> Column:
    """Name of the file behind an address: its last part without a query, or the fallback where that says nothing."""
    last = F.element_at(F.split(F.element_at(F.split(url, r"\?"), 1), "/"), -1)
    return F.when(last.rlike(r"\.[A-Za-z0-9]{1,5}$"), last).otherwise(fallback)


def series_plan(index: DataFrame, autoindex: DataFrame, enumerated: DataFrame, years: list[int]) -> DataFrame:
    """Addresses of a series for the years asked: those of the index page, then of the folder listing, and enumerated ones only
    for years that neither knows.  Each address once, from the first source that names it."""
    ranked = index.select("year", "url", F.lit(0).alias("rank")).unionByName(autoindex.select("year", "url", F.lit(1).alias("rank")))
    known = ranked.where(F.col("year").isin(*years))
    rest = enumerated.where(F.col("year").isin(*years)).join(known.select("year").distinct(), "year", "left_anti").select("year", "url", F.lit(2).alias("rank"))
    every = known.unionByName(rest)
    first = every.groupBy("url").agg(F.min_by(F.struct("year", "rank"), F.struct("rank", "year")).alias("x"))
    names = F.element_at(F.array(*map(F.lit, ["index", "autoindex", "enumeration"])), F.col("x.rank") + 1)
    return first.select("url", F.col("x.year").alias("year"), names.alias("source"))


def layout_boundaries(pages: DataFrame, key: str, subjects: list[tuple[str, str]], code: str = "AU", opening: str = "ACTE UNIFORME") -> DataFrame:
    """Suggested starts of acts in a compilation by its layout: short title blocks that open an act or name a subject.

    pages: (key, page_idx, preproc_blocks).  subjects: (pattern, canonical title), tried in order.  Returns start_page (from 1), title,
    suggested, type_code; a suggestion is given once a page.
    """
    blocks = pages.where(F.col("page_idx").isNotNull()).select(key, (F.col("page_idx") + 1).alias("start_page"), F.posexplode("preproc_blocks").alias("pos", "b")).where("b.type = 'title'")
    line = lambda l: F.array_join(F.filter(F.transform(l["spans"], lambda s: F.trim(s["content"])), lambda x: x != ""), " ")  # noqa: E731, E741
    title = F.trim(F.array_join(F.filter(F.transform("b.lines", line), lambda x: x != ""), " "))
    rows = blocks.select(key, "start_page", "pos", title.alias("title")).where((F.length("title") > 0) & (F.length("title") <= TITLE_LENGTH))
    named = F.coalesce(*[F.when(F.col("title").rlike("(?iu)" + p), F.lit(v)) for p, v in subjects], F.lit(None).cast("string"))
    own = boundary_code(heading_line(F.col("title")))
    opens = F.upper("title").startswith(opening)
    rows = rows.withColumns({"suggested": F.when(opens, F.col("title")).otherwise(F.coalesce(named, F.when(own.isNotNull(), F.col("title")))), "type_code": F.when(opens | named.isNotNull(), F.lit(code)).otherwise(own)})
    first = Window.partitionBy(key, "start_page", "suggested").orderBy("pos")
    return rows.where(F.col("suggested").isNotNull()).withColumn("__r", F.row_number().over(first)).where("__r = 1").drop("__r", "pos")


def page_slices(pages: DataFrame, marks: DataFrame, key: str) -> DataFrame:
    """Pages of each act of a compilation: from its start page up to the page before the next act's start.

    Adds page_start, page_end (null for the last act) to the pages (key, page_idx, ...) that stand in an act; where several acts
    start on one page, the last of them holds it.
    """
    starts = marks.select(key, F.col("start_page").alias("page_start")).distinct()
    after = starts.withColumn("page_end", F.lead("page_start").over(Window.partitionBy(key).orderBy("page_start")) - 1)
    rows = pages.withColumn("page", F.col("page_idx") + 1)
    marked = rows.join(starts.withColumn("page", F.col("page_start")), [key, "page"], "left")
    running = Window.partitionBy(key).orderBy("page").rowsBetween(Window.unboundedPreceding, 0)
    marked = marked.withColumn("page_start", F.last("page_start", ignorenulls=True).over(running)).where("page_start is not null")
    return marked.join(after, [key, "page_start"])


def page_range(pages: DataFrame, key: str, first: int, last: int) -> DataFrame:
    """Pages first to last (from 1, both included); bounds beyond the document are cut back, an empty range gives nothing."""
    n = F.max("page").over(Window.partitionBy(key))
    return pages.withColumn("__n", n).where(F.col("page").between(F.lit(max(first, 1)), F.least(F.lit(last), F.col("__n")))).drop("__n")


def merge_folder(chunks: DataFrame, key: str, name: str, content: str) -> DataFrame:
    """Chunk files (``chunk_<a>_...``) of a folder put together in the order of their first page."""
    start = F.regexp_extract(name, r"chunk_(\d+)_", 1).try_cast("int")
    rows = chunks.withColumn("__a", start).groupBy(key).agg(F.array_sort(F.collect_list(F.struct("__a", name, content))).alias("l"))
    return rows.select(key, F.array_join(F.transform("l", lambda x: x[content]), "\n").alias(content), F.size("l").alias("n_chunks"))
