"""Operators on the lines and pages of texts: page carry, coverage, furniture, contents, boundaries, alignment."""

from __future__ import annotations

import re
from bisect import bisect_left

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.clean import PAGE_MARK, bare_line, match_line, strip_space
from ..functions.classify import boundary_code, heading_line, is_heading
from ..functions.quality import SINGLE_LETTERS


def lines_of(docs: DataFrame, key: str, text: str) -> DataFrame:
    """(key, line_no from 0, line)."""
    return docs.select(key, F.posexplode(F.split(F.coalesce(F.col(text), F.lit("")), "\n")).alias("line_no", "line"))


def with_page(lines: DataFrame, key: str) -> DataFrame:
    """Running page of each line, from the marker lines; null before the first."""
    mark = F.regexp_extract(F.trim("line"), PAGE_MARK, 1)
    w = Window.partitionBy(key).orderBy("line_no").rowsBetween(Window.unboundedPreceding, 0)
    own = F.when(mark != "", mark.cast("int"))
    return lines.withColumn("is_mark", mark != "").withColumn("page", F.last(own, ignorenulls=True).over(w)).withColumn("mark_no", F.sum((mark != "").cast("int")).over(w))


def page_texts(docs: DataFrame, key: str, text: str) -> DataFrame:
    """Text of each page; text before the first marker is left out, and of a repeated page the last one counts."""
    rows = with_page(lines_of(docs, key, text), key).where(F.col("page").isNotNull())
    last = rows.groupBy(key, "page").agg(F.max("mark_no").alias("mark_no"))
    body = rows.where(~F.col("is_mark")).groupBy(key, "page", "mark_no").agg(F.array_sort(F.collect_list(F.struct("line_no", "line"))).alias("l"))
    out = last.join(body, [key, "page", "mark_no"], "left")
    return out.select(key, "page", strip_space(F.coalesce(F.array_join(F.transform("l", lambda x: x["line"]), "\n"), F.lit(""))).alias("content"))


def page_gaps(pages: DataFrame, key: str, least: int = 20) -> DataFrame:
    """Pages between the first and the last of a document with less than ``least`` characters; absent ones count."""
    span = pages.groupBy(key).agg(F.min("page").alias("a"), F.max("page").alias("b")).select(key, F.explode(F.sequence("a", "b")).alias("page"))
    have = pages.select(key, "page", F.length("content").alias("n"))
    return span.join(have, [key, "page"], "left").where(F.coalesce("n", F.lit(0)) < least).select(key, "page")


def first_and_rest(df: DataFrame, key: str, value: str, n: int = 10) -> DataFrame:
    """The first n values of each key, and how many there are."""
    return df.groupBy(key).agg(F.array_sort(F.collect_list(value)).alias("v")).select(key, F.slice("v", 1, n).alias("first"), F.size("v").alias("n"))


def structure_gaps(pages: DataFrame, ranges: DataFrame, key: str, least: int = 20) -> DataFrame:
    """Pages with text that no leaf range (page, page_end) covers."""
    covered = ranges.where("page is not null").select(key, F.explode(F.sequence("page", F.greatest(F.coalesce("page_end", "page"), F.col("page")))).alias("page")).distinct()
    return pages.where(F.length("content") >= least).join(covered, [key, "page"], "left_anti").select(key, "page")


def carry_pages(acts: DataFrame, key: str, order: str, own_min: str, own_max: str) -> DataFrame:
    """Start page of each act: its own first page, else the last page that an act before it reached."""
    w = Window.partitionBy(key).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    return acts.withColumn("page_start", F.coalesce(own_min, F.last(own_max, ignorenulls=True).over(w), F.lit(1)))


def rebase(page: Column, offset: Column) -> Column:
    return F.greatest(F.lit(1), page - offset)


def render_pages(pages: DataFrame, key: str, prefix: str = "DOC") -> DataFrame:
    """One text per document, a marker line before each page."""
    mark = lambda x: F.concat(F.lit(f"[[{prefix}_PAGE:"), x["page"].cast("string"), F.lit("]]\n"), x["content"])
    rows = pages.groupBy(key).agg(F.array_sort(F.collect_list(F.struct("page", "content"))).alias("p"))
    return rows.select(key, F.array_join(F.transform("p", mark), "\n").alias("text"))


def degraded_pages(pages: DataFrame, key: str, content: str = "content", least_words: int = 50, most: float = 0.035) -> DataFrame:
    """Pages with enough words of which too many are single letters."""
    singles = "".join(SINGLE_LETTERS + [x.upper() for x in SINGLE_LETTERS])
    out = pages.withColumns({"n_words": F.regexp_count(content, F.lit(r"\p{L}+")), "n_single": F.regexp_count(content, F.lit(rf"(?<!\p{{L}})(?![{singles}])\p{{L}}(?!\p{{L}})"))})
    return out.where((F.col("n_words") >= least_words) & (F.col("n_single") > most * F.col("n_words")))


def triage(pages: DataFrame, scores: DataFrame, key: str, chars: int = 300, threshold: float = 0.60, most_pages: int = 2) -> DataFrame:
    """native or ocr, and why: the first rule that holds."""
    per = pages.groupBy(key).agg(F.count("*").alias("n_pages"), F.sum(F.length("content")).alias("n_chars"))
    bad = degraded_pages(pages, key).groupBy(key).agg(F.count("*").alias("n_bad"))
    rows = per.join(scores.select(key, "score"), key, "left").join(bad, key, "left").withColumn("n_bad", F.coalesce("n_bad", F.lit(0)))
    reason = F.when(F.col("n_chars") < chars * F.col("n_pages"), "few_chars").when(F.col("score") < threshold, "low_score").when(F.col("n_bad") >= most_pages, "degraded_pages").otherwise("native")
    return rows.withColumn("reason", reason).withColumn("route", F.when(F.col("reason") == "native", "native").otherwise("ocr"))


#: The running head of a gazette, and the furniture that may stand next to it.
_DAYS = "lundi|mardi|mercredi|jeudi|vendredi|samedi|dimanche"
_MONTHS = "janvier|f[ée]vrier|mars|avril|mai|juin|juillet|ao[ûu]t|septembre|octobre|novembre|d[ée]cembre"
RUNNING_HEAD = r"(?iu)^Journal\s+off\s*[iﬁ]{0,2}\s*ciel\s+de\s+la\s+R[ée]publique\s+du\s+Congo\s*[.,]?$"
FURNITURE = [
    r"^\d{1,5}$",
    r"(?iu)^N\s*[°ºo0]\s*\d+\s*[-–—]\s*\d{4}\s*[.,]?$",
    r"(?iu)^[ÉE]dition\s+sp[ée]ciale\s+N\s*[°ºo0]?\s*\d+.*$",
    r"(?iu)^\d{1,3}\s*(?:e|[èe]me)\s+ANN[EÉ]E\b.*$",
    r"(?iu)^VOLUME\s+[IVXLCDM]+\s*$",
    r"(?iu)^Hors\s+texte\s*$",
    rf"^Du\s+(?iu:{_DAYS})\s+\d{{1,2}}\s*(?iu:er)?\s+(?iu:{_MONTHS})\s+\d{{4}}\s*[.,]?$",
    rf"^Du\s+\d{{1,2}}\s*(?iu:er)?\s+au\s+\d{{1,2}}\s+(?iu:{_MONTHS})\s+\d{{4}}\s*[.,]?$",
    rf"^Du\s+\d{{1,2}}\s*(?iu:er)?\s+(?iu:{_MONTHS})\s+\d{{4}}\s*[.,]?$",
    rf"^D[e’'`]\s*(?iu:{_MONTHS})\s+\d{{4}}\s*[.,]?$",
]
AWAITING = r"(?iu)(?:publi[ée]s?|ins[ée]r[ée]s?|enregistr[ée]s?|communiqu[ée]s?|transmis(?:es?)?|paru[es]?|reproduit[es]?)\s+(?:au|aux)\s*$"


def furniture(lines: DataFrame, key: str, head: str = RUNNING_HEAD, kinds: list[str] | None = None) -> DataFrame:
    """Adds ``is_furniture``: running heads, and furniture in one unbroken stretch with one.

    Blank lines and page markers neither belong to a stretch nor break it.  A running head that completes an unfinished
    sentence is text.
    """
    t = strip_space(F.col("line"))
    up = Window.partitionBy(key).orderBy("line_no")
    before = F.last(F.when(t != "", t), ignorenulls=True).over(up.rowsBetween(Window.unboundedPreceding, -1))
    is_head = t.rlike(head) & ~F.coalesce(before.rlike(AWAITING), F.lit(False))
    kind = F.lit(False)
    for p in kinds or FURNITURE:
        kind = kind | t.rlike(p)
    clear = (t == "") | t.rlike(PAGE_MARK)
    rows = lines.withColumns({"__head": is_head, "__part": (is_head | kind) & ~clear, "__clear": clear})
    breaks = F.sum((~F.col("__part") & ~F.col("__clear")).cast("int")).over(up.rowsBetween(Window.unboundedPreceding, 0))
    rows = rows.withColumn("__run", breaks)
    anchored = F.max(F.col("__head")).over(Window.partitionBy(key, "__run"))
    return rows.withColumn("is_furniture", F.col("__part") & anchored).drop("__head", "__part", "__clear", "__run")


def join_lines(lines: DataFrame, key: str, keep: Column) -> DataFrame:
    rows = lines.groupBy(key).agg(F.array_sort(F.collect_list(F.when(keep, F.struct("line_no", "line")))).alias("l"))
    return rows.select(key, F.array_join(F.transform("l", lambda x: x["line"]), "\n").alias("text"))


ARTICLE_LINE = r"(?iu)^\.?\s*(?:ARTICLE|ART)S?\.?\s*(?:[:.\-–—]\s*)?(?:PREMIER|\d+)"
CONTENTS = r"(?iuU)^(?:SOMMAIRE|TABLE\s+DES\s+MATI[ÈE]RES)\b"
RESUMES = r"(?iuU)^(?:LE\s+CONSEIL\b|L['’]ASSEMBL[ÉE]E\b|LE\s+PR[ÉE]SIDENT\b|VU\b|APR[ÈE]S\s+EN\s+AVOIR\b|(?:ARTICLE|ART)\.?\s+(?:PREMIER|1(?:ER)?|\d+)\b)"
ENTRY = r"^\s*\||\.{2,}\s*\d+\s*$"


def contents_cut(lines: DataFrame, key: str) -> DataFrame:
    """Bounds of tables of contents: lead_start, lead_end (lines to drop, half open) and tail_start (drop from there)."""
    b = bare_line(F.col("line"))
    rows = lines.withColumns({"toc": b.rlike(CONTENTS), "art": b.rlike(ARTICLE_LINE), "resume": b.rlike(RESUMES)})
    at = F.col("line_no")
    first = rows.groupBy(key).agg(F.min(F.when(F.col("art"), at)).alias("first_art"), F.min(F.when(F.col("toc"), at)).alias("first_toc"))
    rows = rows.join(first, key)
    lead = F.when(F.col("first_art").isNull() | (F.col("first_toc") < F.col("first_art")), F.col("first_toc"))
    rows = rows.withColumn("lead", lead)
    marks = rows.groupBy(key).agg(
        F.first("lead").alias("lead_start"),
        F.min(F.when(F.col("resume") & (at > F.col("lead")), at)).alias("lead_end"),
        F.max(F.when(F.col("toc") & (at > F.col("first_art")), at)).alias("tail"),
    )
    tail = rows.select(key, "line_no", "line").join(marks.select(key, "tail"), key).where((at > F.col("tail")) & (strip_space(F.col("line")) != ""))
    share = tail.groupBy(key).agg(F.avg(F.col("line").rlike(ENTRY).cast("double")).alias("share"))
    out = marks.join(share, key, "left")
    both = F.col("lead_end").isNotNull()
    return out.select(key, F.when(both, F.col("lead_start")).alias("lead_start"), "lead_end", F.when(F.col("share") >= 0.5, F.col("tail")).alias("tail_start"))


def boundaries(docs: DataFrame, key: str, text: str, longest: int = 400) -> DataFrame:
    """Suggested starts of acts in a compilation: start_line from 1, title, suggested (80 characters), type_code."""
    rows = docs.select(key, F.posexplode(F.split(F.col(text), r"\R")).alias("i", "line"))
    clean = heading_line(F.col("line"))
    rows = rows.withColumns({"title": clean, "type_code": boundary_code(clean)})
    good = is_heading(F.col("line")) & (F.length("title") > 0) & (F.length("title") <= longest) & F.col("type_code").isNotNull()
    return rows.where(good).select(key, (F.col("i") + 1).alias("start_line"), "title", F.substring("title", 1, 80).alias("suggested"), "type_code")


def slices(lines: DataFrame, marks: DataFrame, key: str, at: str = "start_line") -> DataFrame:
    """Half-open segments from each mark to the next; lines before the first are dropped.  Needs line numbers from 1.

    Marks stand among the lines, and a line belongs to the last mark up to it: one window, no join.
    """
    numbered = marks.select(key, F.col(at).cast("long").alias("line_no"), F.lit(None).cast("string").alias("line"), F.row_number().over(Window.partitionBy(key).orderBy(at)).alias("__mark"))
    both = lines.select(key, F.col("line_no").cast("long").alias("line_no"), "line", F.lit(None).cast("int").alias("__mark")).unionByName(numbered)
    running = Window.partitionBy(key).orderBy("line_no", F.col("__mark").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, 0)
    last = lambda c: F.last(F.when(F.col("__mark").isNotNull(), F.col(c)), ignorenulls=True).over(running)
    inside = both.withColumns({"segment": last("__mark"), "__at": last("line_no")}).where("__mark is null and segment is not null")
    rows = inside.groupBy(key, "segment").agg(F.min("__at").alias("line_start"), F.max("line_no").alias("line_end"), F.count("*").alias("line_count"), F.array_sort(F.collect_list(F.struct("line_no", "line"))).alias("l"))
    return rows.select(key, "segment", "line_start", "line_end", "line_count", strip_space(F.array_join(F.transform("l", lambda x: x["line"]), "\n")).alias("content"))


def collapse_repeats(rows: DataFrame, key: str, order: str, value: str) -> DataFrame:
    """Rows whose value differs from the one before."""
    w = Window.partitionBy(key).orderBy(order)
    return rows.withColumn("__was", F.lag(value).over(w)).where(F.col("__was").isNull() | (F.col("__was") != F.col(value))).drop("__was")


def page_index(lines: DataFrame, key: str, least: int = 8) -> DataFrame:
    """Ordered (normalised line, page) rows for alignment."""
    return lines.withColumn("norm", match_line(F.col("line"))).where(F.length("norm") >= least)


class PagePlaces:
    """Where lines of a page index stand, by how they begin: finding the next one alike takes a few look-ups, not a scan."""

    def __init__(self, index: list, stem: int, least: int):
        self.pages = [x["page"] for x in index]
        self.stem, self.least = stem, least
        self.begins: dict[str, list[int]] = {}  # places of entries that begin so
        self.heads: dict[str, list[int]] = {}  # places of entries whose first characters, at most ``stem``, are these
        for place, entry in enumerate(index):
            head = entry["norm"][:stem]
            self.heads.setdefault(head, []).append(place)
            for n in range(least, len(head) + 1):
                self.begins.setdefault(head[:n], []).append(place)

    def after(self, line: str, start: int, window: int) -> int | None:
        """The first place from ``start`` on, within a window, whose entry begins like the line, or the line like it."""
        head = line[: self.stem]
        lists = [self.begins.get(head, [])] + [self.heads.get(head[:n], []) for n in range(self.least, len(head))]
        found = [x[i] for x in lists if (i := bisect_left(x, start)) < len(x)]
        return min(found) if found and min(found) < start + window else None


def annotate(docs: DataFrame, text: str, index: str, prefix: str = "DOC", window: int = 250, stem: int = 18, least: int = 8) -> DataFrame:
    """Page markers put into a text by aligning its lines with an index (array of (norm, page)): lines and index go forward
    together, and a marker stands before the first line of each page that is recognised."""
    lead, gaps = re.compile(r"^[#>\s*_]+"), re.compile(r"\s+")

    def one(text: str, index: list) -> str:
        places, start, page = PagePlaces(index, stem, least), 0, None
        marked: list[str] = []
        for raw in text.split("\n"):
            line = gaps.sub(" ", lead.sub("", raw)).strip().lower()
            place = places.after(line, start, window) if len(line) >= least else None
            if place is not None:
                start = place + 1
                if places.pages[place] != page:
                    page = places.pages[place]
                    marked.append(f"[[{prefix}_PAGE:{page}]]")
            marked.append(raw)
        return "\n".join(marked)

    @F.pandas_udf("string")
    def run(t: pd.Series, i: pd.Series) -> pd.Series:
        return pd.Series([one(a or "", list(b) if b is not None else []) for a, b in zip(t, i, strict=True)])

    return docs.withColumn("annotated", run(text, index))


def layout_lines(pages: DataFrame, key: str) -> DataFrame:
    """Lines of layout pages (page_idx, para_blocks, preproc_blocks: arrays of blocks): page from 1, block, kind, text."""
    blocks = F.when(F.size(F.coalesce("para_blocks", F.array())) > 0, F.col("para_blocks")).otherwise(F.col("preproc_blocks"))
    one = pages.select(key, (F.col("page_idx") + 1).alias("page"), F.posexplode_outer(blocks).alias("block_no", "block")).where("block is not null")
    span = lambda s: F.coalesce(F.nullif(F.trim(s["html"]), F.lit("")), F.trim(s["content"]))
    line = lambda l: F.trim(F.array_join(F.filter(F.transform(l["spans"], span), lambda x: x != ""), " "))  # noqa: E731, E741
    text = F.array_join(F.filter(F.transform("block.lines", line), lambda x: x != ""), " ")
    kind = F.col("block.type")
    body = F.when(kind == "title", F.concat(F.lit("# "), text)).otherwise(text)
    return one.select(key, "page", "block_no", kind.alias("kind"), body.alias("text")).where("text <> '' and text <> '# '")


def layout_markdown(pages: DataFrame, key: str, prefix: str = "DOC") -> DataFrame:
    per_page = layout_lines(pages, key).groupBy(key, "page").agg(F.array_sort(F.collect_list(F.struct("block_no", "text"))).alias("b"))
    per_page = per_page.select(key, "page", F.array_join(F.transform("b", lambda x: x["text"]), "\n").alias("content"))
    return render_pages(per_page, key, prefix)


def split_by_header(lines: DataFrame, key: str, header: str) -> DataFrame:
    """Articles of a text cut at lines that match a header (its first group is the number): key, number, content.

    A number that comes again gets ``_dup``, ``_dup2``, and so on; lines before the first header are dropped.
    """
    number = F.regexp_extract("line", header, 1)
    running = Window.partitionBy(key).orderBy("line_no").rowsBetween(Window.unboundedPreceding, 0)
    rows = lines.withColumn("__h", F.col("line").rlike(header)).withColumn("__n", F.when(F.col("__h"), number)).withColumn("part", F.sum(F.col("__h").cast("int")).over(running)).where("part > 0")
    body = F.array_join(F.transform(F.array_sort(F.collect_list(F.when(~F.col("__h"), F.struct("line_no", "line")))), lambda x: x["line"]), "\n")
    parts = rows.groupBy(key, "part").agg(F.max("__n").alias("__n"), body.alias("content"))
    k = F.row_number().over(Window.partitionBy(key, "__n").orderBy("part"))
    suffix = F.when(k == 1, "").when(k == 2, "_dup").otherwise(F.concat(F.lit("_dup"), (k - 1).cast("string")))
    return parts.select(key, "part", F.concat("__n", suffix).alias("number"), "content")


def between_marks(text, start: str, end: str):
    """What stands between two marks (the start mark included, the end mark not); null if one is missing."""
    a = F.locate(start, text)
    b = F.locate(end, text, 1)
    after = F.expr("1") * (F.length(F.substring_index(text, start, 1)) + len(start))
    rest = F.substring(text, after + 1, F.length(text))
    inner = F.substring_index(rest, end, 1)
    return F.when((a > 0) & (b > 0) & rest.contains(end), F.concat(F.lit(start), inner))
