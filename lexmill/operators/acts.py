"""Acts of a gazette: splitting a text into acts, and keeping one copy of each.

All of it is columns over the lines of a text.  A line is a candidate if it reads like a title and no sentence hangs over it
from the last line with text.  A candidate's title goes on over the lines after it, as far as those neither are blank nor open
something else; candidates inside another's title don't count, which one ordered fold over the few candidates of a
text decides.  A running sum numbers the acts, and lines gather by that number.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.classify import act_number_key, act_type
from ..functions.clean import bare_line, strip_space
from .lines import lines_of

#: Words that open an act, and those of them whose titles may go on over several lines.
OPENING = ["PROCLAIMATION", "PROCLAMATION", "DISCOURS", "ALLOCUTION", "ALLOCATION", "DELIBERATION", "LOI", "D[ÉE]CRET", "ARR[ÊE]T[ÉE]", "ORDONNANCE", "D[ÉE]CISION", "CIRCULAIRE", "AVIS", "COMMUNIQU[ÉE]", "RAPPORT", "NOTE"]
NORMATIVE = ["LOI", "D[ÉE]CRET", "ARR[ÊE]T[ÉE]", "ORDONNANCE", "D[ÉE]CISION"]
#: What a real title holds: a number, a date, or capitals.
NUMBERED, DATED, CAPITALS = r"\bN[°ºo]\s*\d", r"\b\d{1,2}\s+[a-zà-ÿ]+\s+\d{4}\b", r"^[\s’'A-ZÀ-Ÿ\-]{8,}"
#: The end of an entry of a table of contents, and of a title that ends with a page number.
CONTENTS_ENTRY, PAGE_END = r"\(\s*p(?:age)?\.?\s*\d+\s*\)\s*\.?\s*$", r"[\s.]\d{1,4}\.?$"
#: How the body of an act begins.
BODY = [
    r"L['’]ASSEMBL[ÉE]E\s+NATIONALE", r"LE\s+S[ÉE]NAT\b", r"LE\s+PR[ÉE]SIDENT\s+DE\s+LA\s+R[ÉE]PUBLIQUE", r"LE\s+GOUVERNEMENT\b", r"LE\s+PREMIER\s+MINISTRE", r"LE\s+MINISTRE", r"LA\s+MINISTRE",
    r"LE\s+SECR[ÉE]TAIRE\s+G[ÉE]N[ÉE]RAL", r"LE\s+DIRECTEUR\s+G[ÉE]N[ÉE]RAL", r"LA\s+DIRECTRICE\s+G[ÉE]N[ÉE]RALE", r"VU\b", r"CONSID[ÉE]RANT\b", r"ARTICLE\s+(?:PREMIER|1(?:ER)?)\b",
]
#: Lines that a new page begins with.
NEW_PAGE = [r"\[\[[A-Z]+_PAGE:\d+\]\]", r"\d{1,5}\s*$", r"Journal\s+off[ﬁi]ciel\s+de\s+la\s+R[ÉE]publique", r"N°\s*\d+[\-–]\d{4}\s*$"]
#: Signs that end a sentence, and small words that ask for more.
SENTENCE_END = r"[.!?:;»”\"…]['’\"”\s]*$"
ASKING = (
    "le la les l un une des du de d au aux ce cet cette ces son sa ses leur leurs notre nos votre vos mon ma mes à a en par pour sur sous dans avec sans vers chez entre depuis selon et ou ni mais donc or car "
    "que qu qui dont où comme si ledit ladite lesdits lesdites"
).split()
#: Lines that a title may go on for.
TITLE_LINES = 6


def _starts(line: Column, patterns: list[str], end: str = "") -> Column:
    return line.rlike(f"(?iuU)^(?:{'|'.join(patterns)}){end}")


def reads_like_title(bare: Column) -> Column:
    """A keyword, and after it a number, a date or capitals; no entry of a table of contents."""
    rest = F.regexp_extract(bare, f"(?iuU)^(?:{'|'.join(OPENING)})\\b(.*)$", 1)
    real = rest.rlike("(?iuU)" + NUMBERED) | rest.rlike("(?iuU)" + DATED) | rest.rlike(CAPITALS)
    return rest.rlike("[0-9A-Za-zÀ-ÿ]") & real & ~bare.rlike("(?iuU)" + CONTENTS_ENTRY)


def hangs(line: Column) -> Column:
    """A line whose sentence goes on: it ends with a small word or a hyphen, and no sign ends it."""
    return ~line.rlike(SENTENCE_END) & line.rlike(rf"(?U)(?:\b(?:{'|'.join(ASKING)})\s*['’]?|[A-Za-zÀ-ÿ]-)\s*$")


def title_lines(lines: DataFrame, key: str) -> DataFrame:
    """Lines (key, line_no, line) with ``opens``: the line may open an act."""
    line = strip_space(F.col("line"))
    ahead = Window.partitionBy(key).orderBy("line_no").rowsBetween(Window.unboundedPreceding, -1)
    before = F.last(F.when(line != "", line), ignorenulls=True).over(ahead)
    free = before.isNull() | _starts(before, NEW_PAGE) | ~hangs(bare_line(before)) | F.col("line").rlike(r"(?U)^\s*#{1,6}\s")
    return lines.withColumn("opens", reads_like_title(bare_line(F.col("line"))) & free)


def split_acts(docs: DataFrame, key: str, text: str) -> DataFrame:
    """Acts of every text: (key, act_no, title, content, type), one copy of each numbered act."""
    lines = title_lines(lines_of(docs.where(F.col(key).isNotNull()), key, text), key)
    line = strip_space(F.col("line"))
    lines = lines.withColumn("stops", (line == "") | _starts(line, OPENING, r"\b") | _starts(line, BODY) | _starts(line, NEW_PAGE))
    # lines that a title goes on for: up to the first that stops it
    inside = Window.partitionBy(key).orderBy("line_no")
    stops = F.array(*[F.coalesce(F.lead("stops", k).over(inside), F.lit(True)) for k in range(1, TITLE_LINES + 1)])
    more = F.coalesce(F.nullif(F.array_position(stops, True), F.lit(0)) - 1, F.lit(TITLE_LINES)).cast("int")
    more = F.when(_starts(bare_line(F.col("line")), NORMATIVE, r"\b"), more).otherwise(0)
    lines = lines.withColumn("last", F.when(F.col("opens"), F.col("line_no") + more))
    # the candidates that count: none inside the title of the one before
    fold = """aggregate(array_sort(collect_list(if(opens, struct(line_no as at, last as last), null))), cast(array() as array<struct<at: int, last: int>>),
        (seen, x) -> if(size(seen) = 0 or element_at(seen, -1).last < x.at, concat(seen, array(x)), seen))"""
    acts = lines.groupBy(key).agg(F.expr(fold).alias("acts")).select(key, F.posexplode("acts").alias("act", "x")).select(key, "act", F.col("x.at").alias("line_no"), "x.last")
    marked = lines.drop("last").join(acts, [key, "line_no"], "left")
    running = inside.rowsBetween(Window.unboundedPreceding, 0)
    marked = marked.withColumns({"of": F.last("act", ignorenulls=True).over(running), "until": F.last("last", ignorenulls=True).over(running)}).where("of is not null")
    title = F.when(F.col("act").isNotNull(), bare_line(F.col("line"))).when(F.col("line_no") <= F.col("until"), line)
    in_order = lambda c: F.transform(F.array_sort(F.collect_list(F.when(c.isNotNull(), F.struct("line_no", c.alias("x"))))), lambda s: s["x"])
    marked = marked.withColumn("t", title).withColumn("c", F.when(F.col("t").isNull(), F.col("line")))
    whole = marked.groupBy(key, "of").agg(F.array_join(in_order(F.col("t")), " ").alias("title"), F.array_join(in_order(F.col("c")), "\n").alias("content"))
    # a title that ends with a page number and has nothing below is an entry of a table of contents
    whole = whole.where((strip_space(F.col("content")) != "") | ~F.col("title").rlike("(?U)" + PAGE_END))
    number = (F.row_number().over(Window.partitionBy(key).orderBy("of")) - 1).cast("int")
    return longest_copies(whole.select(key, number.alias("act_no"), "title", "content", act_type(F.col("title")).alias("type")), key)


def longest_copies(acts: DataFrame, key: str, title: str = "title", content: str = "content", kind: str = "type", order: str = "act_no") -> DataFrame:
    """Of the acts of a type and number the longest, the first of equals; acts without a number all stay."""
    rows = acts.withColumn("__n", act_number_key(F.col(title)))
    numbered = rows.where(F.col("__n").isNotNull())
    w = Window.partitionBy(key, kind, "__n").orderBy(F.length(content).desc(), order)
    numbered = numbered.withColumn("__r", F.row_number().over(w)).where("__r = 1").drop("__r")
    return numbered.unionByName(rows.where(F.col("__n").isNull())).drop("__n")


def key_suffix(acts: DataFrame, key: str, order: str, base: str) -> DataFrame:
    """Keys of acts made unique: later acts of a key get ``_acte_<k>`` from 2 on."""
    k = F.row_number().over(Window.partitionBy(key, base).orderBy(order))
    return acts.withColumn("document_key", F.when(k > 1, F.concat(F.col(base), F.lit("_acte_"), k.cast("string"))).otherwise(F.col(base)))


def new_acts(acts: DataFrame, existing: DataFrame) -> DataFrame:
    """Acts whose key isn't taken: what exists is never overwritten."""
    return acts.join(existing.select("document_key"), "document_key", "left_anti")
