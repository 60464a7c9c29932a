"""Text cleaning as column expressions.  All of them are fixed points: cleaning twice changes nothing more."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Characters without meaning in a text, and the accents that folding drops.
INVISIBLE = "​‌‍⁠﻿"
ACCENTED = "àâäáãçéèêëíìîïñóòôöõúùûüýÿ"
PLAIN = "aaaaaceeeeiiiinooooouuuuyy"
#: Confusions of character recognition and what they stand for, in order.
CONFUSIONS = [
    (r"\bL0I\b", "LOI"),
    (r"\bArtide\b", "Article"),
    (r"\bDÉCRÊT\b", "DECRET"),
    (r"\bARRETÊ\b", "ARRETE"),
    (r"\bN°\s*o\b", "N°"),
    (r"ﬁ\s?", "fi"),
    (r"ﬂ\s?", "fl"),
]
PAGE_MARK = r"^\[\[[A-Z]+_PAGE:(\d+)\]\]$"


def strip_invisible(c: Column) -> Column:
    return F.translate(c, INVISIBLE, "")


def strip_nul(c: Column) -> Column:
    return F.translate(c, "\u0000", "")


def fix_confusions(c: Column) -> Column:
    for pattern, to in CONFUSIONS:
        c = F.regexp_replace(c, "(?iuU)" + pattern, to)
    return c


def strip_space(c: Column) -> Column:
    """Without leading and trailing white space of any kind."""
    return F.regexp_replace(F.regexp_replace(c, r"(?U)^\s+", ""), r"(?U)\s+$", "")


def bare_line(c: Column) -> Column:
    """A line without markdown decoration, for matching."""
    c = F.regexp_replace(strip_space(c), r"(?U)^[#>\s]*[*_]{0,3}\s*", "")
    return strip_space(F.regexp_replace(c, r"(?U)\s*[*_]{1,3}$", ""))


def match_line(c: Column) -> Column:
    """A line normalised for alignment: lower case, single spaces, no leading decoration."""
    c = F.regexp_replace(c, r"(?U)^[#>\s*_]+", "")
    return F.lower(strip_space(F.regexp_replace(c, r"(?U)\s+", " ")))


def path_component(c: Column) -> Column:
    """Lower case, signs other than a-z, 0-9, _ and - become one -, never empty."""
    c = F.regexp_replace(F.lower(F.coalesce(c, F.lit(""))), r"[^a-z0-9_-]+", "-")
    c = F.regexp_replace(F.regexp_replace(c, r"-{2,}", "-"), r"^[-_]+|[-_]+$", "")
    return F.coalesce(F.nullif(c, F.lit("")), F.lit("document"))


def document_key(role: Column, slug: Column) -> Column:
    """Idempotence key of a document: ``stock:<slug>`` or ``flux:<slug>``."""
    return F.concat(F.when(F.upper(role) == "STOCK", "stock:").otherwise("flux:"), path_component(slug))


def object_key(root: Column, kind: Column, name: Column) -> Column:
    return F.concat_ws("/", path_component(root), path_component(kind), name)


def fold(c: Column) -> Column:
    """Lower case without accents."""
    return F.translate(F.lower(c), ACCENTED, PLAIN)


def fold_upper(c: Column) -> Column:
    return F.upper(fold(c))


def haystack(c: Column) -> Column:
    """Folded and without any white space: comparable despite bad recognition."""
    return F.regexp_replace(fold(c), r"(?U)\s+", "")


def is_banner_noise(c: Column) -> Column:
    """True if every line that isn't blank is a page number or a recalled division; true for empty texts."""
    lines = F.filter(F.transform(F.split(F.coalesce(c, F.lit("")), "\n"), bare_line), lambda x: x != "")
    page = lambda x: x.rlike(r"(?iu)^p\.?\s*\d+\.?$")
    division = lambda x: x.rlike(r"(?iuU)^(?:PARTIE|LIVRE|TITRE|CHAPITRE|SECTION|SOUS[\s\-]SECTION|PARAGRAPHE|§)(?:\b|(?<=§))")
    return F.forall(lines, lambda x: page(x) | division(x))


def is_upper_dominant(c: Column, share: float = 0.8) -> Column:
    """At least ``share`` of the letters are capitals; false without letters."""
    letters = F.regexp_count(c, F.lit(r"\p{L}"))
    return F.coalesce((letters > 0) & (F.regexp_count(c, F.lit(r"\p{Lu}")) >= share * letters), F.lit(False))


def has_table(c: Column) -> Column:
    return F.coalesce(c.rlike(r"(?i)<table\b"), F.lit(False))


def has_table_exact(c: Column) -> Column:
    """The case-sensitive prefilter."""
    return F.coalesce(c.contains("<table"), F.lit(False))


#: Entities decoded in page text.
ENTITIES = [("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&apos;", "'"), ("&eacute;", "é"), ("&egrave;", "è"), ("&agrave;", "à"), ("&ccedil;", "ç"), ("&ecirc;", "ê"), ("&ocirc;", "ô"), ("&amp;", "&")]


def html_text(c: Column) -> Column:
    """Text of a page: the first article element if there is one, no scripts or styles, tags as spaces."""
    body = F.regexp_extract(c, r"(?is)<article\b[^>]*>(.*?)</article\s*>", 1)
    c = F.when(body != "", body).otherwise(c)
    c = F.regexp_replace(c, r"(?is)<(?:script|style)\b[^>]*>.*?</(?:script|style)\s*>", " ")
    c = F.regexp_replace(c, r"(?s)<[^>]*>", " ")
    for name, to in ENTITIES:
        c = F.replace(c, F.lit(name), F.lit(to))
    return F.trim(F.regexp_replace(c, r"[ \t\n\r\f\x0b]+", " "))


def trigrams(c: Column) -> Column:
    """Distinct trigrams of the folded words, each padded with two spaces before and one after."""
    words = F.filter(F.split(F.regexp_replace(fold(c), r"[^a-z0-9]+", " "), " "), lambda w: w != "")
    grams = lambda w: F.transform(F.sequence(F.lit(1), F.length(w) + 1), lambda i: F.substring(F.concat(F.lit("  "), w, F.lit(" ")), i, F.lit(3)))
    return F.array_distinct(F.flatten(F.transform(words, grams)))


def word_similarity(query: Column, text: Column) -> Column:
    """Share of the query's trigrams that the text holds."""
    q = trigrams(query)
    return F.size(F.array_intersect(q, trigrams(text))) / F.greatest(F.size(q), F.lit(1))


def dehyphenate(c: Column) -> Column:
    """Words cut at a line end are whole again; single line breaks are spaces, blank lines part paragraphs."""
    c = F.regexp_replace(c, r"(\p{L})-[ \t]*\n[ \t]*(\p{Ll})", "$1$2")
    c = F.regexp_replace(c, r"[ \t]*\n(?:[ \t]*\n)+[ \t]*", "\u0001")
    c = F.regexp_replace(c, r"[ \t]*\n[ \t]*", " ")
    return F.replace(c, F.lit("\u0001"), F.lit("\n\n"))


def words(c: Column) -> Column:
    return F.regexp_extract_all(c, F.lit(r"(\p{L}+)"), 1)


def search_vector(content: Column, tags: Column) -> Column:
    """Weighted tokens: A from the content, B from the tags."""
    tokens = lambda x: F.array_sort(F.array_distinct(words(fold(x))))
    return F.struct(tokens(content).alias("a"), tokens(tags).alias("b"))
