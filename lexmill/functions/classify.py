"""Types, numbers, dates, references and citations read from titles and texts, as column expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .clean import fold, fold_upper

#: Fixed values: (pattern, type) in order; the first two match anywhere, the others are the spellings that a title starts with.
TYPE_ANYWHERE = [(r"\bconventions?[\s\-]+collectives?\b", "CONVENTION_COLLECTIVE"), (r"\bacte[\s\-]+uniforme\b", "ACTE_UNIFORME")]
TYPE_START = [
    (["loi constitutionnelle"], "LOI_CONSTITUTIONNELLE"),
    (["loi"], "LOI"),
    (["décret", "decret"], "DECRET"),
    (["arrêté", "arrete", "arrété"], "ARRETE"),
    (["ordonnance"], "ORDONNANCE"),
    (["décision", "decision"], "DECISION"),
    (["circulaire"], "CIRCULAIRE"),
    (["constitution"], "CONSTITUTION"),
    (["proclamation", "proclaimation"], "PROCLAMATION"),
    (["discours"], "DISCOURS"),
    (["allocution", "allocation"], "ALLOCUTION"),
    (["délibération", "deliberation"], "DELIBERATION"),
    (["communiqué", "communique"], "COMMUNIQUE"),
    (["rapport"], "RAPPORT"),
    (["note"], "NOTE"),
    (["avis"], "AVIS"),
]
#: Words looked for in a capitalised title if nothing else matched, in order.
TYPE_WITHIN = [
    (["DECRET", "DÉCRET"], "DECRET"),
    (["ARRETE", "ARRÊTÉ"], "ARRETE"),
    (["ORDONNANCE"], "ORDONNANCE"),
    (["LOI"], "LOI"),
    (["CONSTITUTION"], "CONSTITUTION"),
    (["PROCLAMATION", "PROCLAIMATION"], "PROCLAMATION"),
    (["DISCOURS"], "DISCOURS"),
    (["ALLOCUTION", "ALLOCATION"], "ALLOCUTION"),
    (["DELIBERATION", "DÉLIBÉRATION"], "DELIBERATION"),
]
#: Type to code of the type dimension; all other types are TEXTE.
TYPE_CODES = {"CONVENTION_COLLECTIVE": "CONV", "ACTE_UNIFORME": "AU", "LOI_CONSTITUTIONNELLE": "LOI", "LOI": "LOI", "DECRET": "DEC", "ARRETE": "ARR", "ORDONNANCE": "ORD", "CONSTITUTION": "CONST"}
#: Nature to code, then title patterns to code, in order.
NATURE_CODES = {"journal officiel": "JO", "code": "CODE", "loi": "LOI", "décret": "DEC", "arrêté": "ARR", "ordonnance": "ORD", "constitution": "CONST", "acte uniforme": "AU"}
TITLE_CODES = [
    (r"^journal\s+officiel", "JO"),
    (r"^constitution|constitution\s+\d{4}", "CONST"),
    (r"^acte\s+uniforme", "AU"),
    (r"^loi\b", "LOI"),
    (r"^d[eé]cret\b", "DEC"),
    (r"^arr[eê]t[eé]\b", "ARR"),
    (r"^ordonnance\b", "ORD"),
    (r"^code\b|\bcode\s+(de|du|des|p[eé]nal|civil)\b", "CODE"),
    (r"^convention\s+collective", "CONV"),
]
#: Months, folded.
MONTHS = ["janvier", "fevrier", "mars", "avril", "mai", "juin", "juillet", "aout", "septembre", "octobre", "novembre", "decembre"]
#: Act keywords, the more specific before the more general.
ACT_KEYWORDS = ["LOI ORGANIQUE", "LOI CONSTITUTIONNELLE", "DECRET-LOI", "DECRET", "ARRETE CONJOINT", "ARRETE", "ORDONNANCE", "DECISION", "DELIBERATION", "CIRCULAIRE", "CONVENTION", "ACCORD", "PROTOCOLE", "RESOLUTION", "INSTRUCTION", "AVIS", "COMMUNIQUE", "LOI"]
#: Failures that pass, by the name of their class.
TRANSIENT = ["ConnectionError", "ConnectTimeout", "ReadTimeout", "TimeoutError", "TimeoutException", "RemoteProtocolError", "PoolTimeout"]


def _ladder(rungs: list[tuple[Column, str]], otherwise) -> Column:
    out = None
    for cond, value in rungs:
        out = F.when(cond, value) if out is None else out.when(cond, value)
    return out.otherwise(otherwise)


def act_type(title: Column) -> Column:
    """Type of an act by its title; TEXTE if nothing tells."""
    t = F.trim(title)
    rungs = [(t.rlike("(?iuU)" + p), v) for p, v in TYPE_ANYWHERE]
    rungs += [(t.rlike(f"(?iuU)^(?:{'|'.join(words)})\\b"), v) for words, v in TYPE_START]
    rungs += [(F.upper(t).rlike("|".join(words)), v) for words, v in TYPE_WITHIN]
    return _ladder(rungs, F.lit("TEXTE"))


def type_code(kind: Column, dimension: DataFrame | None = None) -> Column:
    """Code of a type; join with the dimension to void codes that it doesn't know (see ``known_codes``)."""
    return _ladder([(kind == k, v) for k, v in TYPE_CODES.items()], F.lit("TEXTE"))


def known_codes(df: DataFrame, code: str, dimension: DataFrame, key: str) -> DataFrame:
    """Null where the dimension doesn't hold the code."""
    dim = dimension.select(F.col(key).alias(code)).distinct().withColumn("__known", F.lit(True))
    return df.join(dim, code, "left").withColumn(code, F.when(F.col("__known"), F.col(code))).drop("__known")


def deduced_code(nature: Column, title: Column) -> Column:
    """Code by declared nature, else by title, else TEXTE."""
    n = F.lower(F.trim(nature))
    by_nature = _ladder([(n == k, v) for k, v in NATURE_CODES.items()], F.lit(None).cast("string"))
    by_title = _ladder([(F.trim(title).rlike("(?iuU)" + p), v) for p, v in TITLE_CODES], F.lit("TEXTE"))
    return F.coalesce(by_nature, by_title)


def legal_scope(title: Column, asked: Column) -> Column:
    a, t = F.lower(F.trim(asked)), F.upper(title)
    return _ladder(
        [
            (a.isin("national", "ohada", "communautaire"), a),
            (t.contains("OHADA") | t.contains("ACTE UNIFORME"), "ohada"),
            (t.contains("CEMAC") | t.contains("UNION AFRICAINE") | t.contains("COMMUNAUTAIRE"), "communautaire"),
        ],
        F.lit("national"),
    )


def reference(title: Column) -> Column:
    """Number of an act in its title; without one the next word, as in the source."""
    found = F.regexp_extract(title, r"(?iu)\b(?:LOI|D[EÉ]CRET|ARR[EÊ]T[EÉ]|ORDONNANCE|D[EÉ]CISION)\s*(?:N[°ºOo]\s*)?([A-Z0-9./-]+)", 1)
    return F.when(found != "", F.upper(F.trim(found)))


_MONTH = "janvier|f[eé]vrier|mars|avril|mai|juin|juillet|ao[uû]t|septembre|octobre|novembre|d[eé]cembre"


def french_date(text: Column) -> Column:
    """First date like ``28 mai 2025``; null if there is none or its day doesn't exist."""
    pattern = rf"(?iu)\b(\d{{1,2}})\s+({_MONTH})\s+(\d{{4}})\b"
    day, month, year = (F.regexp_extract(text, pattern, k) for k in (1, 2, 3))
    m = F.array_position(F.array(*map(F.lit, MONTHS)), fold(month))
    return F.when(day != "", F.try_to_date(F.concat_ws("-", year, F.lpad(m.cast("string"), 2, "0"), F.lpad(day, 2, "0")), "yyyy-MM-dd"))


def iso_date(text: Column) -> Column:
    return F.when(text.rlike(r"^\d{4}-\d{2}-\d{2}$"), F.try_to_date(text, "yyyy-MM-dd"))


def masthead_date(text: Column) -> Column:
    """Date of an issue from the head of its text: the first whose year fits the ordinal of the volume."""
    head = F.regexp_replace(F.regexp_replace(F.substring(text, 1, 8000), r"\[\[[A-Z]+_PAGE:\d+\]\]", " "), r"(?U)\s+", " ")
    pattern = r"(?iu)(\d{2}\s*(?:e|è|ème|eme)\s*ANN[ÉE]E\b.{0,80}?\b\d{1,2}(?:er)?\s+[a-zéèêûô]+\s+\d{4})"
    found = F.regexp_extract_all(head, F.lit(pattern), 1)
    part = lambda x, k: F.regexp_extract(x, r"(?iu)^(\d{2})[^\n]*?\b(\d{1,2})(?:er)?\s+([a-zéèêûô]+)\s+(\d{4})$", k)
    month = lambda x: F.array_position(F.array(*map(F.lit, MONTHS)), fold(part(x, 3)))
    date = lambda x: F.try_to_date(F.concat_ws("-", part(x, 4), F.lpad(month(x).cast("string"), 2, "0"), F.lpad(part(x, 2), 2, "0")), "yyyy-MM-dd")
    fits = lambda x: (part(x, 4).cast("int") - part(x, 1).cast("int")).isin(1958, 1959)
    return F.get(F.filter(F.transform(F.filter(found, fits), date), lambda d: d.isNotNull()), 0)


def act_number_key(title: Column) -> Column:
    """Number that tells copies of an act in one issue; null without one."""
    found = F.regexp_extract(title, r"(?iu)\bN[°ºo]\s*([0-9][0-9A-Za-z./\-]*)", 1)
    return F.when(found != "", F.regexp_replace(F.upper(found), r"[./\-]+$", ""))


def act_keyword(title: Column) -> Column:
    t = F.ltrim(fold_upper(title))
    return _ladder([((t == k) | t.startswith(k + " "), k) for k in ACT_KEYWORDS], F.lit(None).cast("string"))


def act_number(title: Column) -> Column:
    found = F.regexp_extract(F.upper(title), r"N\\?[°ºO*]\.?\s*([0-9][0-9A-Z]*(?:[\-/][0-9A-Z]+)*)", 1)
    return F.when(found != "", found)


def normal_number(number: Column) -> Column:
    """Segments without leading zeros, parted by -."""
    return F.array_join(F.transform(F.split(number, r"[\-/]"), lambda x: F.coalesce(F.nullif(F.ltrim(x, F.lit("0")), F.lit("")), F.lit("0"))), "-")


def ordinal(number: Column) -> Column:
    """Place of an article in its series; null for insertions and replacements."""
    low = F.lower(number)
    return (
        F.when(low.contains("nouveau") | low.contains("nouvelle"), None)
        .when(low.startswith("premier") | low.startswith("première") | low.startswith("premiere"), 1)
        .when(low.rlike(r"(?U)\b(?:bis|ter|quater|quinquies|sexies|septies)\b") | low.rlike(r"-\d+$") | low.rlike(r"^\d+\.\d+") | low.rlike(r"\d\s+[a-z]\)?$"), None)
        .otherwise(F.regexp_extract(number, r"^(\d+)", 1).try_cast("int"))
    )


def original_number(number: Column) -> Column:
    """What a number was before a suffix made it unique; null if it has none."""
    return F.when(number.rlike(r"_doublon_\d+$"), F.regexp_extract(number, r"^(.*)_doublon_\d+$", 1))


def issue_title(year: Column, number: Column, basename: Column) -> Column:
    base = F.concat(F.lit("Journal officiel n° "), number, F.lit("-"), year)
    stem = F.concat(F.lit("congo-jo-"), year, F.lit("-"))
    plain, padded = F.concat(stem, number), F.concat(stem, F.lpad(number, 2, "0"))
    rest = lambda p: F.replace(F.substring(basename, F.length(p) + 2, F.length(basename)), F.lit("-"), F.lit(" "))
    variant = lambda p: F.concat(base, F.lit(" — "), F.when(rest(p) == "sp", "spécial").otherwise(rest(p)))
    dash = F.lit("-")
    return (
        F.when((basename == plain) | (basename == padded), base)
        .when(basename.startswith(F.concat(plain, dash)), variant(plain))
        .when(basename.startswith(F.concat(padded, dash)), variant(padded))
        .otherwise(F.concat(base, F.lit(" — "), basename))
    )


def decision_header(text: Column) -> Column:
    """struct(number, date, chamber) from the head of a decision."""
    pattern = r"(?iu)Arr[êe]t\s+N°\s*(\d+)\s*(?:/\s*(\d{4}))?\s+du\s+(\d{1,2}\s+\S+\s+\d{4})"
    number, year, words = (F.regexp_extract(text, pattern, k) for k in (1, 2, 3))
    date = french_date(words)
    year = F.coalesce(F.nullif(year, F.lit("")), F.year(date).cast("string"))
    full = F.when(number == "", None).when(year.isNull(), number).otherwise(F.concat(number, F.lit("/"), year))
    chamber = F.regexp_extract(text, r"(?iu)(Première|Deuxième|Troisième|Quatrième)\s+chambre", 1)
    return F.struct(full.alias("number"), date.alias("date"), F.when(chamber != "", F.concat(chamber, F.lit(" chambre"))).alias("chamber"))


CITATION_ACT = r"(?iu)(l['’]articles?\s+\d+(?:[^.;]{0,40}?)\s+de\s+l['’]Acte\s+uniforme\s+(?:portant|relatif\s+à|organisant)\s+[^,;.]{1,120})"
CITATION_CODE = r"(?iu)(articles?\s+\d+(?:\s*(?:,|et)\s*\d+)*\s+(?:du|de)\s+Code\s+[^,;.]+)"


def citations(text: Column) -> Column:
    """array<struct(raw, label, article)>: distinct raw references, uniform acts first, in order."""
    squeeze = lambda x: F.trim(F.regexp_replace(x, r"(?U)\s+", " "))
    acts = F.transform(F.regexp_extract_all(text, F.lit(CITATION_ACT), 1), squeeze)
    codes = F.transform(F.regexp_extract_all(text, F.lit(CITATION_CODE), 1), squeeze)
    label = lambda x: F.regexp_extract(x, r"(?iu)Acte uniforme ((?:portant|relatif à|organisant) .*)$", 1)
    return F.transform(
        F.array_distinct(F.concat(acts, codes)),
        lambda x: F.struct(
            x.alias("raw"),
            F.when(F.array_contains(acts, x), label(x)).alias("label"),
            F.when(F.array_contains(acts, x), F.regexp_extract(x, r"(?iu)^l['’]articles? (\d+)", 1)).alias("article"),
        ),
    )


def parties(text: Column) -> Column:
    """``X contre Y`` without counsel; null if counsel is still named."""
    raw = F.regexp_extract(text, r"(?su)Affaire\s*:?\s*(.{3,300}?)\s+[Cc]ontre\s*:?\s*(.{3,300}?)(?=\s*(?:;|\.|Arr[êe]t\b|LA COUR|La Cour|$))", 0)
    side = lambda k: F.trim(F.regexp_replace(F.regexp_extract(raw, r"(?su)Affaire\s*:?\s*(.{3,300}?)\s+[Cc]ontre\s*:?\s*(.{3,300}?)$", k), r"(?su)\s*\((?:Conseils?|Avocats?)\s*:[^)]*\)", ""))
    out = F.concat(side(1), F.lit(" contre "), side(2))
    return F.when((raw != "") & ~out.rlike(r"(?iu)\b(?:conseils?|avocats?|ma[iî]tres?)\b"), out)


def act_suffix(title: Column) -> Column:
    """What follows ``Acte uniforme`` in a title, without a closing parenthesis."""
    after = F.regexp_extract(title, r"(?iu)Acte\s+uniforme\s+(.+)", 1)
    return F.trim(F.regexp_replace(F.when(after != "", after).otherwise(title), r"\s*\([^)]*\)\s*$", ""))


def is_real_title(rest: Column) -> Column:
    """What follows a keyword reads like a title: a number, a date, or capitals."""
    return rest.rlike(r"(?iu)\bN[°ºo]\s*\d") | rest.rlike(r"(?iu)\b\d{1,2}\s+[a-zà-ÿ]+\s+\d{4}\b") | rest.rlike(r"^[\s’'A-ZÀ-Ÿ\-]{8,}")


#: Starts of acts in a compilation, with their codes, in order.
_NUMBERED = r"N\s*[°ºo0]?\s*\d"
BOUNDARIES = [
    (r"^LOI\s+(?:CONSTITUTIONNELLE|ORGANIQUE)\b", "LOI"),
    (rf"^LOI\s+{_NUMBERED}", "LOI"),
    (rf"^ORDONNANCE\s+{_NUMBERED}", "ORD"),
    (rf"^D[ÉE]CRET(?:[-\s]LOI)?\s+{_NUMBERED}", "DEC"),
    (rf"^ARR[ÊE]T[ÉE]\s+{_NUMBERED}", "ARR"),
    (r"^CODE\s+[A-ZÀ-Ÿ]", "CODE"),
    (rf"^AVIS\s+{_NUMBERED}", "TEXTE"),
]


def heading_line(line: Column) -> Column:
    return F.trim(F.regexp_replace(F.trim(line), r"^#+\s*", ""))


def boundary_code(line: Column) -> Column:
    return _ladder([(line.rlike("(?iu)" + p), v) for p, v in BOUNDARIES], F.lit(None).cast("string"))


def is_heading(line: Column) -> Column:
    """A markdown heading, the start of an act, or a line mostly in capitals."""
    t = F.trim(line)
    letters, capitals = F.regexp_count(t, F.lit(r"\p{L}")), F.regexp_count(t, F.lit(r"\p{Lu}"))
    return t.startswith("#") | boundary_code(heading_line(line)).isNotNull() | ((letters >= 6) & (capitals >= 0.8 * letters))


def parent_of_path(path: Column) -> Column:
    """Id of the parent in a path of ``n_<id>`` labels parted by dots; null at the root."""
    labels = F.split(path, r"\.")
    return F.when(F.size(labels) > 1, F.replace(F.regexp_replace(F.element_at(labels, -2), "^n_", ""), F.lit("_"), F.lit("-")))


def error_class(name: Column, message: Column, status: Column | None = None) -> Column:
    """Class of a failure.  An HTTP status (given, or named in the message) decides first: a refusal is definitive but for 408
    and 429, every other status passes."""
    named = F.regexp_extract(message, r"(?i)\b(?:HTTP|status|statut|code)\D{0,8}([1-5]\d\d)\b", 1).try_cast("int")
    code = named if status is None else F.coalesce(status, named)
    return _ladder(
        [
            (code.between(400, 499) & ~code.isin(408, 429), "definitive"),
            (code.isNotNull(), "transitoire"),
            (name.isin(*TRANSIENT) | message.contains("appel Mistral en échec") | message.contains("MinIO"), "transitoire"),
            (message.contains("validation du schéma en échec") | message.contains("date de consolidation introuvable"), "information_manquante"),
        ],
        F.lit("definitive"),
    )


def backoff(attempts: Column, base: float = 30.0, cap: float = 1800.0) -> Column:
    return F.least(F.lit(cap), F.lit(base) * F.pow(F.lit(2.0), F.greatest(F.lit(0), attempts - 1)))


def next_run(now: Column, hour: int, minute: int = 0) -> Column:
    """The next daily time strictly after now."""
    today = F.date_trunc("day", now) + F.expr(f"make_interval(0, 0, 0, 0, {hour}, {minute}, 0)")
    return F.when(now < today, today).otherwise(today + F.expr("interval 1 day"))


def is_unreadable(content: Column) -> Column:
    """Empty, or no ``%PDF-`` in the first kilobyte."""
    return (F.length(content) == 0) | (F.locate("%PDF-", F.substring(content.cast("string"), 1, 1024)) == 0)


def reception(content: Column, most: int) -> Column:
    """What becomes of an upload: empty, too_large (in bytes), no_header (see ``is_unreadable``) or accepted."""
    return _ladder([(F.length(content) == 0, "empty"), (F.length(content) > most, "too_large"), (is_unreadable(content), "no_header")], F.lit("accepted"))


#: Keywords of source series by leading path, in order.
SOURCES = [
    ("sgg/JO", "sgg-jo", "journal_officiel"),
    ("sgg/hors-series", "sgg-jo", "journal_officiel"),
    ("sgg/codes", "sgg-codes", "code"),
    ("sgg/Lois", "sgg-lois", "loi"),
    ("sgg/décret", "sgg-decrets", "decret"),
    ("sgg/arrete", "sgg-autres", "arrete"),
    ("sgg/circulaire", "sgg-autres", "circulaire"),
    ("sgg/constitution", "sgg-autres", "constitution"),
    ("sgg/textes-officiels", "sgg-autres", "texte_officiel"),
    ("sgg/ccm", "sgg-autres", "ccm"),
    ("sgg/traitées-internationaux", "sgg-traites", "traite_international"),
    ("avocat_alban", "avocat-alban", "lot_prive"),
    ("code-penal", "code-penal", "code"),
]


def source_of(path: Column) -> Column:
    """struct(manifest, kind) of a source file by its leading path."""
    rung = lambda k: _ladder([(path.startswith(s[0] + "/"), s[k]) for s in SOURCES], F.lit("divers" if k == 1 else "inconnu"))
    return F.struct(rung(1).alias("manifest"), rung(2).alias("kind"))


def issue_filename(name: Column) -> Column:
    """struct(year, number, special) of an issue's file name; null outside the grammar."""
    pattern = r"(?i)^congo-jo-(\d{4})-(\d{1,3})([a-z0-9-]*)\.pdf$"
    number = F.coalesce(F.nullif(F.ltrim(F.regexp_extract(name, pattern, 2), F.lit("0")), F.lit("")), F.lit("0"))
    return F.when(
        name.rlike(pattern),
        F.struct(F.regexp_extract(name, pattern, 1).try_cast("int").alias("year"), number.alias("number"), F.lower(F.regexp_extract(name, pattern, 3)).contains("-sp").alias("special")),
    )


def sanitize_filename(name: Column) -> Column:
    base = F.element_at(F.split(F.coalesce(name, F.lit("")), r"[/\\]"), -1)
    clean = F.regexp_replace(F.regexp_replace(base, r"[^\p{L}\p{N}._-]+", "_"), r"^[._]+", "")
    return F.coalesce(F.nullif(clean, F.lit("")), F.lit("document.pdf"))
