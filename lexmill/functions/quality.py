"""Readability of recognised text: counts of damage, penalties, and a score in [0, 1]."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .clean import CONFUSIONS

#: Words of one letter that French has.
SINGLE_LETTERS = ["a", "à", "y", "l", "d", "c", "n", "s", "j", "m", "t"]
THRESHOLD = 0.60


def with_quality(df: DataFrame, text: str = "text") -> DataFrame:
    """Adds counts, penalties (4 decimals) and ``score``; an empty text scores 1."""
    t = F.coalesce(F.col(text), F.lit(""))
    n = F.length(t)
    artifacts = sum((F.regexp_count(t, F.lit("(?iuU)" + p)) for p, _ in CONFUSIONS), F.lit(0))
    out = df.withColumns({
        "total_chars": n,
        "replacement_count": F.regexp_count(t, F.lit("�")),
        "control_count": F.regexp_count(t, F.lit("[\\x00-\\x08\\x0b\\x0c\\x0e-\\x1f]")),
        "artifact_count": artifacts.cast("int"),
        "total_words": F.regexp_count(t, F.lit(r"\p{L}+")),
        "single_letters": F.regexp_count(t, F.lit(r"(?<!\p{L})(?![" + "".join(SINGLE_LETTERS + [x.upper() for x in SINGLE_LETTERS]) + r"])\p{L}(?!\p{L})")),
    })
    one = F.lit(1.0)
    ratio = lambda a, b: F.when(F.col(b) > 0, F.col(a) / F.col(b)).otherwise(0.0)
    p = {
        "p_replacement": F.least(one, ratio("replacement_count", "total_chars") * 40),
        "p_control": F.least(one, ratio("control_count", "total_chars") * 30),
        "p_artifact": F.least(one, F.when(F.col("total_chars") > 0, F.col("artifact_count") / (F.col("total_chars") / 1000.0)).otherwise(0.0) * 0.05),
        "p_fragmentation": F.least(one, F.greatest(F.lit(0.0), ratio("single_letters", "total_words") - 0.05) * 4),
    }
    out = out.withColumns(p)
    out = out.withColumn("score", F.round(F.greatest(F.lit(0.0), 1 - F.greatest(*p)), 4))
    return out.withColumns({k: F.round(k, 4) for k in p})


def quality_sql(table: str, text: str = "text") -> str:
    """The same as DuckDB SQL (a subquery)."""
    singles = "".join(SINGLE_LETTERS + [x.upper() for x in SINGLE_LETTERS])
    patterns = [r"(?:^|[^0-9A-Za-z_])L0I", r"(?:^|[^0-9A-Za-z_])Artide(?:[^0-9A-Za-z_]|$)", "DÉCRÊT", "ARRETÊ", r"N°\s*o(?:[^0-9A-Za-z_]|$)", "ﬁ", "ﬂ"]
    counts = " + ".join(f"len(regexp_extract_all(t, '(?i){p}'))" for p in patterns)
    return f"""(select *, round(greatest(0.0, 1 - greatest(pr, pc, pa, pf)), 4) as score, round(pr, 4) as p_replacement, round(pc, 4) as p_control,
        round(pa, 4) as p_artifact, round(pf, 4) as p_fragmentation from (
      select *, least(1.0, case when total_chars > 0 then replacement_count::double / total_chars else 0 end * 40) as pr,
        least(1.0, case when total_chars > 0 then control_count::double / total_chars else 0 end * 30) as pc,
        least(1.0, case when total_chars > 0 then artifact_count / (total_chars / 1000.0::double) else 0 end * 0.05) as pa,
        least(1.0, greatest(0.0, case when total_words > 0 then single_letters::double / total_words else 0 end - 0.05) * 4) as pf from (
      select *, length(t) as total_chars, len(regexp_extract_all(t, '�')) as replacement_count,
        len(regexp_extract_all(t, '[\\x00-\\x08\\x0b\\x0c\\x0e-\\x1f]')) as control_count, {counts} as artifact_count,
        len(regexp_extract_all(t, '\\p{{L}}+')) as total_words,
        len(list_filter(regexp_extract_all(t, '\\p{{L}}+'), lambda w: length(w) = 1 and not contains('{singles}', w))) as single_letters
      from (select *, coalesce({text}, '') as t from {table}))))"""


def low_quality(score: Column, threshold: float = THRESHOLD) -> Column:
    return score < threshold
