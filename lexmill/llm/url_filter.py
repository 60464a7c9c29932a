"""URL filter: domain rules first, gradient-boosted trees on lexical features for the rest.

Rules (host, path prefix, verdict) come first: a rule fits its host and every subdomain if the url's path starts
with the rule's path, and the longest fitting rule wins.  The urls that rules judge are the labelled urls; a bounded
sample of them (``sample`` rows, smallest hashes first) trains the trees (JVM side), which judge
every other url.  Features: length, depth, digit ratio, character entropy, parameter count, hyphens, label count, and
for the host's last label its share of all urls and its smoothed block rate among labelled ones.  Main path:
DataFrame functions only.

Defined results: a null url, or one without ``://``, has empty host and path and is judged by the trees; repeated rows
are judged alike; urls of any length are read whole; of rules of equal length that fit, the first in the alphabet counts; columns other
than page_id and url are ignored; an empty table gives an empty result; if the labelled urls know one class only, that class is
the verdict, and ``allow`` if there are none.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
FEATURES = ["f_length", "f_depth", "f_digits", "f_entropy", "f_params", "f_hyphens", "f_labels", "f_path_length", "f_suffix_share", "f_suffix_block"]


def split_url(url: Column) -> tuple[Column, Column]:
    """(host, path) of a url: what follows the first ``://``, cut at ``/``, ``?`` or ``#``."""
    at = F.locate("://", url)
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")
    rest = F.coalesce(rest, F.lit(""))
    raw = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(F.substring(rest, F.length(raw) + 1, F.length(rest)), r"^[^?#]*", 0)
    return F.translate(raw, _UPPER, _LOWER), path


def rule_column(host: Column, path: Column, rules: list[tuple[str, str]]) -> Column:
    """The longest rule (``host/path``) that fits, else null."""
    out = None
    for rule, _ in sorted(rules, key=lambda r: (-len(r[0]), r[0])):
        name, _, prefix = rule.partition("/")
        fits = ((host == name) | host.endswith("." + name)) & path.startswith("/" + prefix)
        out = F.when(fits, rule) if out is None else out.when(fits, rule)
    return out if out is not None else F.lit(None).cast("string")


def lexical(df: DataFrame) -> DataFrame:
    """Features of a url on its own; needs url, host, path."""
    url = F.coalesce(F.col("url"), F.lit(""))
    n = F.length(url)
    chars = F.array_distinct(F.split(url, ""))
    share = lambda c: (n - F.length(F.replace(url, c, F.lit("")))) / n
    entropy = F.aggregate(chars, F.lit(0.0), lambda acc, c: acc - F.when(c == "", 0.0).otherwise(share(c) * F.log2(share(c))))
    query = F.regexp_extract(url, r"\?([^#]*)", 1)
    return df.withColumns({
        "f_length": n.cast("double"),
        "f_depth": F.regexp_count(F.col("path"), F.lit("/[^/]")).cast("double"),
        "f_digits": F.coalesce(F.regexp_count(url, F.lit("[0-9]")) / F.when(n > 0, n), F.lit(0.0)),
        "f_entropy": F.when(n > 0, entropy).otherwise(0.0),
        "f_params": F.when(query == "", 0).otherwise(F.regexp_count(query, F.lit("&")) + 1).cast("double"),
        "f_hyphens": F.regexp_count(url, F.lit("[-_]")).cast("double"),
        "f_labels": F.regexp_count(F.col("host"), F.lit("[^.]+")).cast("double"),
        "f_path_length": F.length("path").cast("double"),
        "suffix": F.element_at(F.split(F.col("host"), r"\."), -1),
    })


def url_filter(spark: SparkSession, pages: DataFrame, rules: list[tuple[str, str]], sample: int = 20_000, trees: int = 12, depth: int = 4) -> DataFrame:
    """Verdict of every page: page_id, host, path, rule, verdict, block_score."""
    from pyspark.ml.classification import GBTClassifier
    from pyspark.ml.feature import VectorAssembler

    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"))
    host, path = split_url(F.col("url"))
    rows = rows.withColumns({"host": host, "path": path})
    rows = rows.withColumn("rule", rule_column(F.col("host"), F.col("path"), rules))
    blocked = [r for r, v in rules if v == "block"]
    rows = rows.withColumn("label", F.when(F.col("rule").isNull(), None).otherwise(F.col("rule").isin(blocked).cast("double")))
    rows = lexical(rows)
    stats = rows.groupBy("suffix").agg(F.count("*").alias("n"), F.count("label").alias("judged"), F.sum("label").alias("bad"))
    total = stats.agg(F.sum("n"), F.sum("judged"), F.sum("bad")).first()
    n, judged, bad = (float(x or 0) for x in total)
    prior = bad / judged if judged else 0.0
    stats = stats.select(
        "suffix",
        (F.col("n") / F.lit(max(n, 1.0))).alias("f_suffix_share"),
        ((F.coalesce("bad", F.lit(0.0)) + 10 * F.lit(prior)) / (F.coalesce("judged", F.lit(0)) + 10)).alias("f_suffix_block"),
    )
    rows = rows.join(stats, "suffix")
    out = ["page_id", "host", "path", "rule"]
    by_rule = F.when(F.col("label") == 1, "block").when(F.col("label") == 0, "allow")
    if not judged or bad in (0.0, judged):
        one = "block" if judged and bad == judged else "allow"
        return rows.select(*out, F.coalesce(by_rule, F.lit(one)).alias("verdict"), F.lit(float(one == "block")).alias("block_score"))
    features = VectorAssembler(inputCols=FEATURES, outputCol="features")
    train = features.transform(rows.where("label is not null").orderBy(F.xxhash64("url", "page_id"), "page_id").limit(sample).coalesce(2)).select("features", "label")
    gbt = GBTClassifier(maxIter=trees, maxDepth=depth, seed=7, maxBins=32, stepSize=0.3)
    model = gbt.fit(train)
    from pyspark.ml.functions import vector_to_array  # JVM function

    scored = model.transform(features.transform(rows))
    score = vector_to_array("probability")[1]
    return scored.select(*out, F.coalesce(by_rule, F.when(score >= 0.5, "block").otherwise("allow")).alias("verdict"), score.alias("block_score"))
