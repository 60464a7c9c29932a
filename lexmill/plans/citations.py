"""Citations of decisions resolved against the acts and articles of a store."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.classify import act_suffix, citations
from .promotion import longest_prefix


def current_texts(documents: DataFrame, articles: DataFrame, versions: DataFrame, kind: str) -> DataFrame:
    """Texts of all versions of the live articles of live documents of a type (no filter on the version's validity)."""
    docs = documents.where((F.col("type_code") == kind) & F.col("deleted_at").isNull()).select("document_id")
    live = articles.where(F.col("deleted_at").isNull()).select("article_id", "document_id")
    return docs.join(live, "document_id").join(versions.select("article_id", "content"), "article_id").select("document_id", "content")


def cited_articles(cited: DataFrame, articles: DataFrame) -> DataFrame:
    """The live article of a document and number, the one with the least id where there are several."""
    live = articles.where(F.col("deleted_at").isNull()).groupBy(F.col("document_id").alias("act_id"), F.col("number").alias("article")).agg(F.min("article_id").alias("cited_id"))
    return cited.join(live, ["act_id", "article"], "left")


def citation_plan(texts: DataFrame, acts: DataFrame, articles: DataFrame) -> DataFrame:
    """One row for each reference in each text: (document_id, raw, cited_id); cited_id is null where nothing resolves it.

    texts: (document_id, content); acts: (act_id, title).  The act is the one with the longest suffix that the reference's
    label starts with, the article is looked up by its number; references to codes stay unresolved.
    """
    found = texts.where(F.coalesce("content", F.lit("")) != "").select("document_id", F.posexplode(citations(F.col("content"))).alias("pos", "c"))
    rows = found.select("document_id", "pos", F.col("c.raw").alias("raw"), F.col("c.label").alias("label"), F.col("c.article").alias("article"))
    names = acts.select("act_id", act_suffix(F.col("title")).alias("suffix"))
    named = longest_prefix(rows.where((F.col("label") != "") & (F.col("article") != "")), "label", names, "suffix", "act_id")
    resolved = cited_articles(named, articles).select("document_id", "pos", "raw", "cited_id")
    rest = rows.where(~F.coalesce((F.col("label") != "") & (F.col("article") != ""), F.lit(False))).select("document_id", "pos", "raw", F.lit(None).cast(articles.schema["article_id"].dataType).alias("cited_id"))
    return resolved.unionByName(rest)


def plan_counts(plan: DataFrame, texts: DataFrame) -> DataFrame:
    """Resolved and unresolved references, and texts without content, in one row."""
    counts = plan.agg(F.count("cited_id").alias("n_resolved"), F.count_if(F.col("cited_id").isNull()).alias("n_unresolved"))
    blank = texts.agg(F.count_if(F.coalesce("content", F.lit("")) == "").alias("n_without_text"))
    return counts.join(blank)


def decision_articles(decisions: DataFrame, stored: DataFrame) -> DataFrame:
    """Decisions that aren't stored yet, by their key: structuring twice adds nothing.  Of equal keys the first by id counts."""
    first = Window.partitionBy("document_key").orderBy("id")
    return decisions.withColumn("__r", F.row_number().over(first)).where("__r = 1").drop("__r").join(stored.select("document_key"), "document_key", "left_anti")
