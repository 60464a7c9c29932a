"""Duplicate documents by administrative identity: clusters, content signals, tiers, and what to keep."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .least import least_jaccard, least_similarity

#: Limits of the tiers, characters compared, and the rank of a curation status.
JACCARD, SIMILARITY, SAMPLE = 0.8, 0.85, 20_000
RANKS = {"published": 3, "validated": 2, "review": 1, "draft": 0, "parsed": 0}


def content_hash(articles: DataFrame, key: str, number: str, content: str, order: str) -> DataFrame:
    """SHA-256 of a document's articles in display order; and the set of its article numbers."""
    part = F.concat(F.coalesce(number, F.lit("")), F.lit("␟"), F.coalesce(content, F.lit("")))
    rows = articles.groupBy(key).agg(F.array_sort(F.collect_list(F.struct(F.col(order).alias("o"), part.alias("p")))).alias("l"), F.array_sort(F.collect_set(number)).alias("numbers"), F.count("*").alias("n_articles"))
    return rows.select(key, F.sha2(F.array_join(F.transform("l", lambda x: x["p"]), "␞"), 256).alias("content_hash"), "numbers", "n_articles")


def clusters(docs: DataFrame, *keys: str) -> DataFrame:
    """Documents that share all keys (none of them null) with at least one other."""
    w = Window.partitionBy(*keys)
    known = F.lit(True)
    for k in keys:
        known = known & F.col(k).isNotNull()
    return docs.where(known).withColumn("n_in_cluster", F.count("*").over(w)).where("n_in_cluster > 1")


def pair_counts(docs: DataFrame, ident: str, *keys: str) -> DataFrame:
    """Pairs (i before j) inside a cluster, counted: rows of one identifier are no pair."""
    known = F.col(ident).isNotNull()
    for k in keys:
        known = known & F.col(k).isNotNull()
    rows = docs.where(known).groupBy(*keys, ident).agg(F.count("*").alias("c"))
    return rows.groupBy(*keys).agg(F.expr("(sum(c) * sum(c) - sum(c * c)) div 2").alias("n_pairs")).where("n_pairs > 0")


def assess(members: DataFrame, ident: str, keys: list[str], separator: str | None = None) -> DataFrame:
    """One row for each cluster: signals, tier, warnings, and the document to keep (null: a person decides).

    members: ident, keys, content_hash, numbers, n_articles, sample, journal_id, role, status, flags_blocking, created_at.
    numbers: arrays, or with a separator texts that it parts.  All pairs of documents count, the one of lesser ident first; equal contents
    are compared once in either order that their documents stand in.
    """
    sample = F.coalesce(F.substring("sample", 1, SAMPLE), F.lit(""))
    pairs = least_jaccard(members, keys, ident, "numbers", separator).withColumnRenamed("least", "min_jaccard")
    alike = least_similarity(members.select(*keys, ident, sample.alias("sample")), keys, ident, "sample").withColumnRenamed("least", "min_similarity")
    pairs = pairs.join(alike, keys, "full")
    rank = F.lit(-1)
    for status, r in RANKS.items():
        rank = F.when(F.col("status") == status, r).otherwise(rank)
    routed = F.col("journal_id").isNotNull()
    best = F.struct(rank.alias("r"), routed.cast("int").alias("j"), F.col("n_articles").alias("n"), (-F.col("flags_blocking")).alias("f"), (-F.unix_micros(F.col("created_at").cast("timestamp"))).alias("t"))
    one = members.groupBy(*keys).agg(
        F.count("*").alias("n_docs"),
        F.countDistinct("content_hash").alias("n_hashes"),
        F.count("content_hash").alias("n_hashed"),
        F.countDistinct("n_articles").alias("n_counts"),
        F.min("n_articles").alias("least_articles"),
        F.sum(routed.cast("int")).alias("n_routed"),
        F.countDistinct("journal_id").alias("n_journals"),
        F.countDistinct("role").alias("n_roles"),
        F.sum((F.col("status") == "published").cast("int")).alias("n_published"),
        F.max(F.when(F.col("status") == "published", F.col(ident))).alias("published"),
        F.max_by(ident, best).alias("best"),
    )
    out = one.join(pairs, keys)
    exact = (F.col("n_hashes") == 1) & (F.col("n_hashed") == F.col("n_docs"))
    single = (F.col("n_routed") == 1) & (F.col("n_docs") > 1)
    equal = (F.col("n_counts") == 1) & (F.col("least_articles") > 0)
    strong = equal & (F.col("min_jaccard") >= JACCARD) & (F.col("min_similarity") >= SIMILARITY)
    tier = F.when(exact | single, 1).when(strong, 2).otherwise(3)
    warn = F.array(F.when(F.col("n_published") > 1, "several_published"), F.when(F.col("n_roles") > 1, "roles_differ"), F.when(F.col("n_journals") > 1, "journals_differ"))
    keep = F.when(F.col("n_published") == 1, F.col("published")).when((F.col("n_published") > 1) | (tier == 3), None).otherwise(F.col("best"))
    return out.select(*keys, "n_docs", exact.alias("exact"), F.round("min_jaccard", 3).alias("min_jaccard"), F.round("min_similarity", 3).alias("min_similarity"), tier.alias("tier"), F.filter(warn, lambda x: x.isNotNull()).alias("warnings"), keep.alias("keep"))
