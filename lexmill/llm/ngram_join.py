"""N-gram Jaccard join of documents: connected groups of texts whose 5-word shingle sets overlap by 0.75 or more.

Candidates come from token-combination prefixes (see ``shingle_join``).  Texts with equal sets collapse
before the join.  Only the groups are asked for, so pairs inside a group that is already connected are never compared:
leaders first, then leaders with leaders, then what the metric leaves open.

Defined results: null and empty texts, and texts without words, have an empty set and link with nothing; repeated rows
and repeated doc_ids are rows of their own; texts of any length are worked on whole, their sets compared exactly; ties of rarity are
broken by the shingle's hash, the same way for all sets; an empty table gives an empty result; columns other than doc_id and
text are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .shingle_join import ShingleJoin


def ngram_groups(spark: SparkSession, docs: DataFrame, percent: int = 75, width: int = 5) -> DataFrame:
    """doc_id, n_shingles, component_id (smallest doc_id reachable by links, itself included)."""
    rows = docs.select(F.col("doc_id").cast("long").alias("row"), F.col("text").cast("string").alias("text"))
    join = ShingleJoin(spark, rows, lines=False, percent=percent, width=width, extra=4)
    scratch = join.scratch
    all_units = join.count().select("row", "n", "sig")
    sets = all_units.where("n > 0 and row is not null").groupBy("sig").agg(F.min("row").alias("ord"), F.first("n").alias("n"))
    sets = scratch.keep(sets, "sets")
    members = join.enough(join.lists(), sets)
    join.sets(members.select("sig", F.col("ord").alias("row")).distinct().withColumn("line", F.lit(0)))
    comp = join.groups(members)

    # smallest document of each group of sets, then of each document
    named = sets.join(comp.select(F.col("id").alias("sig"), "component"), "sig", "left").withColumn("component", F.coalesce("component", "sig"))
    least = named.groupBy("component").agg(F.min("ord").alias("component_id"))
    named = named.join(least, "component").select("sig", "component_id")
    out = all_units.join(named, "sig", "left")
    own = F.when((F.col("n") > 0) & F.col("row").isNotNull(), F.col("component_id")).otherwise(F.col("row"))
    return out.select(F.col("row").alias("doc_id"), F.col("n").cast("long").alias("n_shingles"), own.alias("component_id"))
