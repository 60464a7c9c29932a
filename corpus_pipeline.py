"""From raw documents to packed training sequences.

STAGES lists (name, function); a function takes (spark, docs, sf_dir) and returns a DataFrame that is written and
read again as the next one's docs.  All but the last return the columns of ``documents``.

1. toxicity: documents predicted toxic go.
2. line_dedup: lines that repeat an earlier line go; a document left without any text goes.
3. ngram_join: of every group of similar documents the first stays.
4. suffix_dedup: strings of 400 bytes that repeat go, and passages of more than 50 words that repeat; a document left without any
   text goes.
5. packing: what is left is tokenised and packed.

Defined results: rows with a null text pass all filtering stages and pack as an end id; empty texts do, too, as nothing was
removed from them; of repeated rows the first keeps its lines, and the others go if nothing is left; rows without doc_id come last in
reading order; texts of any length are worked on whole; an empty table gives an empty result; columns other than those of
``documents`` are dropped.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexmill.llm.common import Scratch
from lexmill.llm.line_dedup import line_dedup, with_rows
from lexmill.llm.ngram_join import ngram_groups
from lexmill.llm.packing import best_fit_packing
from lexmill.llm.suffix_dedup import suffix_dedup
from lexmill.llm.toxicity import fold_of, learn, score

#: Words of a passage that goes if it repeats, however few its bytes.
PASSAGE = 51
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def _columns(df: DataFrame) -> DataFrame:
    return df.withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def _emptied(df: DataFrame) -> DataFrame:
    """Without the documents that removal left without any word."""
    return df.where((F.col("n_removed") == 0) | F.col("text").isNull() | F.col("text").rlike(r"\S"))


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = learn(spark, docs, labels.where(fold_of(F.col("doc_id").cast("long")) != 0))
    return score(docs.select(*COLUMNS), model, keep=True).where("score < 0.5").select(*COLUMNS)


def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return _columns(_emptied(line_dedup(spark, docs.select(*COLUMNS))))


def drop_similar(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    numbered, rows = with_rows(Scratch(spark, "similar-rows"), docs.select(*COLUMNS))
    groups = ngram_groups(spark, rows.withColumnRenamed("row", "doc_id"))
    gone = groups.where("doc_id <> component_id").select(F.col("doc_id").alias("row"))
    return numbered.join(gone, "row", "left_anti").select(*COLUMNS)


def drop_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return _columns(_emptied(suffix_dedup(spark, docs.select(*COLUMNS), words=PASSAGE)))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return best_fit_packing(spark, docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [("toxicity", drop_toxic), ("line_dedup", drop_lines), ("ngram_join", drop_similar), ("suffix_dedup", drop_repeats), ("packing", pack)]

#: The joins and indexes of the stages aren't SQL; tests hold the pipeline against brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    scratch = Scratch(spark, "pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = scratch.keep(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
