"""Queries of the training-data operators and, where SQL can say the same, their DuckDB texts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def _tokenizer(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .packing import best_fit_packing

    return best_fit_packing(spark, _table(spark, sf_dir, "documents"), _tokenizer("byte_bpe_50k.json"))


def op2_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .suffix_dedup import suffix_dedup

    # the contract's columns are of 400-byte strings alone; of ``text``, passages of more than 50 words go, too
    return suffix_dedup(spark, _table(spark, sf_dir, "documents"), digest=True, with_text=True, words=51)


def op3_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from .bpe import bpe_round_trip

    return bpe_round_trip(_table(spark, sf_dir, "documents"), _tokenizer("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)


def op4_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .common import Scratch
    from .token_files import read_token_files, write_token_files

    path = Scratch(spark, "token-files").path("ids")
    write_token_files(_table(spark, sf_dir, "documents"), path, _tokenizer("word_bpe_49k.json"))
    return read_token_files(spark, path)


#: Fixed values of the query's contract.
URL_RULES = [("org/", "allow"), ("example.org/es/", "block"), ("example.org/en/1", "block"), ("com/fr/", "allow"), ("com/de/", "block")]


def op5_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .url_filter import url_filter

    return url_filter(spark, _table(spark, sf_dir, "pages"), URL_RULES)


def op6_topk_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pyspark.sql import functions as F

    from .knn import voronoi_knn

    whole = F.transform(F.col("embedding").cast("array<double>"), lambda x: F.floor(x * 1024).cast("double"))
    usable = F.forall(F.col("embedding"), lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = _table(spark, sf_dir, "embeddings").where(usable).select(F.col("vec_id").alias("id"), whole.alias("v"))
    return voronoi_knn(spark, rows, rows.where("id % 100 = 0"))


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .toxicity import toxicity

    return toxicity(spark, _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op9_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .embed_dedup import embedding_dedup

    return embedding_dedup(spark, _table(spark, sf_dir, "embeddings"))


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pyspark.sql import functions as F

    from .line_dedup import digest, line_dedup

    out = line_dedup(spark, _table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select(F.col("doc_id").cast("long").alias("doc_id"), "n_lines", "n_removed", digest(F.col("text")).alias("kept_sha256"))


def op10_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .ngram_join import ngram_groups

    return ngram_groups(spark, _table(spark, sf_dir, "documents"))


QUERIES = {
    f.__name__: f
    for f in (
        op1_best_fit_packing,
        op2_suffix_dedup,
        op3_byte_bpe,
        op4_token_files,
        op5_url_filter,
        op6_topk_search,
        op7_line_dedup,
        op8_toxicity,
        op9_embedding_dedup,
        op10_ngram_join,
    )
}
#: SQL for what SQL can say on whole tables; the other operators are held against brute force in the tests.
ORACLES: dict[str, str] = {
    "op6_topk_search": """
        with v as (
            select vec_id, list_transform(embedding, lambda x: floor(1024 * x::double)) as e from embeddings
            where embedding is not null and len(embedding) > 0 and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
        ), s as (
            select q.vec_id as query_id, c.vec_id, list_inner_product(q.e, c.e)::bigint as score from v q join v c on q.vec_id <> c.vec_id where q.vec_id % 100 = 0
        )
        select query_id, rank::int as rank, vec_id, score from (select *, row_number() over (partition by query_id order by score desc, vec_id) as rank from s) where rank <= 10""",
    "op9_embedding_dedup": """
        with recursive v as (
            select vec_id, label, list_transform(embedding, lambda x: x::double) as e from embeddings
            where label is not null and embedding is not null and len(embedding) > 0 and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0 and len(list_filter(embedding, lambda x: x <> 0)) > 0
        ), links as (
            select a.vec_id as a, b.vec_id as b from v a join v b on a.label = b.label and a.vec_id <> b.vec_id where len(a.e) = len(b.e) and list_cosine_similarity(a.e, b.e) >= 0.98
        ), reach as (
            select a, b from links union select r.a, l.b from reach r join links l on l.a = r.b
        )
        select e.vec_id, (select count(*) from links where a = e.vec_id) as n_links,
            least(e.vec_id, coalesce((select min(b) from reach where a = e.vec_id), e.vec_id)) as component_id,
            e.vec_id = least(e.vec_id, coalesce((select min(b) from reach where a = e.vec_id), e.vec_id)) as kept from embeddings e""",
}
