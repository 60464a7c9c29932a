"""Additive promotion of documents from one store to another: verdicts, journals to create, guarded dry runs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Unique keys of a document in the order in which a collision is reported.
UNIQUE_KEYS = ["slug", "document_key", "stock_code", "reference_nor"]


def push_verdicts(docs: DataFrame, target: DataFrame) -> DataFrame:
    """Verdict of each candidate: push, or the first reason against it.

    docs: id, the unique keys, checksums array<string>.  target: (key_kind, key_value) with the kinds id, checksum and the
    unique keys.  A checksum that several candidates share proves nothing: one source file may hold many acts.
    """
    target = target.distinct()
    of = lambda kind, name: target.where(F.col("key_kind") == kind).select(F.col("key_value").alias(name), F.lit(True).alias(f"__{kind}"))
    sums = docs.select("id", F.explode(F.array_distinct("checksums")).alias("checksum"))
    alone = sums.withColumn("__n", F.count("*").over(Window.partitionBy("checksum"))).where("__n = 1")
    there = alone.join(of("checksum", "checksum"), "checksum", "left_semi").select("id").distinct().withColumn("__sum", F.lit(True))
    out = docs.join(of("id", "id"), "id", "left").join(there, "id", "left")
    reason = F.when(F.col("__id"), "already_pushed").when(F.col("__sum"), "source_in_target")
    for k in UNIQUE_KEYS:
        out = out.join(of(k, k), k, "left")
        reason = reason.when(F.col(f"__{k}") & (F.col(k) != ""), f"collision_{k}")
    return out.select(*docs.columns, F.coalesce(reason, F.lit("push")).alias("verdict"))


def journals_needed(pushed: DataFrame, journals: DataFrame, target_ids: DataFrame, target_journals: DataFrame) -> DataFrame:
    """For each journal that pushed documents need and the target lacks by id: create, or the target's own of that date and number."""
    need = pushed.where("journal_id is not null").select(F.col("journal_id").alias("id")).distinct().join(target_ids.select("id"), "id", "left_anti")
    out = need.join(journals, "id", "left").join(target_journals.select(F.col("id").alias("target_id"), "publication_date", "number"), ["publication_date", "number"], "left")
    verdict = F.when(F.col("publication_date").isNull(), "unknown").when(F.col("target_id").isNotNull(), "remap").otherwise("create")
    return out.select("id", "target_id", verdict.alias("verdict"))


def limit_plan(plan: DataFrame, n: int, *order: str) -> DataFrame:
    """The first n documents of a plan (the limit is the feature: a trial run)."""
    return plan.where("verdict = 'push'").orderBy(*order).limit(n)


def dependents(limited: DataFrame, journals: DataFrame) -> DataFrame:
    """Journals that the limited plan still needs."""
    return journals.join(limited.select(F.col("journal_id").alias("id")), "id", "left_semi")


def by_keys(docs: DataFrame, wanted: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """(documents of the wanted keys, wanted keys that no document has)."""
    return docs.join(wanted, key, "left_semi"), wanted.join(docs.select(key), key, "left_anti")


def dry_run(docs: DataFrame, tables: dict[str, DataFrame], key: str) -> DataFrame:
    """Rows that each table would get for each document, 0 where none: one grouped pass a table."""
    counts = None
    for name, df in tables.items():
        one = df.groupBy(key).agg(F.count("*").alias("n")).withColumn("table_name", F.lit(name))
        counts = one if counts is None else counts.unionByName(one)
    wide = counts.groupBy(key).pivot("table_name", list(tables)).agg(F.first("n"))
    return docs.select(key).join(wide, key, "left").fillna(0, subset=list(tables))


def flags_of_documents(flags: DataFrame, articles: DataFrame) -> DataFrame:
    """Distinct flags of each document, its own and those of its articles."""
    own = flags.where("document_id is not null").select("document_id", "flag_id")
    inner = flags.join(articles.select("article_id", F.col("document_id").alias("__d")), "article_id").select(F.col("__d").alias("document_id"), "flag_id")
    return own.unionByName(inner).groupBy("document_id").agg(F.countDistinct("flag_id").alias("n_flags"))


def copy_columns(source: DataFrame, target: DataFrame, without: tuple[str, ...] = ()) -> DataFrame:
    """The columns that both sides have, in the target's order."""
    return source.select(*[c for c in target.columns if c in source.columns and c not in without])


def remap(df: DataFrame, column: str, mapping: DataFrame) -> DataFrame:
    """Replace ids by a mapping (old, new); ids without one stay."""
    m = mapping.select(F.col("old").alias(column), F.col("new").alias("__new"))
    return df.join(m, column, "left").withColumn(column, F.coalesce("__new", F.col(column))).drop("__new")


def longest_prefix(df: DataFrame, label: str, names: DataFrame, name: str, ident: str) -> DataFrame:
    """The longest name that each label starts with, letters' case aside.

    Names and label heads meet in an equi-join on the prefix: a label is cut to each length up to its own that some name has,
    which a join with the table of lengths tells, so nothing is compared all against all and no length is left out.
    """
    lengths = names.select(F.length(name).alias("__len")).where("__len > 0").distinct()
    cut = df.select(label).distinct().withColumn("__len", F.explode(F.sequence(F.lit(1), F.greatest(F.lit(1), F.length(label)))))
    cut = cut.where(F.length(label) >= F.col("__len")).join(lengths, "__len", "left_semi")
    cut = cut.withColumn("__head", F.expr(f"lower(substring({label}, 1, __len))"))
    keyed = names.select(F.lower(name).alias("__head"), F.col(ident)).groupBy("__head").agg(F.min(ident).alias(ident))
    hit = cut.join(keyed, "__head").groupBy(label).agg(F.max_by(ident, "__len").alias(ident))
    return df.join(hit, label, "left")


def known_content(df: DataFrame, sha: str, *sources: tuple[str, DataFrame]) -> DataFrame:
    """Owner of each content by the first source, in order, that knows its checksum: ``owner`` and ``known_from``."""
    out, owners, names = df, [], []
    for i, (name, rows) in enumerate(sources):
        one = rows.groupBy(sha).agg(F.min("owner").alias(f"__o{i}"))
        out = out.join(one, sha, "left")
        owners.append(F.col(f"__o{i}"))
        names.append(F.when(F.col(f"__o{i}").isNotNull(), name))
    return out.select(*df.columns, F.coalesce(*owners).alias("owner"), F.coalesce(*names).alias("known_from"))


def page_of(df: DataFrame, page: int, per_page: int, *order: Column, most: int = 100) -> DataFrame:
    """One page of a list with the number of pages (pagination is the feature)."""
    per_page = max(1, min(per_page, most))
    total = df.agg(F.count("*").alias("total")).select("total", F.ceil(F.col("total") / per_page).alias("pages"))
    return df.orderBy(*order).offset((max(page, 1) - 1) * per_page).limit(per_page).crossJoin(F.broadcast(total))
