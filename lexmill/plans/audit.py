"""Audits and upkeep of a store: small joins, counts by category, dangling references, schema checks, fills, snapshots, copies."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Fields of a metadata record and their types; the first must be there.
RECORD = "nature string, numero string, date_signature string, date_publication string, autorite string, visas array<string>, preambule string, articles array<struct<numero: string, contenu: string, page: int>>, annexes array<string>, tableaux array<string>, signature string"


def protected(documents: DataFrame, articles: DataFrame, versions: DataFrame) -> DataFrame:
    """Documents that hold an editor's work: published, or with a validated version of a live article."""
    live = articles.where(F.col("deleted_at").isNull()).select("article_id", "document_id")
    validated = live.join(versions.where("validation_status = 'validated'").select("article_id"), "article_id", "left_semi").select("document_id").distinct()
    return documents.where("curation_status = 'published'").select("document_id").unionByName(validated).distinct()


def staged(runs: DataFrame, kept: DataFrame) -> DataFrame:
    """Where a new reading goes: ``staging`` for protected documents, ``live`` for all others; the rest of a decision is ``promote``
    or ``discard`` as asked."""
    out = runs.join(kept.select("document_id", F.lit(True).alias("__kept")), "document_id", "left")
    held = F.coalesce("__kept", F.lit(False))
    action = F.when(~held, "live").when(F.col("asked").isin("promote", "discard"), F.col("asked")).otherwise("staging")
    return out.withColumn("action", action).drop("__kept")


def reap(rows: DataFrame, status: str, stuck: list[str], to: str = "failed", note: str | None = None) -> DataFrame:
    """Rows left in a passing state by a restart fail, with a note in ``meta`` (map) where there is one."""
    is_stuck = F.col(status).isin(*stuck)
    if note is not None:
        none = F.create_map().cast("map<string,string>")
        merged = F.map_concat(F.map_filter(F.coalesce("meta", none), lambda k, v: k != "error"), F.create_map(F.lit("error"), F.lit(note)))
        rows = rows.withColumn("meta", F.when(is_stuck, merged).otherwise(F.col("meta")))
    return rows.withColumn(status, F.when(is_stuck, to).otherwise(F.col(status)))


def tag_names(tags: DataFrame, links: DataFrame, key: str) -> DataFrame:
    """Names of the tags of each row, in order, in one text."""
    return links.join(tags, "tag_id").groupBy(key).agg(F.array_join(F.array_sort(F.collect_set("name")), ", ").alias("tags"))


def by_json_field(rows: DataFrame, column: str, path: str, wanted: DataFrame, value: str) -> DataFrame:
    """Rows whose JSON holds a wanted value under a path."""
    return rows.withColumn(value, F.get_json_object(column, path)).join(wanted.select(value).distinct(), value, "left_semi")


def delete_in(rows: DataFrame, listed: DataFrame, key: str) -> DataFrame:
    """Rows whose key isn't listed (null keys stay, as SQL's IN would have it)."""
    return rows.join(listed.select(key).distinct(), key, "left_anti")


def membership(rows: DataFrame, key: str, sets: dict[str, DataFrame]) -> DataFrame:
    """A flag for each set that holds the row's key."""
    out = rows
    for name, keys in sets.items():
        out = out.join(keys.select(key).distinct().withColumn(f"__{name}", F.lit(True)), key, "left").withColumn(name, F.coalesce(f"__{name}", F.lit(False))).drop(f"__{name}")
    return out


def counts_by(rows: DataFrame, category: str, status: str, values: list) -> DataFrame:
    """Rows of each category by status, a column for each value."""
    return rows.groupBy(category).pivot(status, values).agg(F.count(F.lit(1))).fillna(0)


def dangling(references: DataFrame, documents: DataFrame, articles: DataFrame) -> DataFrame:
    """The document that each reference (``ref``: id of a document or of an article) belongs to; null where there is none."""
    owners = documents.select(F.col("document_id").alias("ref"), F.col("document_id").alias("owner"))
    owners = owners.unionByName(articles.select(F.col("article_id").alias("ref"), F.col("document_id").alias("owner")))
    return references.join(owners.groupBy("ref").agg(F.min("owner").alias("owner")), "ref", "left")


def shared_sources(media: DataFrame, source: str, key: str, least: int = 2) -> DataFrame:
    """Sources that several documents were made of, with those documents."""
    return media.groupBy(source).agg(F.array_sort(F.collect_set(key)).alias("documents")).where(F.size("documents") >= least)


def validated_records(rows: DataFrame, column: str, schema: str = RECORD) -> DataFrame:
    """JSON records under a strict schema: ``record`` (null if it fails) and ``error``.

    A record fails if it isn't JSON, if a field has another type, if it holds a field that the schema lacks, or if the first field
    is missing.
    """
    types = T.StructType.fromDDL(schema)
    first = types.fieldNames()[0]
    known = F.array(*map(F.lit, types.fieldNames()))
    with_bad = T.StructType([*types.fields, T.StructField("_bad", T.StringType())])
    parsed = F.from_json(F.col(column), with_bad, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_bad"})
    keys = F.coalesce(F.json_object_keys(column), F.array().cast("array<string>"))
    out = rows.withColumns({"__r": parsed, "__unknown": F.array_except(keys, known)})
    error = F.when(F.col(column).isNull() | F.col("__r").isNull() | F.col("__r._bad").isNotNull(), "malformed")
    error = error.when(F.size("__unknown") > 0, "unknown_field").when(F.coalesce(F.col(f"__r.{first}"), F.lit("")) == "", "missing_field")
    record = F.when(error.isNull(), F.struct(*[F.col(f"__r.{c}").alias(c) for c in types.fieldNames()]))
    return out.withColumns({"error": error, "record": record}).drop("__r", "__unknown")


def fill(stored: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """Upsert that only fills: a stored value stays, a missing one comes from the new row; new keys are added."""
    own = [c for c in stored.columns if c != key]
    other = new.select(key, *[F.col(c).alias(f"__{c}") for c in own if c in new.columns])
    both = stored.join(other, key, "full")
    return both.select(key, *[F.coalesce(F.col(c), F.col(f"__{c}")).alias(c) if c in new.columns else F.col(c) for c in own])


def snapshot(tables: dict[str, Column | tuple[DataFrame, str]]) -> DataFrame:
    """Key sets of a target in long form: (key_kind, key_value), each value once, nulls left out."""
    out = None
    for kind, (rows, column) in tables.items():
        one = rows.where(F.col(column).isNotNull()).select(F.lit(kind).alias("key_kind"), F.col(column).cast("string").alias("key_value")).distinct()
        out = one if out is None else out.unionByName(one)
    return out


def copy_verdicts(objects: DataFrame, there: DataFrame, key: str, sha: str) -> DataFrame:
    """What copying objects comes to: ``copy`` where the target lacks the key, ``present`` where it has the same bytes, else ``differs``."""
    held = there.select(key, F.col(sha).alias("__sha"))
    verdict = F.when(F.col("__sha").isNull(), "copy").when(F.col("__sha") == F.col(sha), "present").otherwise("differs")
    return objects.join(held, key, "left").withColumn("verdict", verdict).drop("__sha")


def push_order(tables: dict[str, DataFrame], documents: DataFrame, key: str) -> DataFrame:
    """Rows to append, table by table in the order of their foreign keys and document by document: (key, step, table_name, n_rows)."""
    out = None
    for step, (name, rows) in enumerate(tables.items()):
        one = rows.join(documents.select(key), key, "left_semi").groupBy(key).agg(F.count("*").alias("n_rows")).select(key, F.lit(step).alias("step"), F.lit(name).alias("table_name"), "n_rows")
        out = one if out is None else out.unionByName(one)
    return out


def backfill_verdicts(journals: DataFrame, documents: DataFrame) -> DataFrame:
    """What a second structuring of each journal would do: nothing read yet, done already, partly, or to do; with its counts."""
    own = documents.groupBy("journal_id").agg(F.count("*").alias("n_documents"), F.count_if(F.col("n_articles") > 0).alias("n_structured"))
    out = journals.join(own, "journal_id", "left").fillna(0, subset=["n_documents", "n_structured"])
    verdict = F.when(~F.col("has_text"), "no_text").when(F.col("n_documents") == 0, "to_do").when(F.col("n_structured") == F.col("n_documents"), "done").otherwise("partial")
    return out.withColumn("verdict", verdict)


def batch_plan(entries: DataFrame, metrics: DataFrame, excluded: list[str], methods: list[str], limit: int | None = None) -> DataFrame:
    """What a parsing run does with each entry: ``excluded`` by kind, ``done`` if its metrics fit its bytes and its artefacts are
    there, else ``process``; a limit (a trial run is the feature) takes the first entries to process by id.

    metrics: (id, source_sha256, method, has_md, has_json).
    """
    out = entries.join(metrics, "id", "left")
    artefacts = F.col("has_md") & ((F.col("method") == "native") | F.col("has_json"))
    done = F.coalesce((F.col("source_sha256") == F.col("sha256")) & F.col("method").isin(*methods) & artefacts, F.lit(False))
    out = out.withColumn("action", F.when(F.col("kind").isin(*excluded), "excluded").when(done, "done").otherwise("process"))
    if limit is None:
        return out
    first = out.where("action = 'process'").orderBy("id").limit(limit)
    return out.where("action <> 'process'").unionByName(first)


def first_and_rest(rows: DataFrame, key: str, message: str, order: str, n: int = 5) -> DataFrame:
    """The first n messages of each key and how many there are beyond: only n of a key leave a task."""
    w = Window.partitionBy(key).orderBy(order)
    first = rows.withColumn("__k", F.row_number().over(w)).where(F.col("__k") <= n).groupBy(key).agg(F.transform(F.array_sort(F.collect_list(F.struct("__k", message))), lambda x: x[message]).alias("messages"))
    total = rows.groupBy(key).agg(F.count("*").alias("__n"))
    return first.join(total, key).withColumn("n_more", F.greatest(F.lit(0), F.col("__n") - n)).drop("__n")


def write_report(rows: DataFrame, path: str) -> None:
    """A report as JSON lines, nulls kept; the folder appears as a whole when the job commits."""
    rows.write.mode("overwrite").option("ignoreNullFields", "false").json(path)
