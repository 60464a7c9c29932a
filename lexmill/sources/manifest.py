"""JSON-lines manifests of source files: read, look up, merge, save, and export."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

ENTRY = (
    "id string, fichier string, sha256 string, size_bytes long, type_source string, source_url string, fetched_at string, jo_annee int, jo_numero string, jo_date string, "
    "statut string, retroactif boolean, variantes_multiples array<string>, titre string, evenements array<struct<quand:string,quoi:string,par:string,detail:string>>"
)
#: Statuses that still wait for work, in order.
STATUSES = ["telecharge", "parse", "structure"]


def read(spark: SparkSession, path: str) -> DataFrame:
    """Entries of a manifest with their file; blank lines are skipped and the last line of an id counts."""
    lines = spark.read.text(path).select("value", F.col("_metadata.file_path").alias("manifest"), F.monotonically_increasing_id().alias("__n"))
    rows = lines.where(F.trim("value") != "").select("manifest", "__n", F.from_json("value", ENTRY).alias("e")).select("manifest", "__n", "e.*")
    return keep_last(rows, ["manifest", "id"], "__n").drop("__n")


def keep_last(rows: DataFrame, keys: list[str], order: str) -> DataFrame:
    w = Window.partitionBy(*keys).orderBy(F.col(order).desc())
    return rows.withColumn("__r", F.row_number().over(w)).where("__r = 1").drop("__r")


def upsert(entries: DataFrame, new: DataFrame) -> DataFrame:
    return entries.join(new.select("id"), "id", "left_anti").unionByName(new, allowMissingColumns=True)


def save(entries: DataFrame, path: str) -> None:
    """Sorted by id, nulls left out; the folder appears as a whole when the job commits."""
    entries.orderBy("id").write.mode("overwrite").option("ignoreNullFields", "true").json(path)


def checksum_index(entries: DataFrame, order: str = "manifest") -> DataFrame:
    """sha256 -> the first id in (file, id) order."""
    return entries.where("sha256 is not null").groupBy("sha256").agg(F.min_by("id", F.struct(F.col(order), F.col("id"))).alias("id"))


def files(spark: SparkSession, path: str) -> DataFrame:
    """Files below a folder with their SHA-256."""
    raw = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    return raw.select("path", "length", F.sha2("content", 256).alias("sha256"))


def backfill(found: DataFrame, entries: DataFrame) -> DataFrame:
    """Verdict of each file (id, sha256): existing, changed, duplicate (content known by another id), or new."""
    own = entries.select("id", F.col("sha256").alias("__sha"))
    other = checksum_index(entries, "id").select("sha256", F.col("id").alias("__same"))
    out = found.join(own, "id", "left").join(other, "sha256", "left")
    verdict = F.when(F.col("__sha") == F.col("sha256"), "existing").when(F.col("__sha").isNotNull(), "changed").when(F.col("__same").isNotNull(), "duplicate").otherwise("new")
    return out.select(*found.columns, verdict.alias("verdict"))


def acquire(offered: DataFrame, entries: DataFrame) -> DataFrame:
    """Offers (id, url, sha256, year, number) that nothing holds yet by id, url or content."""
    out = offered.join(entries.select("id"), "id", "left_anti")
    out = out.join(entries.where("source_url is not null").select(F.col("source_url").alias("url")), "url", "left_anti")
    return out.join(entries.where("sha256 is not null").select("sha256"), "sha256", "left_anti")


def variants(entries: DataFrame, year: str = "jo_annee", number: str = "jo_numero", ident: str = "id") -> DataFrame:
    """Issues that several files stand for."""
    return entries.groupBy(year, number).agg(F.array_sort(F.collect_set(ident)).alias("variants")).where(F.size("variants") > 1)


def export(entries: DataFrame, path: str) -> None:
    """One folder of JSON lines for each namespace (the id up to its first /); incomplete entries are skipped."""
    good = entries.where("id is not null and sha256 is not null and fichier is not null")
    good.withColumn("namespace", F.split_part("id", F.lit("/"), F.lit(1))).write.mode("overwrite").partitionBy("namespace").option("ignoreNullFields", "true").json(path)


def links(pages: DataFrame, key: str, html: str, pattern: str, base: str) -> DataFrame:
    """Distinct absolute links of each page in order of appearance: (key, pos, url)."""
    found = pages.select(key, F.posexplode(F.regexp_extract_all(html, F.lit(pattern), 1)).alias("pos", "href"))
    url = (
        F.when(F.col("href").startswith("//"), F.concat(F.lit("https:"), "href"))
        .when(F.col("href").startswith("/"), F.concat(F.lit(base), "href"))
        .when(~F.col("href").startswith("http"), F.concat(F.lit(base + "/"), F.regexp_replace("href", r"^[./]+", "")))
        .otherwise(F.col("href"))
    )
    rows = found.withColumn("url", url)
    return rows.groupBy(key, "url").agg(F.min("pos").alias("pos")).select(key, "pos", "url")


def until_misses(rows: DataFrame, key: str, order: str, hit: str, most: int) -> DataFrame:
    """Rows of an enumeration up to where ``most`` misses in a row end it."""
    w = Window.partitionBy(key).orderBy(order)
    streak = F.sum(F.col(hit).cast("int")).over(w.rowsBetween(Window.unboundedPreceding, 0))
    rows = rows.withColumn("__hits", streak)
    run = F.count(F.when(~F.col(hit), 1)).over(Window.partitionBy(key, "__hits").orderBy(order).rowsBetween(Window.unboundedPreceding, 0))
    rows = rows.withColumn("__run", run)
    ended = F.max((F.col("__run") >= most).cast("int")).over(w.rowsBetween(Window.unboundedPreceding, -1))
    return rows.withColumn("__ended", ended).where(F.coalesce("__ended", F.lit(0)) == 0).drop("__hits", "__run", "__ended")


def chunk_offsets(chunks: DataFrame, key: str, name: str = "name", pages: str = "n_pages") -> DataFrame:
    """Order, page offset and contiguity of chunk files named ``chunk_<first>_a_<last>``.

    By name if all files of a key are named so, else in the order given with pages added up.
    """
    first, last = (F.nullif(F.regexp_extract(name, r"(?i)chunk_(\d+)_a_(\d+)\.(?:json|md)$", k), F.lit("")).cast("int") for k in (1, 2))
    rows = chunks.withColumns({"first": first, "last": last})
    rows = rows.withColumn("named", F.min(F.col("first").isNotNull()).over(Window.partitionBy(key)))
    by_name = Window.partitionBy(key).orderBy(F.when(F.col("named"), F.col("first")).otherwise(F.col("upload_no")), "upload_no")
    before = F.coalesce(F.sum(pages).over(by_name.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    was = F.lag("last").over(by_name)
    warning = F.when(~F.col("named"), None).when(F.col("first") <= was, "overlap").when(F.col("first") > was + 1, "gap")
    return rows.withColumns({"position": F.row_number().over(by_name), "offset": F.when(F.col("named"), F.col("first") - 1).otherwise(before).cast("long"), "warning": warning})


def merge_markdown(chunks: DataFrame, key: str) -> DataFrame:
    """Chunks of a document in order, each under a comment that names it."""
    part = lambda x: F.concat(F.lit("<!-- chunk "), x["name"], F.lit(" -->\n"), F.trim(x["content"]))
    return chunks.groupBy(key).agg(F.array_sort(F.collect_list(F.struct("position", "name", "content"))).alias("c")).select(key, F.array_join(F.transform("c", part), "\n\n").alias("text"))


def artefact(primary: DataFrame, legacy: DataFrame, entries: DataFrame) -> DataFrame:
    """Path of each entry's artefact: by id, else by the older base name."""
    out = entries.join(primary.select("id", F.col("path").alias("__p")), "id", "left").join(legacy.select("basename", F.col("path").alias("__l")), "basename", "left")
    return out.select("id", F.coalesce("__p", "__l").alias("path"))
