"""Diffs, merges and guarded plans between two states of a table."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T


def content_diff(proposed: DataFrame, live: DataFrame, key: str, content: str, order: str) -> DataFrame:
    """added, removed, changed or unchanged for each number; repeated numbers compare as ordered lists, white space aside."""
    squeeze = F.trim(F.regexp_replace(F.coalesce(content, F.lit("")), r"\s+", " "))
    side = lambda df, name: df.groupBy(key).agg(F.transform(F.array_sort(F.collect_list(F.struct(F.col(order).alias("o"), squeeze.alias("c")))), lambda x: x["c"]).alias(name))
    both = side(proposed, "__new").join(side(live, "__old"), key, "full_outer")
    status = F.when(F.col("__old").isNull(), "added").when(F.col("__new").isNull(), "removed").when(F.col("__new") == F.col("__old"), "unchanged").otherwise("changed")
    return both.select(key, status.alias("status"), F.coalesce(F.size("__new"), F.lit(0)).alias("n_new"), F.coalesce(F.size("__old"), F.lit(0)).alias("n_old"))


def schema_drift(expected: DataFrame, actual: DataFrame, most: int = 20) -> DataFrame:
    """What differs between (table_name, column_name, nullable) lists, what endangers writes first; a report of ``most`` rows."""
    tables = actual.select("table_name").distinct().withColumn("__there", F.lit(True))
    e = expected.join(tables, "table_name", "left")
    missing_table = e.where("__there is null").select("table_name", F.lit(None).cast("string").alias("column_name"), F.lit("missing_table").alias("kind"), F.lit(0).alias("rank")).distinct()
    cols = actual.select("table_name", "column_name", F.col("nullable").alias("__n"))
    j = e.where("__there").join(cols, ["table_name", "column_name"], "left")
    missing = j.where("__n is null").select("table_name", "column_name", F.lit("missing_column").alias("kind"), F.lit(1).alias("rank"))
    differs = j.where("__n is not null and __n <> nullable").select("table_name", "column_name", F.lit("nullability").alias("kind"), F.lit(2).alias("rank"))
    return missing_table.unionByName(missing).unionByName(differs).orderBy("rank", "table_name", "column_name").limit(most)


def upsert_new(target: DataFrame, rows: DataFrame, keys: list[str]) -> DataFrame:
    """Rows that an insert would add: keys that the target doesn't hold, one row for each."""
    return rows.dropDuplicates(keys).join(target.select(*keys), keys, "left_anti")


def merge_rows(target: DataFrame, rows: DataFrame, key: str) -> DataFrame:
    """Keep-last merge: a row of ``rows`` replaces that of its key."""
    return target.join(rows.select(key), key, "left_anti").unionByName(rows)


def fill_null(df: DataFrame, column: str, value: Column) -> DataFrame:
    return df.withColumn(column, F.coalesce(F.col(column), value))


def soft_delete(df: DataFrame, cond: Column, at: Column, column: str = "deleted_at") -> DataFrame:
    """Mark live rows as deleted with one shared time."""
    return df.withColumn(column, F.when(F.col(column).isNull() & cond, at).otherwise(F.col(column)))


def restore(df: DataFrame, cond: Column, at: Column, column: str = "deleted_at") -> DataFrame:
    """Bring back only the rows that carry exactly that time."""
    return df.withColumn(column, F.when(cond & (F.col(column) == at), None).otherwise(F.col(column)))


def live(df: DataFrame, column: str = "deleted_at") -> DataFrame:
    return df.where(F.col(column).isNull())


def merge_maps(left: Column, right: Column) -> Column:
    """Shallow merge; the right side wins."""
    return F.map_concat(F.map_filter(left, lambda k, v: ~F.array_contains(F.map_keys(right), k)), right)


def expected_count(found: DataFrame, listed: DataFrame, key: str) -> DataFrame:
    """(key, problem): listed keys that weren't found, and found keys that weren't listed."""
    missing = listed.select(key).join(found.select(key), key, "left_anti").withColumn("problem", F.lit("missing"))
    extra = found.select(key).join(listed.select(key), key, "left_anti").withColumn("problem", F.lit("extra"))
    return missing.unionByName(extra)


def timelines(base: DataFrame, changes: DataFrame, key: str, start: str, content: str) -> DataFrame:
    """Version intervals of each article: [start, next start), the last one open."""
    rows = base.select(key, start, content).unionByName(changes.select(key, start, content))
    return rows.withColumn("valid_to", F.lead(start).over(Window.partitionBy(key).orderBy(start)))


def current_versions(versions: DataFrame, end: str = "valid_to") -> DataFrame:
    return versions.where(F.col(end).isNull())


def latest_versions(versions: DataFrame, key: str, start: str, *ties: str) -> DataFrame:
    """The version with the greatest lower bound; versions without one come last."""
    w = Window.partitionBy(key).orderBy(F.col(start).desc_nulls_last(), *ties)
    return versions.withColumn("__r", F.row_number().over(w)).where("__r = 1").drop("__r")


@F.pandas_udf(T.ArrayType(T.StructType([T.StructField(k, T.StringType()) for k in ("tag", "a", "b")])))
def word_changes(a: pd.Series, b: pd.Series) -> pd.Series:
    """Segments where two readings differ, word by word."""
    from difflib import SequenceMatcher

    def one(x: str, y: str) -> list:
        x, y = (x or "").split(), (y or "").split()
        return [(tag, " ".join(x[i:j]), " ".join(y[k:m])) for tag, i, j, k, m in SequenceMatcher(None, x, y, autojunk=False).get_opcodes() if tag != "equal"]

    return pd.Series([one(x, y) for x, y in zip(a, b, strict=True)])


@F.pandas_udf(T.StructType([T.StructField("text", T.StringType()), T.StructField("missing", T.ArrayType(T.StringType()))]))
def apply_replacements(texts: pd.Series, changes: pd.Series) -> pd.DataFrame:
    """Official replacements (array of struct(old, new)) applied in turn, each from where the last one ended."""
    out, missing = [], []
    for text, todo in zip(texts, changes, strict=True):
        text, at, lost = text or "", 0, []
        for c in todo if todo is not None else []:
            k = text.find(c["old"], at)
            if k < 0:
                lost.append(c["old"])
            else:
                text, at = text[:k] + c["new"] + text[k + len(c["old"]) :], k + len(c["new"])
        out.append(text)
        missing.append(lost)
    return pd.DataFrame({"text": out, "missing": missing})
