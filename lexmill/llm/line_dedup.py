"""Line dedup by an exact set-similarity join.

A line's tokens are its distinct 5-word shingles (a shorter line is one shingle), ordered by rarity over the whole
corpus; prefix, positional and length filters give candidates, exact Jaccard >= 0.75 decides (see
``shingle_join``).  Matches join lines to groups, equal lines among them; of a group the first line in (doc_id, line
number) order stays and all later ones are removed.  Lines without words stay.

Defined results: a null text has no line and stays null; an empty text is one empty line; repeated doc_ids are ordered by
the hash of their text and then taken as one document's copies, so that of repeated rows the first keeps its lines; rows
without doc_id come after all others; a very long text is worked on line by line in pieces of bounded size, its lines are
all compared; ties don't arise, as reading order is total; columns of the input named like ours (``row``, ``sig`` and the like) pass
through untouched, but for n_lines and n_removed, which are written anew; an empty table gives an empty result.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .shingle_join import ShingleJoin

#: Rows whose texts a task rewrites at a time.
SLICE = 500


def removed_lines(spark: SparkSession, docs: DataFrame, percent: int = 75, width: int = 5) -> DataFrame:
    """docs: (row long, unique and ascending in reading order; text) -> (row, line) of every line to remove."""
    join = ShingleJoin(spark, docs, lines=True, percent=percent, width=width, extra=8)
    scratch = join.scratch
    lines = join.count().where("n > 0")
    first_row = F.when(F.col("fresh"), F.col("row"))  # of its set, one line of a row is fresh: the first
    sets = lines.groupBy("sig").agg(F.min("row").alias("ord"), F.min_by("line", first_row).alias("line"), F.count("*").alias("copies"), F.first("n").alias("n"))
    sets = scratch.keep(sets, "sets")
    members = join.enough(join.lists(), sets)
    asked = members.select("sig").distinct()
    join.sets(sets.join(asked, "sig", "left_semi").select("sig", F.col("ord").alias("row"), "line"))
    comp = join.groups(members).withColumnRenamed("id", "sig")
    comp = comp.unionByName(comp.select(F.col("component").alias("sig"), "component")).distinct()
    # only the first line of a group of several sets, or of several equal lines, stays
    named = sets.join(comp.hint("shuffle_hash"), "sig", "left").where("component is not null or copies > 1").withColumn("component", F.coalesce("component", "sig"))
    firsts = named.groupBy("component").agg(F.min(F.struct("ord", "line")).alias("first"))
    named = named.join(firsts, "component").select("sig", F.col("first.ord").alias("first_row"), F.col("first.line").alias("first_line"))
    return lines.join(named.hint("shuffle_hash"), "sig").where("row <> first_row or line <> first_line").select("row", "line")


def line_dedup(spark: SparkSession, docs: DataFrame, percent: int = 75, width: int = 5) -> DataFrame:
    """The input's columns with ``text`` rewritten, plus n_lines, n_removed."""
    from .common import Scratch, hidden

    scratch = Scratch(spark, "line-rows")
    named = docs.drop("n_lines", "n_removed")
    inner, own = hidden(named, "doc_id", "text")
    numbered, rows = with_rows(scratch, inner)
    gone = removed_lines(spark, rows, percent, width)
    by_row = gone.groupBy("row").agg(F.collect_list("line").alias("__gone"))
    joined = numbered.join(by_row.hint("shuffle_hash"), "row", "left").drop("row")
    at = own.index("text")

    def cut(batches):
        for b in (whole.slice(i, SLICE) for whole in batches for i in range(0, whole.num_rows, SLICE)):
            texts, n, m = [], [], []
            for text, drop in zip(b.column(at).to_pylist(), b.column(len(own)).to_pylist(), strict=True):
                if text is None:
                    texts.append(None)
                    n.append(0)
                    m.append(0)
                    continue
                lines = text.split("\n")
                drop = set(drop or ())
                texts.append("\n".join([x for i, x in enumerate(lines) if i not in drop]) if drop else text)
                n.append(len(lines))
                m.append(len(drop))
            cols = list(b.columns[: len(own)])
            cols[at] = pa.array(texts, pa.string())
            yield pa.RecordBatch.from_arrays([*cols, pa.array(n, pa.int64()), pa.array(m, pa.int64())], [*own, "n_lines", "n_removed"])

    schema = inner.withColumn("text", F.col("text").cast("string")).schema.add("n_lines", "long").add("n_removed", "long")
    out = joined.select(*[F.col(c).cast("string") if c == "text" else c for c in own], "__gone").mapInArrow(cut, schema)
    return out.toDF(*named.columns, "n_lines", "n_removed")


def with_rows(scratch, docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Documents with ``row``, their place in reading order.  doc_ids serve as they are if they are unique and there."""
    ids = docs.select(F.col("doc_id").cast("long").alias("d"))
    facts = ids.agg(F.count("*").alias("n"), F.count("d").alias("there")).first()
    twice = ids.where("d is not null").groupBy("d").count().where("count > 1").limit(1).count()
    if facts["n"] == facts["there"] and not twice:
        numbered = docs.withColumn("row", F.col("doc_id").cast("long"))
        return numbered, numbered.select("row", F.col("text").cast("string").alias("text"))
    # places by a range sort: partition sizes, then counts within
    hashed = docs.withColumn("__d", F.col("doc_id").cast("long")).withColumn("__h", F.xxhash64(F.col("text").cast("string")))
    ranged = hashed.withColumn("__none", F.col("__d").isNull()).repartitionByRange("__none", "__d", "__h").sortWithinPartitions("__none", "__d", "__h")
    ranged = scratch.keep(ranged.withColumn("__p", F.spark_partition_id()).withColumn("__i", F.monotonically_increasing_id()), "ranged")
    sizes = ranged.groupBy("__p").agg(F.count("*").alias("n"))
    before = Window.orderBy("__p").rowsBetween(Window.unboundedPreceding, -1)
    base = sizes.select("__p", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("__base"))  # one row for each partition
    inside = F.row_number().over(Window.partitionBy("__p").orderBy("__i"))
    placed = ranged.withColumn("__k", inside).join(F.broadcast(base), "__p").withColumn("row", (F.col("__base") + F.col("__k") - 1).cast("long"))
    placed = scratch.keep(placed.drop("__p", "__i", "__k", "__base", "__none", "__d", "__h"), "placed")
    return placed, placed.select("row", F.col("text").cast("string").alias("text"))


def digest(column):
    """Lowercase hex SHA-256 of a text."""
    return F.sha2(F.coalesce(column, F.lit("")), 256)

