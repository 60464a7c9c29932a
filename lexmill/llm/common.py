"""Shared plumbing of the training-data operators.

Everything an operator keeps between its stages is written as Parquet below the folder that
``spark.checkpoint.dir`` names, which driver and executors share, so a lost executor costs a re-read
and never a lost block.  Where that setting is absent, a local session (tests, notebooks) uses a folder of its own, and a
cluster a folder in its warehouse.  Results are lazy and read those tables, so they stay; the folder is the cluster's to empty.
"""

from __future__ import annotations

import gc
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_OWN: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """The shared folder of this session."""
    named = spark.sparkContext.getConf().get("spark.checkpoint.dir", None) or spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):  # a cluster: its warehouse is shared, a temporary folder isn't
        return spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_scratch"
    if "dir" not in _OWN:
        _OWN["dir"] = tempfile.mkdtemp(prefix="lexmill-")
    return _OWN["dir"]


class Scratch:
    """Written intermediate tables of one operator call."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.base = f"{shared_dir(spark)}/lexmill/{name}-{uuid.uuid4().hex[:12]}"
        self.n = 0

    def path(self, tag: str) -> str:
        self.n += 1
        return f"{self.base}/{self.n:03d}-{tag}"

    def keep(self, df: DataFrame, tag: str = "t") -> DataFrame:
        """Write ``df`` once and read it back: cuts the lineage and survives lost executors."""
        path = self.path(tag)
        schema = df.schema
        df.write.parquet(path)
        out = self.spark.read.schema(schema).parquet(path)
        out._lexmill_path = path
        return out

    def drop(self, *dfs: DataFrame) -> None:
        """Delete written tables that nothing will read again."""
        jvm = self.spark._jvm
        conf = self.spark.sparkContext._jsc.hadoopConfiguration()
        for df in dfs:
            path = jvm.org.apache.hadoop.fs.Path(df._lexmill_path)
            path.getFileSystem(conf).delete(path, True)

    def clear(self) -> None:
        """Delete all tables of a call whose result is written elsewhere; Spark drops shuffle files with the plans that are collected."""
        path = self.spark._jvm.org.apache.hadoop.fs.Path(self.base)
        path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
        gc.collect()
        self.spark._jvm.System.gc()


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions", "200"))


def hidden(docs: DataFrame, *shown: str) -> tuple[DataFrame, list[str]]:
    """``docs`` with every column but ``shown`` renamed, so that no name of ours clashes, and its names as they are then.

    The names of the second value stand in the order of ``docs.columns``.
    """
    names = [c if c in shown else f"__x{i}" for i, c in enumerate(docs.columns)]
    return docs.toDF(*names), names


def long_id(df: DataFrame, name: str) -> DataFrame:
    return df.withColumn(name, F.col(name).cast("long"))


def components(spark: SparkSession, links: DataFrame, scratch: Scratch, max_rounds: int = 60) -> DataFrame:
    """Connected components of an undirected link table (``a``, ``b`` long) -> (``id``, ``component``).

    Alternating large-star / small-star contraction: every round is two partially aggregated minima and
    two equi-joins, each round is written to the shared folder, and only two scalars reach the driver.
    Ends with every node pointing at the smallest id it can reach; nodes without links don't appear.
    """
    edges = scratch.keep(
        links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "edges"
    )

    def stamp(df: DataFrame) -> tuple:
        row = df.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first()
        return row[0], row[1]

    seen = stamp(edges)
    for _ in range(max_rounds):
        if not seen[0]:
            break
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
        large = both.where("v > u").join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        small_min = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (
            large.join(small_min, "u")
            .select(F.explode(F.array(F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e"))
            .select("e.u", "e.v")
            .where("u <> v")
            .distinct()
        )
        new = scratch.keep(small, "edges")
        scratch.drop(edges)
        edges, was, seen = new, seen, stamp(new)
        if seen == was:
            break
    else:
        raise RuntimeError("components did not settle")
    return edges.groupBy(F.col("u").alias("id")).agg(F.min("v").alias("component"))
