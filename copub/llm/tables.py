"""Written scratch tables and connected components.

Iterative operators cut their lineage with Parquet tables under the folder
that the cluster names in ``spark.checkpoint.dir``: shared by all executors,
so a lost executor loses nothing that was written.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_folder(spark: SparkSession) -> str:
    """The session's checkpoint folder; a local master may do without one."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return tempfile.gettempdir() + "/copub-scratch"


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to a new table in the shared folder, and read from there."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/llm/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._scratch = path
    return out


def drop(df: DataFrame) -> None:
    """Delete the table of ``written`` or ``components`` that no later step reads."""
    spark, path = df.sparkSession, df._scratch
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


def components(edges: DataFrame) -> DataFrame:
    """(node, component) of the undirected edges (a, b) of non-null longs.

    Alternating large-star and small-star steps; the component is the smallest
    node.  The result reads a written table, which ``drop`` of the result deletes.  Every step is a grouped minimum (combined before the shuffle) and a
    join, so a node with very many neighbours is never gathered in one place.
    """
    current = written(
        edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(),
        "edges",
    )
    state = None
    while True:
        both = current.unionByName(current.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(low, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = large.where("a <> b").distinct()
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        joined = large.join(low, "a")
        small = (
            joined.select(F.explode(F.array(F.struct("b", "m"), F.struct(F.col("a").alias("b"), "m"))).alias("e"))
            .select(F.col("e.b").alias("a"), F.col("e.m").alias("b"))
            .where("a <> b")
            .distinct()
        )
        following = written(small, "edges")
        now = following.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))).first()
        drop(current)
        current = following
        if now == state:
            break
        state = now
    roots = current.select(F.col("b").alias("a"), "b").distinct()
    out = current.unionByName(roots).select(F.col("a").alias("node"), F.col("b").alias("component"))
    out._scratch = current._scratch
    return out
