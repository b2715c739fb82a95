"""Parquet stores for graphs and ego tables, partitioned by year or bucketed.

Stored by ``year``, a one-year read is partition-pruned (no file of another
year is opened).  Rows are range-partitioned on (year, key) before the write:
each task holds one or two years, so a year is a few large files rather
than one small file per task, and a large year is still written by several
tasks.  Default mode ``errorifexists`` refuses to overwrite.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from copub.session import tasks_for

VERTEX_SCHEMA = "id bigint, year int"
EDGE_SCHEMA = "src bigint, dst bigint, number_coll bigint, year int"
COUNT_SCHEMA = "author_id bigint, collab_id bigint, n bigint, year int"
PAPERS_SCHEMA = "author_id bigint, papers bigint, year int"
NAME_SCHEMA = "author_id bigint, name string"


def _by_year(df: DataFrame, key: str) -> DataFrame:
    return df.repartitionByRange("year", key)


def write_graph(vertices: DataFrame, edges: DataFrame, path: str, mode: str = "errorifexists") -> None:
    base = path.rstrip("/")
    _by_year(vertices.select("year", "id"), "id").write.mode(mode).partitionBy("year").parquet(f"{base}/vertices")
    _by_year(edges.select("year", "src", "dst", "number_coll"), "src").write.mode(mode).partitionBy("year").parquet(
        f"{base}/edges"
    )


def read_graph(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    base = path.rstrip("/")
    v = spark.read.schema(VERTEX_SCHEMA).parquet(f"{base}/vertices").select("year", "id")
    e = spark.read.schema(EDGE_SCHEMA).parquet(f"{base}/edges").select("year", "src", "dst", "number_coll")
    return v, e


def write_ego(
    counts: DataFrame, year_papers: DataFrame, names: DataFrame | None, path: str, mode: str = "errorifexists"
) -> None:
    base = path.rstrip("/")
    _by_year(counts.select("author_id", "year", "collab_id", "n"), "author_id").write.mode(mode).partitionBy(
        "year"
    ).parquet(f"{base}/counts")
    _by_year(year_papers.select("author_id", "year", "papers"), "author_id").write.mode(mode).partitionBy(
        "year"
    ).parquet(f"{base}/papers")
    if names is not None:
        names.select("author_id", "name").write.mode(mode).parquet(f"{base}/names")


def read_ego(spark: SparkSession, path: str, with_names: bool = True):
    base = path.rstrip("/")
    counts = spark.read.schema(COUNT_SCHEMA).parquet(f"{base}/counts").select("author_id", "year", "collab_id", "n")
    papers = spark.read.schema(PAPERS_SCHEMA).parquet(f"{base}/papers").select("author_id", "year", "papers")
    names = spark.read.schema(NAME_SCHEMA).parquet(f"{base}/names") if with_names else None
    return counts, papers, names


BUCKETS = 64  # the least number of tasks that read a bucketed graph
BUCKET_BYTES = 8 << 20  # input files per bucket of a larger one
_BUCKETED = {"vertices": ("year int, id bigint", ["year", "id"]), "edges": ("year int, src bigint, dst bigint, number_coll bigint", ["year", "src"])}


def write_bucketed_graph(vertices: DataFrame, edges: DataFrame, path: str, buckets: int = BUCKETS) -> None:
    """Write a graph with vertices bucketed by (year, id) and edges by (year, src); a path that holds one is refused.

    ``buckets`` is the least number: a graph made from large files gets more, so that a bucket, which
    one task sorts and reads, does not grow with them.
    """
    spark, base = vertices.sparkSession, path.rstrip("/")
    buckets = tasks_for(edges, BUCKET_BYTES, int(buckets))
    spark.range(1).select(F.lit(int(buckets)).alias("buckets")).coalesce(1).write.parquet(f"{base}/layout")
    for name, rows in (("vertices", vertices), ("edges", edges)):
        schema, keys = _BUCKETED[name]
        columns = [field.split()[0] for field in schema.split(", ")]
        table = f"copub_{uuid.uuid4().hex}"
        # dealt as the buckets are, so that a bucket is one file
        dealt = rows.select(*columns).repartition(int(buckets), *keys)
        dealt.write.bucketBy(int(buckets), *keys).sortBy(*keys).option("path", f"{base}/{name}").format("parquet").saveAsTable(table)
        spark.sql(f"DROP TABLE {table}")  # the files stay: they lie in a place of our own


def read_bucketed_graph(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """Vertices and edges of a bucketed store, as tables of this session that know their buckets."""
    base = path.rstrip("/")
    buckets = spark.read.schema("buckets int").parquet(f"{base}/layout").first()["buckets"]
    out = []
    for name, (schema, keys) in _BUCKETED.items():
        table, by = f"copub_{uuid.uuid4().hex}", ", ".join(keys)
        place = f"{base}/{name}".replace("'", "\\'")
        spark.sql(f"CREATE TABLE {table} ({schema}) USING parquet CLUSTERED BY ({by}) SORTED BY ({by}) INTO {buckets} BUCKETS LOCATION '{place}'")
        out.append(spark.table(table))
    return out[0], out[1]
