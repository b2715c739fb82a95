"""A graph store that follows corrected papers, batch by batch.

Papers, signed edges and signed vertices are the tables of a versioned sink
(``streaming.segments``).  A batch of papers is compared with the copies stored before, and only the
difference is appended; merging segments adds up and drops what comes to nothing.  So a batch costs its
own pairs and a look at the papers it names, never a rebuild.  Of the edges the half with
``src < dst`` is stored; rows of the other one, in sinks that have both, are passed over.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from copub.operators import corrections
from copub.operators.papers import dedup_papers
from copub.session import delete_path, scratch_path
from copub.streaming import segments

SCHEMAS = {
    "papers": "paper_id bigint, year int, authors array<bigint>, version bigint",
    "edges": "year int, src bigint, dst bigint, number_coll bigint",
    "vertices": "year int, id bigint, papers bigint",
}
MERGES = {"papers": corrections.newest_papers, "edges": corrections.sum_half, "vertices": corrections.sum_vertices}


def add_papers(papers: DataFrame, batch_id: int, sink_dir: str, order: str | None = None, fan: int = segments.FAN) -> None:
    """Take in a batch of ``(paper_id, year, authors)``; NULL ``authors`` withdraw the paper.

    Of several copies of a paper in a batch the one with the greatest ``order`` counts; without
    ``order`` copies are expected to be equal.  A batch that is in the sink already changes nothing.
    """
    spark = papers.sparkSession
    if batch_id <= segments.state(spark, sink_dir)["batch"]:
        return
    columns = ["paper_id", "year", "authors"] + ([order] if order else [])
    given, path = scratch_path(spark, "incoming-papers"), scratch_path(spark, "signed-papers")
    one = dedup_papers(papers.where("paper_id is not null").select(*columns), order)
    one.select("paper_id", F.col("year").cast("int"), "authors").write.parquet(given)  # made once, read for each use below
    incoming = spark.read.schema("paper_id bigint, year int, authors array<bigint>").parquet(given)
    named = _newest(spark, sink_dir, only=lambda rows: rows.join(incoming.select("paper_id"), "paper_id", "left_semi"))
    corrections.signed_papers(named, incoming).write.parquet(path)  # read for edges and for vertices
    signed = spark.read.schema("paper_id bigint, year int, authors array<bigint>, sign int").parquet(path)
    version = F.lit(batch_id).cast("bigint").alias("version")
    tables = {
        "papers": incoming.select("paper_id", "year", "authors", version),
        "edges": corrections.half_delta(signed),
        "vertices": corrections.vertex_delta(signed),
    }
    segments.append(spark, sink_dir, batch_id, tables)
    delete_path(spark, path)
    delete_path(spark, given)
    segments.compact(spark, sink_dir, MERGES, SCHEMAS, fan)


def _newest(spark: SparkSession, sink_dir: str, only=None) -> DataFrame:
    return segments.current(spark, sink_dir, "papers", SCHEMAS["papers"], MERGES["papers"], only)


def read_edges(spark: SparkSession, sink_dir: str) -> DataFrame:
    """The edges of all years' graphs as they stand."""
    half = segments.current(spark, sink_dir, "edges", SCHEMAS["edges"], MERGES["edges"], only=lambda rows: rows.where("src < dst"))
    return corrections.both_ways(half)


def read_vertices(spark: SparkSession, sink_dir: str) -> DataFrame:
    """``(year, id)`` of the authors with a paper, as they stand."""
    return segments.current(spark, sink_dir, "vertices", SCHEMAS["vertices"], MERGES["vertices"]).select("year", "id")


def read_papers(spark: SparkSession, sink_dir: str) -> DataFrame:
    """``(paper_id, year, authors)`` of the papers that are not withdrawn."""
    return _newest(spark, sink_dir).where("authors is not null").select("paper_id", "year", "authors")
