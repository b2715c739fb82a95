"""Authorship tables derived from the test tables.

Two mappings of the order data onto ``authorship(paper_id, year, author_id)``:

- *sparse*: paper = (part, order month), authors = ordering customers; many
  solo papers, exercises the sentinel codes and solo years;
- *dense*: paper = order, authors = suppliers of its lines; few authors with
  many shared papers, a well-conditioned cosine.

Both are plain joins + DISTINCT on the scanned tables, so their work grows with
the data.  The same definitions appear as SQL in ``copub.plans.catalog``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from copub.session import tasks_for

# Periods used by the registered queries; they reach outside the data years
# (1995-2001) on purpose.
TEST_PERIODS = [
    (1993, 1994), (1994, 1995), (1995, 1996), (1996, 1997), (1997, 1998),
    (1998, 1999), (1999, 2000), (2000, 2001), (2001, 2002),
]

# The periods of the original timed workload, shifted onto the data years.
BENCH_PERIODS = [(1996, 1997), (1997, 1998), (1998, 1999), (1999, 2000), (2000, 2001)]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _lines_with_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_suppkey", "l_returnflag")
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    return li.join(o, F.col("l_orderkey") == F.col("o_orderkey"))


DISTINCT_BYTES = 2 << 20  # input files per task that makes authorship rows distinct


def _distinct(rows: DataFrame) -> DataFrame:
    """Distinct rows, dealt before they are aggregated: few are equal, and a scan task's partial
    aggregation would hold nearly all rows of its split."""
    return rows.repartition(tasks_for(rows, DISTINCT_BYTES), *rows.columns).distinct()


def authorship_sparse(spark: SparkSession, sf_dir: str) -> DataFrame:
    j = _lines_with_dates(spark, sf_dir)
    return _distinct(j.select(
        (F.col("l_partkey") * 1000000 + F.year("o_orderdate") * 100 + F.month("o_orderdate")).alias("paper_id"),
        F.year("o_orderdate").cast("int").alias("year"),
        F.col("o_custkey").alias("author_id"),
    ))


def authorship_dense(spark: SparkSession, sf_dir: str) -> DataFrame:
    j = _lines_with_dates(spark, sf_dir)
    return _distinct(j.select(
        F.col("o_orderkey").alias("paper_id"),
        F.year("o_orderdate").cast("int").alias("year"),
        F.col("l_suppkey").alias("author_id"),
    ))


def names_sparse(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("author_id"), F.col("c_name").alias("name")
    )


def names_dense(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("author_id"), F.col("s_name").alias("name")
    )


def topic_ids_dense(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Topic id list for the dense papers: the urgent orders (``id``)."""
    return (
        table(spark, sf_dir, "orders")
        .where(F.col("o_orderpriority") == "1-URGENT")
        .select(F.col("o_orderkey").alias("id"))
    )


def topic_ids_sparse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Id list for the sparse papers: those with a returned line (``id``)."""
    j = _lines_with_dates(spark, sf_dir).where(F.col("l_returnflag") == "R")
    return j.select(
        (F.col("l_partkey") * 1000000 + F.year("o_orderdate") * 100 + F.month("o_orderdate")).alias("id")
    ).distinct()


def papers_dense(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dense fixture in the array form ``(paper_id, year, doi, authors)``.

    Orders have at most seven lines, so each author list is small.
    """
    j = _lines_with_dates(spark, sf_dir)
    rows = j.select(F.col("o_orderkey").alias("paper_id"), F.year("o_orderdate").cast("int").alias("year"), F.col("l_suppkey").alias("author_id"))
    return (
        # a set needs no distinct rows; dealt as these are
        rows.repartition(tasks_for(rows, DISTINCT_BYTES), "paper_id")
        .groupBy("paper_id", "year")
        .agg(F.sort_array(F.collect_set("author_id")).alias("authors"))
        .select("paper_id", "year", F.concat(F.lit("10.0/"), F.col("paper_id").cast("string")).alias("doi"), "authors")
    )


def exports_from_authorship(authorship: DataFrame, names: DataFrame) -> DataFrame:
    """Export rows ``(author_file, paper_id, year, doi, authors)``.

    Each author's file holds each of their papers with the paper's full
    author list (id, name), as in the per-author export format.  The lists
    are built per fixture paper, which has a handful of authors; ``authorship`` has a row
    per paper and author, so a paper's authors are those of its list.
    """
    lists = (
        authorship.join(names, "author_id", "left")
        .groupBy("paper_id", "year")
        .agg(F.sort_array(F.collect_list(F.struct(F.col("author_id").alias("id"), "name"))).alias("authors"))
    )
    whole = lists.where("paper_id is not null and year is not null")
    return whole.select(
        F.explode(F.array_distinct("authors.id")).alias("author_file"), "paper_id", "year",
        F.concat(F.lit("10.0/"), F.col("paper_id").cast("string")).alias("doi"), "authors",
    )
