"""Paper table: build from exports, deduplicate, flag against topic ids.

Paper table = ``(paper_id, year, doi, authors array<bigint>)``, one row per
paper id.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from copub.functions.columns import author_ids


def papers_from_exports(exports: DataFrame) -> DataFrame:
    """One row per paper id from export rows (a paper is in each author's file).

    The copy from the greatest ``_order`` (file path, then position) wins;
    copies are expected to be equal.  ``max_by`` is aggregated partially, so
    the copies of a paper listed in very many files are combined map-side.
    """
    rows = exports.where(F.col("paper_id").isNotNull()).select(
        "paper_id",
        "_order",
        F.struct("year", "doi", author_ids("authors").alias("authors")).alias("p"),
    )
    return rows.groupBy("paper_id").agg(F.max_by("p", "_order").alias("p")).select("paper_id", "p.*")


def dedup_papers(papers: DataFrame, order: str | None = None) -> DataFrame:
    """One row per paper id; with ``order``, the row with its greatest value wins."""
    value = F.struct(*[c for c in papers.columns if c not in ("paper_id", order)]).alias("p")
    agg = F.max_by(value, F.col(order)) if order else F.max(value)
    return papers.groupBy("paper_id").agg(agg.alias("p")).select("paper_id", "p.*")


def authors_text(authors: F.Column | str) -> F.Column:
    """Sorted author ids joined by ',' (the CSV/text form of the list)."""
    col = F.col(authors) if isinstance(authors, str) else authors
    return F.array_join(F.sort_array(col).cast("array<string>"), ",")


def papers_summary(papers: DataFrame) -> DataFrame:
    """``(paper_id, year, n_authors, authors_csv)``."""
    return papers.select(
        "paper_id", "year", F.size("authors").alias("n_authors"), authors_text("authors").alias("authors_csv")
    )


def papers_per_year(papers: DataFrame) -> DataFrame:
    """Rows of each year's slice (``year, papers``)."""
    return papers.groupBy("year").agg(F.count(F.lit(1)).alias("papers"))


def _topic(ids: DataFrame) -> DataFrame:
    return ids.select(F.col("id").alias("paper_id")).where(F.col("paper_id").isNotNull())


def flag_papers(
    papers: DataFrame, topic_ids: DataFrame, flag_col: str = "flag", order: str | None = None
) -> DataFrame:
    """``(paper_id, doi, <flag_col>)``: 1 if the paper id is in the topic list, else 0.

    One row per distinct paper id; when an id is listed more than once, the
    doi of its copy with the greatest ``order`` (e.g. ``_order``, the file
    position) wins, else the greatest doi.  Ids only in the topic list give
    no row.  Both sides are deduplicated by partial aggregation on the id,
    which also partitions them for the left join; Spark broadcasts the id
    list only when its measured size is under the broadcast threshold.
    ``flag_col`` names the flag after the topic if wanted.
    """
    cols = ["paper_id", "doi"] + ([order] if order else [])
    one = dedup_papers(papers.select(*cols), order)
    flags = _topic(topic_ids).distinct().withColumn("_flag", F.lit(1))
    return one.join(flags, "paper_id", "left").select(
        "paper_id", "doi", F.coalesce("_flag", F.lit(0)).alias(flag_col)
    )


def topic_intersect(papers: DataFrame, topic_ids: DataFrame) -> DataFrame:
    """Paper ids that are in the topic list (distinct)."""
    return papers.select("paper_id").intersect(_topic(topic_ids))


def topic_except(papers: DataFrame, topic_ids: DataFrame) -> DataFrame:
    """Paper ids that are not in the topic list (distinct)."""
    return papers.select("paper_id").subtract(_topic(topic_ids))
