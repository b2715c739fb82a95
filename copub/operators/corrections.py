"""Graphs under corrected papers: a later copy retracts what the earlier one gave.

Papers change: a list of authors is completed, a year is mended, a paper is withdrawn.  Instead of building
the graph anew, the difference between the old and the new copy is expressed as signed rows, -1 for
what the old copy gave and +1 for what the new one gives, and carried through the pairing.
Sums of signed rows are all that a graph is, so adding a delta to any older state gives what a
rebuild would: edges and vertices whose sum becomes 0 are gone.

Tables: *papers* ``(paper_id, year, authors)``, one row per id; *signed papers* with ``sign``;
*edges* ``(year, src, dst, number_coll)``; *vertices* ``(year, id, papers)``, the number of papers
being what keeps a vertex.  Both directions of an edge change alike, so what is paired, summed and stored
is the *half* of the edges with ``src < dst``; ``both_ways`` gives the other one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from copub.operators import graph
from copub.session import tasks_for

SUM_BYTES = 2 << 20  # input files per task that adds edges up; a stored edge is a few bytes, in a task's memory many


def _version(year, authors):
    """What matters of a copy: its year, and its authors as a set; NULL authors: no paper."""
    ids = F.array_except(F.array_distinct(authors), F.array(F.lit(None).cast("bigint")))
    return F.when(authors.isNotNull(), F.struct(year.alias("year"), F.sort_array(ids).alias("authors")))


def signed_papers(papers: DataFrame, incoming: DataFrame) -> DataFrame:
    """``(paper_id, year, authors, sign)``: the old copies that ``incoming`` replaces and the new ones.

    ``incoming`` has one row per paper id; ``authors`` NULL withdraws the paper.  Copies that say the same as
    before (authors in any order) give no row.  Rows without id are left out.
    """
    old = papers.select("paper_id", _version(F.col("year"), F.col("authors")).alias("old"))
    new = incoming.where("paper_id is not null").select("paper_id", _version(F.col("year"), F.col("authors")).alias("new"))
    changed = new.join(old, "paper_id", "left").where(~F.col("old").eqNullSafe(F.col("new")))
    both = F.array(F.struct(F.lit(-1).alias("sign"), F.col("old").alias("v")), F.struct(F.lit(1).alias("sign"), F.col("new").alias("v")))
    return changed.select("paper_id", F.explode(both).alias("s")).where("s.v is not null").select("paper_id", "s.v.year", "s.v.authors", "s.sign")


def edge_delta(signed: DataFrame, block_authors: int = graph.BLOCK_AUTHORS) -> DataFrame:
    """``(year, src, dst, number_coll)``: by how much each edge changes.  Heavy papers are paired in blocks."""
    return both_ways(half_delta(signed, block_authors))


def half_delta(signed: DataFrame, block_authors: int = graph.BLOCK_AUTHORS) -> DataFrame:
    """``edge_delta`` of the edges with ``src < dst``.

    The authors of a row are a set already, so they are paired where they lie; rows are dealt
    first, as pairs are many more than the bytes of a scan's split tell.
    """
    rows = signed.where("year is not null").select("paper_id", "year", "sign", "authors")
    dealt = rows.repartition(tasks_for(rows, graph.PAIR_BYTES) + 1, "paper_id")
    pairs = graph._list_pairs(dealt, ["year", "sign"], block_authors).where("src < dst")
    return pairs.groupBy("year", "src", "dst").agg(F.sum("sign").cast("bigint").alias("number_coll")).where("number_coll <> 0")


def both_ways(half: DataFrame) -> DataFrame:
    """Each edge of the half, and its other direction."""
    ways = F.array(F.struct("src", "dst"), F.struct(F.col("dst").alias("src"), F.col("src").alias("dst")))
    return half.select("year", F.explode(ways).alias("e"), "number_coll").select("year", "e.src", "e.dst", "number_coll")


def sum_half(rows: DataFrame) -> DataFrame:
    """``sum_edges`` of the half; rows are dealt before they are summed, as those of one segment are all different."""
    rows = rows.where("src < dst")
    return sum_edges(rows.repartition(tasks_for(rows, SUM_BYTES) + 1, "year", "src", "dst"))


def vertex_delta(signed: DataFrame) -> DataFrame:
    """``(year, id, papers)``: by how many papers each vertex changes."""
    rows = signed.select("year", F.explode("authors").alias("id"), "sign").where("year is not null")
    return rows.groupBy("year", "id").agg(F.sum("sign").cast("bigint").alias("papers")).where("papers <> 0")


def _summed(rows: DataFrame, keys: list[str], value: str) -> DataFrame:
    return rows.groupBy(*keys).agg(F.sum(value).cast("bigint").alias(value)).where(F.col(value) != 0)


def sum_edges(rows: DataFrame) -> DataFrame:
    """Edges and deltas added up; what comes to nothing is gone."""
    return _summed(rows, ["year", "src", "dst"], "number_coll")


def sum_vertices(rows: DataFrame) -> DataFrame:
    return _summed(rows, ["year", "id"], "papers")


def newest_papers(rows: DataFrame) -> DataFrame:
    """``(paper_id, year, authors, version)``: each paper's copy of the greatest version, withdrawn ones too."""
    return rows.groupBy("paper_id").agg(F.max_by(F.struct("year", "authors"), "version").alias("p"), F.max("version").alias("version")).select("paper_id", "p.*", "version")
