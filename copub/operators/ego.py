"""Per-author collaborator structures, as long tables.

- links ``(author_id, year, collab_id, n)``: the author shared ``n`` papers of
  ``year`` with ``collab_id`` (rows need not be unique; ``n`` adds up);
- papers ``(author_id, year, papers)``: papers of the author in the year,
  solo papers included, one per row (no dedup by paper id);
- names ``(author_id, name)``.

The nested "author -> year -> collaborator -> count" structure with zero
filling is offered as ``zero_filled`` but no metric needs it: the sparse long
form gives the same results, keyed by collaborator instead of by position.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from copub.operators import graph

LINK_COLS = ["author_id", "year", "collab_id", "n"]


def links_from_authorship(authorship: DataFrame) -> DataFrame:
    """Each author's view of the authorship table: one row per shared paper."""
    return graph.coauthor_pairs(authorship).select(
        F.col("src").alias("author_id"),
        "year",
        F.col("dst").alias("collab_id"),
        F.lit(1).cast("bigint").alias("n"),
    )


def paper_rows_from_authorship(authorship: DataFrame) -> DataFrame:
    """``(author_id, year, papers=1)`` per authorship row (aggregate later)."""
    return graph.authorship_rows(authorship).select("author_id", "year", F.lit(1).cast("bigint").alias("papers"))


def collab_counts(links: DataFrame) -> DataFrame:
    """Papers shared per (author, year, collaborator)."""
    return links.groupBy("author_id", "year", "collab_id").agg(F.sum("n").cast("bigint").alias("n"))


def year_papers(paper_rows: DataFrame) -> DataFrame:
    """Papers per (author, year)."""
    return paper_rows.groupBy("author_id", "year").agg(F.sum("papers").cast("bigint").alias("papers"))


def zero_filled(counts: DataFrame) -> DataFrame:
    """Every active year of an author lists every collaborator of the author.

    Active year = a year with at least one collaborator; a NULL year is one
    like any other.  Output is years x collaborators per author; missing
    counts are 0, and the counts of repeated rows add up.
    """
    # An author's years are few, so a pair's counts by year and the author's years are short
    # lists; collaborators stay rows, which AQE can split.  Counts of repeated rows add up first, and
    # a year may be NULL (unreadable in the file): lists of structs take both, a map neither.
    entry = F.struct("year", F.col("n").alias("n"))
    pairs = collab_counts(counts).groupBy("author_id", "collab_id").agg(F.collect_list(entry).alias("by_year"))
    years = counts.groupBy("author_id").agg(F.collect_set(F.struct("year")).alias("years"))
    grid = pairs.join(years, "author_id").select("author_id", "collab_id", "by_year", F.explode("years").alias("y"))
    here = F.filter("by_year", lambda e: e["year"].eqNullSafe(F.col("y.year")))
    return grid.select("author_id", F.col("y.year").alias("year"), "collab_id", F.coalesce(F.get(here, 0)["n"], F.lit(0)).cast("bigint").alias("n"))


def totals(links: DataFrame, paper_rows: DataFrame, names: DataFrame | None = None) -> DataFrame:
    """``(author_id, name, num_collaborators)`` for every author with a paper.

    Distinct collaborators over all years; 0 for an author with solo papers
    only.  ``name`` is NULL when no names table is given or it has no entry.
    """
    # links and paper rows (NULL collaborator) in one table: distinct
    # (author, collaborator), then per author the collaborators and whether
    # there is a paper -- two partial aggregations, no join
    lk = links.select("author_id", F.col("collab_id").cast("bigint"), F.lit(0).alias("_paper"))
    pr = paper_rows.select("author_id", F.lit(None).cast("bigint").alias("collab_id"), F.lit(1).alias("_paper"))
    out = (
        lk.unionByName(pr)
        .groupBy("author_id", "collab_id").agg(F.max("_paper").alias("_paper"))
        .groupBy("author_id")
        .agg(F.count_if(F.col("collab_id").isNotNull()).alias("num_collaborators"), F.max("_paper").alias("_paper"))
        .where(F.col("_paper") == 1)
    )
    if names is not None:
        out = out.join(names.select("author_id", "name"), "author_id", "left")
    else:
        out = out.withColumn("name", F.lit(None).cast("string"))
    return out.select(
        "author_id", "name", F.coalesce("num_collaborators", F.lit(0)).cast("bigint").alias("num_collaborators")
    )


def merge_counts(*counts: DataFrame) -> DataFrame:
    """Accumulate count tables computed separately (e.g. per batch of files)."""
    if not counts:
        raise ValueError("at least one count table is required")
    both = reduce(lambda a, b: a.unionByName(b), [c.select(*LINK_COLS) for c in counts])
    return collab_counts(both)


def keep_papers(df: DataFrame, ids) -> DataFrame:
    """Rows whose ``paper_id`` is in ``ids``; ``None`` or an empty list keeps all.

    ``ids`` is a DataFrame with an ``id`` column or a Python list.  No job runs here: whether
    a DataFrame of ids is empty is a scalar subquery of the plan, and the join is left
    to Spark (broadcast only when AQE sees a small side).
    """
    if ids is None:
        return df
    if isinstance(ids, (list, tuple, set)):
        if not ids:
            return df
        ids = df.sparkSession.createDataFrame([(int(i),) for i in ids], "id bigint")
        return df.join(ids.select(F.col("id").alias("paper_id")).distinct(), "paper_id", "left_semi")
    some = ids.select(F.lit(1).alias("one")).limit(1).agg(F.count("one")).scalar()
    wanted = ids.select(F.col("id").alias("paper_id"), F.lit(True).alias("_wanted")).where("paper_id is not null").distinct()
    return df.join(wanted, "paper_id", "left").where(F.col("_wanted").isNotNull() | (some == 0)).select(*df.columns)


# --------------------------------------------------------------------------
# From per-author export rows


def links_from_exports(exports: DataFrame) -> DataFrame:
    """One row per (export row, listed co-author other than the file's author).

    A collaborator listed twice on a paper counts twice.
    """
    return (
        exports.select("author_file", "year", F.explode("authors").alias("a"))
        .where(F.col("a.id").isNotNull() & (F.col("a.id") != F.col("author_file")))
        .select(
            F.col("author_file").alias("author_id"),
            "year",
            F.col("a.id").alias("collab_id"),
            F.lit(1).cast("bigint").alias("n"),
        )
    )


def paper_rows_from_exports(exports: DataFrame) -> DataFrame:
    """``(author_id, year, papers=1)`` per export row, solo papers included."""
    return exports.select(
        F.col("author_file").alias("author_id"), "year", F.lit(1).cast("bigint").alias("papers")
    )


def rows_from_exports(exports: DataFrame) -> DataFrame:
    """Links and paper rows from ONE projection of the export rows.

    ``(author_id, year, collab_id, n, papers)`` as taken by the period
    operators with ``paper_rows=None``: each listed author gives a row (its
    collaborator, or NULL for the file's own author), and the first entry of
    each export row (or the row itself when its list is empty) carries
    ``papers = 1``.  The export files are then parsed once, not once per
    branch.
    """
    x = exports.select("author_file", "year", F.posexplode_outer("authors").alias("pos", "a"))
    other = F.col("a.id").isNotNull() & (F.col("a.id") != F.col("author_file"))
    return x.select(
        F.col("author_file").alias("author_id"),
        "year",
        F.when(other, F.col("a.id")).alias("collab_id"),
        F.when(other, F.lit(1)).otherwise(F.lit(0)).cast("bigint").alias("n"),
        F.when(F.col("pos").isNull() | (F.col("pos") == 0), F.lit(1)).otherwise(F.lit(0)).cast("bigint").alias("papers"),
    )


def names_from_exports(exports: DataFrame) -> DataFrame:
    """Author name = the name at the author's first mention in their own file.

    First = smallest (file path, block start, row id, position in the list);
    ``min_by`` aggregates partially, so a large file never lands in one task.
    """
    # of a row only its list's first mention can be it: a look into the list, no row per listed author
    at = F.array_position("authors.id", F.col("author_file"))
    own = exports.select("author_file", "_order", "authors", at.cast("int").alias("at")).where("at > 0")
    return own.groupBy(F.col("author_file").alias("author_id")).agg(F.min_by(F.get("authors", F.col("at") - 1)["name"], "_order").alias("name"))
