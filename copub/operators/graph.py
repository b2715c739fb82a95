"""Yearly co-author graphs, all years in one set of tables.

A graph is two DataFrames keyed by ``year``:

- vertices ``(year, id)``: every author of a paper of the year, solo authors
  included;
- edges ``(year, src, dst, number_coll)``: ordered pairs ``src != dst`` with
  the number of the year's papers they share.  Both directions are stored, so
  a vertex's degree (in + out) is twice its number of neighbours.

Input shapes:

- *authorship* ``(paper_id, year, author_id)``, one row per paper and author
  (the long form; used by every registered query);
- *papers* ``(paper_id, year, authors array<bigint>)``, one row per paper
  (the papers-CSV form).

Scale notes.  The edges of a paper with k authors are its k(k-1) ordered
pairs; they are the output, so they must be produced, but never all in one
task: a light paper's authors become one bounded list, paired with itself, and a
paper with more than ``BLOCK_AUTHORS`` authors is cut into blocks whose cells spread
its pairs over many tasks, however many such papers there are.  In the array
form, short lists pair inside their scan task and long ones take the blocked
join.  Every aggregation below is partial + final (map-side combine), so a
hot key (one year, one author) never lands whole in one task.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from copub.functions.columns import ratio
from copub.session import delete_path, scratch_path, tasks_for

# Chart titles of the metric series (fixed values of the report).
METRIC_TITLES = {
    "n_vertices": "number of vertices",
    "n_edges": "number of edges",
    "avg_degree": "average degree",
    "density": "density",
}


def authorship_rows(authorship: DataFrame) -> DataFrame:
    """``(paper_id, year, author_id)`` with NULL keys dropped.

    Every consumer of an authorship table starts from this same projection
    and filter (the pair join would infer the filter anyway), so within one
    plan all branches share one subtree and Spark reuses its exchange instead
    of computing the authorship table once per branch.
    """
    return authorship.select("paper_id", "year", "author_id").where(
        F.col("paper_id").isNotNull() & F.col("year").isNotNull() & F.col("author_id").isNotNull()
    )


# Papers with more authors than this are paired block by block.
BLOCK_AUTHORS = 2048
PAIR_BYTES = 2 << 20  # input files per task that makes pairs


def _sized(rows: DataFrame, keys: list[str], block_authors: int) -> DataFrame:
    """Rows of ``keys + author_id`` with ``_s``: the blocks of a heavy paper, NULL for a light one.

    Sizes are a partial aggregation and their join is left to Spark: few heavy papers are
    broadcast at run time, many are merged by key, and the rows of one very hot paper are split
    by the skew join.  There is no bound on the number of heavy papers.
    """
    block = F.lit(int(block_authors))
    sizes = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > block)
    return rows.join(sizes.select(*keys, F.ceil(F.col("_n") / block).cast("int").alias("_s")), keys, "left")


def _heavy_pairs(heavy: DataFrame, keys: list[str], tasks: int) -> DataFrame:
    """Ordered pairs of the heavy papers' authors, cell by cell.

    A paper of s blocks has s x s cells.  An author of block b is a left author of the cells
    (b, 0..s-1) and a right author of the cells (0..s-1, b): the ordered pair (u, v) meets in the one
    cell (block(u), block(v)).  A cell gathers about ``block_authors`` authors on either side, and
    the rows are dealt by cell, so the pairs of a paper are made by many tasks.
    """
    mine = F.pmod(F.xxhash64("author_id"), F.col("_s")).cast("int")
    placed = heavy.select(*keys, "author_id", mine.alias("_b"), F.explode(F.sequence(F.lit(0), F.col("_s") - 1)).alias("_o"))
    sides = F.array(
        F.struct(F.col("_b").alias("i"), F.col("_o").alias("j"), F.lit(True).alias("left")),
        F.struct(F.col("_o").alias("i"), F.col("_b").alias("j"), F.lit(False).alias("left")),
    )
    dealt = placed.select(*keys, "author_id", F.explode(sides).alias("c")).select(*keys, "author_id", "c.*").repartition(tasks, *keys, "i", "j")
    cells = dealt.groupBy(*keys, "i", "j").agg(
        F.collect_list(F.when(F.col("left"), F.col("author_id"))).alias("_l"), F.collect_list(F.when(~F.col("left"), F.col("author_id"))).alias("_r")
    )
    return _crossed(cells, keys, "_l", "_r")


def _crossed(baskets: DataFrame, keys: list[str], left: str, right: str) -> DataFrame:
    """The ordered pairs of two bounded lists in one row."""
    one = baskets.select(*keys, right, F.explode(left).alias("src"))
    return one.select(*keys, "src", F.explode(right).alias("dst")).where("src <> dst")


def _pairs(rows: DataFrame, keys: list[str], block_authors: int) -> DataFrame:
    # authors are few bytes and pairs many: the number of tasks is set, for AQE would join many partitions
    # of authors into one task, whose partial aggregation then holds the pairs of them all
    # (and one more than the session's partitions, for Spark drops a repartition like the one before it)
    tasks = tasks_for(rows, PAIR_BYTES) + 1
    sized = _sized(rows, keys, block_authors)
    light = sized.where(F.col("_s").isNull()).repartition(tasks, *keys).groupBy(*keys).agg(F.collect_list("author_id").alias("_a"))
    return _crossed(light, keys, "_a", "_a").unionByName(_heavy_pairs(sized.where(F.col("_s").isNotNull()), keys, tasks))


def coauthor_pairs(authorship: DataFrame, block_authors: int = BLOCK_AUTHORS) -> DataFrame:
    """Ordered co-author pairs ``(year, src, dst)``, one row per shared paper.

    One shuffle by paper: the authors of a light paper are a list of at most
    ``block_authors``, paired where it lies.  A paper with more than
    ``block_authors`` authors is paired by many tasks
    (see ``_heavy_pairs``: its k^2 pairs never land in one task), and the size
    count that decides it is a partial aggregation.  A (paper, author) row given twice pairs twice, as
    an id listed twice in one author list does.
    """
    pairs = _pairs(authorship_rows(authorship), ["paper_id", "year"], block_authors)
    return pairs.select("year", "src", "dst")


def coauthor_pairs_from_papers(papers: DataFrame, block_authors: int = BLOCK_AUTHORS) -> DataFrame:
    """Ordered pairs ``(year, src, dst)`` from the array form, row by row.

    A row's list is used as is: a paper stored twice counts twice, an id
    listed twice pairs twice, and null ids or years change nothing.  A list
    longer than ``block_authors`` is cut into blocks that are dealt out with
    the whole list, so one long list is paired by many tasks.
    """
    return _list_pairs(papers, ["year"], block_authors).where(F.col("src") != F.col("dst"))


def _list_pairs(papers: DataFrame, keys: list[str], block_authors: int) -> DataFrame:
    """``keys, src, dst`` of any two entries of a row's ``authors``, an entry and itself too."""
    block = F.lit(int(block_authors))
    short = papers.where(F.size("authors") <= block).select(*keys, "authors", F.col("authors").alias("some"))
    starts = F.sequence(F.lit(1), F.size("authors"), block)
    long = papers.where(F.size("authors") > block).select(*keys, "authors", F.explode(starts).alias("at"))
    long = long.repartition("at", F.xxhash64("authors")).select(*keys, "authors", F.slice("authors", F.col("at"), block).alias("some"))
    one = short.unionByName(long).select(*keys, "authors", F.explode("some").alias("src"))
    return one.select(*keys, "src", F.explode("authors").alias("dst"))


def authorship_from_papers(papers: DataFrame) -> DataFrame:
    """Array form -> long form ``(paper_id, year, author_id)``, deduplicated."""
    return (
        papers.select("paper_id", "year", F.explode("authors").alias("author_id"))
        .where(F.col("author_id").isNotNull())
        .distinct()
    )


def edges_from_pairs(pairs: DataFrame) -> DataFrame:
    """Weighted edges ``(year, src, dst, number_coll)``."""
    return pairs.groupBy("year", "src", "dst").agg(F.count(F.lit(1)).alias("number_coll"))


def edges(authorship: DataFrame) -> DataFrame:
    """Weighted edges of every year's graph."""
    return edges_from_pairs(coauthor_pairs(authorship))


def vertices(authorship: DataFrame) -> DataFrame:
    """Vertices ``(year, id)``: all authors of the year, solo authors included."""
    return authorship_rows(authorship).select("year", F.col("author_id").alias("id")).distinct()


def papers_in_year(df: DataFrame, year: int) -> DataFrame:
    """Rows of one year (partition-pruned when the table is stored by year)."""
    return df.where(F.col("year") == F.lit(int(year)))


# Up to this limit the first ids are one task's top-N; beyond it they are found by counting.
TOP_N_IDS = 100_000
SELECT_BITS = 12  # a round of counting tells this many bits of the id apart


def nth_id(ids: DataFrame, n: int) -> int | None:
    """The ``n``-th smallest (from 1) of the distinct ids in the one column of ``ids``; None if there are fewer.

    Selection by counting: each round counts the ids by their next ``SELECT_BITS`` leading bits (at
    most 4096 rows come to the driver) and goes on in the range that holds the n-th.  No ids are
    sorted or gathered.  The distinct ids are written once, so a round reads eight bytes an id.
    """
    spark, name = ids.sparkSession, ids.columns[0]
    path = scratch_path(spark, "ids")
    ids.select(F.col(name).cast("bigint").alias("id")).where("id is not null").distinct().write.parquet(path)
    left = spark.read.schema("id bigint").parquet(path)
    whole = left.agg(F.count(F.lit(1)).alias("n"), F.min("id").alias("lo"), F.max("id").alias("hi")).first()
    if n < 1 or whole["n"] < n:
        delete_path(spark, path)
        return None
    lo, hi = whole["lo"], whole["hi"]
    shift = 64 if (lo < 0) != (hi < 0) else (lo ^ hi).bit_length()  # low bits in which the ids differ
    found = lo
    while shift:
        shift = max(0, shift - SELECT_BITS)
        counts = left.groupBy(F.shiftright("id", shift).alias("bits")).agg(F.count(F.lit(1)).alias("n"))
        for row in counts.orderBy("bits").collect():
            if n <= row["n"]:
                break
            n -= row["n"]
        found = row["bits"] << shift
        left = left.where(F.col("id").between(found, found + (1 << shift) - 1))
    delete_path(spark, path)
    return found


def limit_papers(rows: DataFrame, year: int, limit: int = 0, top_n: int | None = None) -> DataFrame:
    """The year's slice restricted to its first ``limit`` papers by id.

    ``rows`` is an authorship table or a paper table (the array form).  ``limit=0`` keeps
    every row of the year, any other limit leaves rows without id out.  Up to ``top_n`` (``TOP_N_IDS``) the ids go through a top-N; a larger limit
    becomes a filter ``paper_id <= N-th id`` (``nth_id``, which runs jobs), which reaches the scan.
    """
    year_rows = papers_in_year(rows, year)
    if not limit:
        return year_rows
    if limit < 0:
        raise ValueError("limit must be >= 0")
    ids = year_rows.select("paper_id").where("paper_id is not null").distinct()
    if limit > (TOP_N_IDS if top_n is None else top_n):
        last = nth_id(ids, int(limit))
        # fewer papers than the limit: all of them
        return year_rows.where(F.col("paper_id").isNotNull() if last is None else F.col("paper_id") <= F.lit(last))
    return year_rows.join(ids.orderBy("paper_id").limit(int(limit)), "paper_id", "left_semi")


def edges_limited(authorship: DataFrame, year: int, limit: int = 0) -> DataFrame:
    """Edges of one year's graph built from its first ``limit`` papers."""
    return edges(limit_papers(authorship, year, limit))


def degrees(edge_df: DataFrame) -> DataFrame:
    """Degree (in + out over stored edges) per ``(year, id)``.

    One pass over the edges (each edge feeds its two end points); vertices
    without edges get no row.
    """
    return (
        edge_df.select("year", F.explode(F.array("src", "dst")).alias("id"))
        .groupBy("year", "id")
        .agg(F.count(F.lit(1)).alias("degree"))
    )


def vertex_degrees(vertex_df: DataFrame, edge_df: DataFrame) -> DataFrame:
    """``(year, id, degree)`` of every vertex, 0 without edges.

    Edges are stored in both directions, so as many come in as go out, and degrees are
    counted at one end only.  From a bucketed store neither the count nor the join shuffles.
    """
    out = edge_df.groupBy("year", F.col("src").alias("id")).agg(F.count(F.lit(1)).alias("n"))
    return vertex_df.join(out, ["year", "id"], "left").select("year", "id", (2 * F.coalesce("n", F.lit(0))).alias("degree"))


def metrics(vertex_df: DataFrame, edge_df: DataFrame) -> DataFrame:
    """Per year: vertex count, edge count, average degree, density.

    Sum of degrees over stored edges is exactly ``2 * n_edges``, so
    average degree = 2E / V and density = 2E / (V (V - 1)).  A year without
    edges has average degree 0; a one-vertex year has density NULL.
    """
    v = vertex_df.groupBy("year").agg(F.count(F.lit(1)).alias("n_vertices"))
    e = edge_df.groupBy("year").agg(F.count(F.lit(1)).alias("n_edges"))
    m = v.join(e, "year", "left").select(
        "year", "n_vertices", F.coalesce("n_edges", F.lit(0)).cast("bigint").alias("n_edges")
    )
    return m.select(
        "year",
        "n_vertices",
        "n_edges",
        F.coalesce(ratio(2 * F.col("n_edges"), F.col("n_vertices")), F.lit(0.0)).alias("avg_degree"),
        ratio(2 * F.col("n_edges"), F.col("n_vertices").cast("double") * (F.col("n_vertices") - 1)).alias("density"),
    )


def graph_metrics(authorship: DataFrame) -> DataFrame:
    """Metric series of the yearly graphs built from the authorship table."""
    return metrics(vertices(authorship), edges(authorship))


def metrics_long(metric_df: DataFrame) -> DataFrame:
    """Chart data: ``(year, metric, value double)``, one series per title."""
    cols = [F.col(c).cast("double").alias(t) for c, t in METRIC_TITLES.items()]
    return metric_df.select("year", *cols).unpivot(
        ["year"], list(METRIC_TITLES.values()), "metric", "value"
    )


def edges_preview(edge_df: DataFrame, n: int = 10) -> DataFrame:
    """First ``n`` edges by (year, src, dst)."""
    return edge_df.orderBy("year", "src", "dst").limit(int(n))
