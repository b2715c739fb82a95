"""The Spark plan against the definitions in plain Python, and invariants."""

import math
import random
import time
from collections import Counter

import pytest
from pyspark.sql import functions as F

from copub.operators import ego, graph, periods
from copub.plans import fixtures as fx
from copub.sources.exports import EXPORT_ROW_SCHEMA

from conftest import SF_SMALL


def expected_periods(rows, plist):
    """Each metric of an author and period, straight from its definition."""
    shared = Counter((a, year, c) for a, _, year, ids in rows for c in ids if c != a)
    papers = Counter((a, year) for a, _, year, _ in rows)

    def met(author, *years):
        return {c for (a, y, c) in shared if a == author and y in years}

    out = {}
    for author in {r[0] for r in rows}:
        everyone = {c for (a, _, c) in shared if a == author}
        for i, (y1, y2) in enumerate(plist):
            now = met(author, y1, y2)
            before = [met(author, *p) for p in plist[:i]]
            first, second = met(author, y1), met(author, y2)
            if first and second:
                product = sum(shared[author, y1, c] * shared[author, y2, c] for c in everyone)
                cosine = product / math.hypot(*(shared[author, y1, c] for c in everyone))
                cosine /= math.hypot(*(shared[author, y2, c] for c in everyone))
            else:
                cosine = 97.0 if first else 98.0 if second else 99.0
            written = sum(papers[author, y] for y, some in ((y1, first), (y2, second)) if some)
            fresh = now - (before[-1] if before else set())
            out[author, i] = (len(everyone), cosine, len(now), len(fresh), len(now.difference(*before)), written)
    return out


def random_exports(seed):
    rnd = random.Random(seed)
    rows = []
    for pid in range(rnd.randint(5, 40)):
        year = rnd.randint(2000, 2005)
        ids = [rnd.randint(1, 9) for _ in range(rnd.randint(1, 4))]
        for a in set(ids):
            if a <= 6:  # authors 1..6 have an export file
                rows.append((a, pid, year, ids))
    plist = []
    for _ in range(rnd.randint(1, 5)):
        y1 = rnd.randint(1999, 2006)
        plist.append((y1, y1 + rnd.choice([0, 1, 1, 1, 2])))
    return rows, plist


@pytest.mark.parametrize("seed", range(6))
def test_periods_meet_their_definitions(spark, seed):
    rows, plist = random_exports(seed)
    df = spark.createDataFrame(
        [(a, pid, y, None, [(i, None) for i in ids], ("", 0, 0)) for a, pid, y, ids in rows], EXPORT_ROW_SCHEMA
    )
    got = periods.period_long(ego.links_from_exports(df), ego.paper_rows_from_exports(df), plist).collect()
    want = expected_periods(rows, plist)
    assert len(got) == len(want)
    for r in got:
        w = want[(r.author_id, r.pidx)]
        assert r.num_collaborators == w[0]
        assert r.cosine == pytest.approx(w[1], abs=1e-12)
        assert (r.num_collaborations, r.gain_prev, r.gain_abs, r.num_papers) == w[2:]


def test_graph_invariants(spark):
    a = fx.authorship_dense(spark, SF_SMALL)
    e = graph.edges(a)
    rev = e.select("year", F.col("dst").alias("src"), F.col("src").alias("dst"), "number_coll")
    assert e.exceptAll(rev).count() == 0
    d = graph.degrees(e).groupBy("year").agg(F.sum("degree").alias("s"))
    n = e.groupBy("year").count()
    assert d.join(n, "year").where(F.col("s") != 2 * F.col("count")).count() == 0


@pytest.mark.parametrize("which", ["sparse", "dense"])
def test_period_invariants(spark, which):
    a = (fx.authorship_sparse if which == "sparse" else fx.authorship_dense)(spark, SF_SMALL)
    plist = fx.TEST_PERIODS
    long_df = periods.period_long(ego.links_from_authorship(a), ego.paper_rows_from_authorship(a), plist)
    bad = long_df.where(
        (F.col("gain_abs") > F.col("gain_prev"))
        | (F.col("gain_prev") > F.col("num_collaborations"))
        | ~(((F.col("cosine") >= 0) & (F.col("cosine") <= 1)) | F.col("cosine").isin(97.0, 98.0, 99.0))
    )
    assert bad.count() == 0
    # the periods cover every data year: absolute gains add up to all collaborators
    tot = long_df.groupBy("author_id").agg(F.sum("gain_abs").alias("g"), F.max("num_collaborators").alias("c"))
    assert tot.where(F.col("g") != F.col("c")).count() == 0


@pytest.mark.parametrize("seed", range(3))
def test_blocked_pairs_equal_brute_force(spark, seed):
    rnd = random.Random(100 + seed)
    rows = set()
    for pid in range(rnd.randint(3, 12)):
        year = rnd.randint(2000, 2002)
        for a in rnd.sample(range(1, 60), rnd.randint(1, 25)):
            rows.add((pid, year, a))
    rows = sorted(rows)
    a = spark.createDataFrame(rows, "paper_id bigint, year int, author_id bigint")
    want = {}
    for p, y, s in rows:
        for q, y2, d in rows:
            if p == q and y == y2 and s != d:
                want[(y, s, d)] = want.get((y, s, d), 0) + 1
    for block in (1, 2, 5, 2048):
        got = {(r.year, r.src, r.dst): r.number_coll
               for r in graph.edges_from_pairs(graph.coauthor_pairs(a, block_authors=block)).collect()}
        assert got == want, block


def test_cosine_of_equal_years_is_exactly_one(spark):
    rows = [(a, p, "2015" if p == 1 else "2016", None, [(i, None) for i in (1, 2, 3, 4)], ("", 0, 0)) for a in (1, 2, 3, 4) for p in (1, 2)]
    df = spark.createDataFrame([(a, p, int(y), d, ids, o) for a, p, y, d, ids, o in rows], EXPORT_ROW_SCHEMA)
    long_df = periods.period_long(ego.links_from_exports(df), ego.paper_rows_from_exports(df), [(2015, 2016)])
    assert [r.cosine for r in long_df.collect()] == [1.0] * 4
    assert periods.mean_in_range(long_df).collect()[0].mean_cosine == 1.0


def test_sixty_periods_plan_in_seconds(spark):
    rows, _ = random_exports(1)
    df = spark.createDataFrame([(a, pid, y, None, [(i, None) for i in ids], ("", 0, 0)) for a, pid, y, ids in rows], EXPORT_ROW_SCHEMA)
    plist = [(1960 + i, 1961 + i) for i in range(60)]
    began = time.time()
    wide = periods.period_wide(ego.links_from_exports(df), ego.paper_rows_from_exports(df), plist)
    assert len(wide.columns) == 3 + 5 * 60
    wide._jdf.queryExecution().executedPlan()
    assert time.time() - began < 60
    want = expected_periods(rows, plist)
    got = periods.period_long(ego.links_from_exports(df), ego.paper_rows_from_exports(df), plist).collect()
    assert {(r.author_id, r.pidx): r.num_collaborations for r in got} == {k: v[2] for k, v in want.items()}


def test_array_form_keeps_rows_with_null_keys(spark):
    ids = list(range(1, 8))
    papers = spark.createDataFrame([(1, 2000, ids), (None, 2000, ids), (2, None, ids)], "paper_id bigint, year int, authors array<bigint>")
    short, blocked = (graph.coauthor_pairs_from_papers(papers, block_authors=b) for b in (100, 2))
    assert short.count() == 3 * 7 * 6
    assert short.exceptAll(blocked).count() == blocked.exceptAll(short).count() == 0
