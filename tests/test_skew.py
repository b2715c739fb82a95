"""A hot paper (most of the rows) is paired by several tasks, results exact."""

from contextlib import contextmanager

from copub.operators import ego, graph, periods

HOT_AUTHORS = 300


def skewed_authorship(spark):
    hot = [(1, 2000, a) for a in range(1, HOT_AUTHORS + 1)]
    normal = [(10 + p, 2000 + p % 3, 1000 + (p * 7 + j) % 500) for p in range(3000) for j in range(2)]
    rows = sorted(set(hot + normal))
    return spark.createDataFrame(rows, "paper_id bigint, year int, author_id bigint"), rows


@contextmanager
def conf(spark, **kv):
    old = {k: spark.conf.get(k, None) for k in kv}
    for k, v in kv.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def brute_force_edges(rows):
    by_paper = {}
    for p, y, a in rows:
        by_paper.setdefault((p, y), []).append(a)
    out = {}
    for (p, y), authors in by_paper.items():
        for s in authors:
            for d in authors:
                if s != d:
                    out[(y, s, d)] = out.get((y, s, d), 0) + 1
    return out


def test_hot_paper_is_split_and_exact(spark):
    a, rows = skewed_authorship(spark)
    got = {(r.year, r.src, r.dst): r.number_coll for r in graph.edges(a).collect()}
    assert got == brute_force_edges(rows)
    blocked = {(r.year, r.src, r.dst): r.number_coll for r in
               graph.edges_from_pairs(graph.coauthor_pairs(a, block_authors=50)).collect()}
    assert blocked == got


def test_hot_paper_pairs_spread_over_tasks(spark):
    from pyspark.sql import functions as F

    a, _ = skewed_authorship(spark)
    base = graph.authorship_rows(a)
    pairs = graph._pairs(base, ["paper_id", "year"], 50).where("paper_id = 1")
    with conf(spark, **{"spark.sql.adaptive.coalescePartitions.enabled": "false"}):
        per_task = pairs.groupBy(F.spark_partition_id().alias("t")).count().collect()
    total = sum(r["count"] for r in per_task)
    assert total == HOT_AUTHORS * (HOT_AUTHORS - 1)
    # 6 x 6 cells over 8 partitions: no task holds the whole paper
    assert len(per_task) >= 4
    assert max(r["count"] for r in per_task) < total / 2


def test_very_many_heavy_papers_are_all_cut(spark):
    from pyspark.sql import functions as F

    # 300 papers of 12 authors and one of 3000, blocks of 5: every heavy paper is split, none is left whole
    hot = [(1, 2000, x) for x in range(3000)]
    many = [(10 + p, 2000, p % 7 + 10 * j) for p in range(300) for j in range(12)]
    few = [(5000 + p, 2000, p + j) for p in range(100) for j in range(3)]
    a = spark.createDataFrame(hot + many + few, "paper_id bigint, year int, author_id bigint")
    rows = graph.authorship_rows(a)
    sized = graph._sized(rows, ["paper_id", "year"], 5)
    cut = {r.paper_id: r["_s"] for r in sized.select("paper_id", "_s").distinct().collect()}
    assert cut == {1: 600} | {10 + p: 3 for p in range(300)} | {5000 + p: None for p in range(100)}
    with conf(spark, **{"spark.sql.adaptive.coalescePartitions.enabled": "false"}):
        pairs = graph._pairs(rows, ["paper_id", "year"], 250)
        per_task = pairs.where("paper_id = 1").groupBy(F.spark_partition_id().alias("t")).count().collect()
    total = sum(r["count"] for r in per_task)
    assert total == 3000 * 2999
    assert len(per_task) >= 8 and max(r["count"] for r in per_task) < total / 4
    got = graph._pairs(rows.where("paper_id <> 1"), ["paper_id", "year"], 5)
    assert got.count() == 300 * 12 * 11 + 100 * 3 * 2 and got.distinct().count() == got.count()


def test_hot_author_period_metrics_exact(spark):
    a, rows = skewed_authorship(spark)
    long_df = periods.period_long(ego.links_from_authorship(a), ego.paper_rows_from_authorship(a), [(2000, 2001)])
    hot = {r.author_id: r for r in long_df.where("author_id <= 3").collect()}
    # every hot author collaborates with the other 299 in 2000 only
    for r in hot.values():
        assert (r.cosine, r.num_collaborations, r.gain_prev, r.gain_abs) == (97.0, HOT_AUTHORS - 1, HOT_AUTHORS - 1, HOT_AUTHORS - 1)


def test_array_form_long_rows_match_short_path(spark):
    from pyspark.sql import functions as F

    rows = [(1, 2000, list(range(1, 41))), (1, 2000, list(range(1, 41))),  # same paper stored twice
            (2, 2001, [5, 5, 6, 7]), (3, 2001, [8, 9])]
    papers = spark.createDataFrame(rows, "paper_id bigint, year int, authors array<bigint>").repartition(3)
    short = graph.edges_from_pairs(graph.coauthor_pairs_from_papers(papers, block_authors=10_000))
    blocked = graph.edges_from_pairs(graph.coauthor_pairs_from_papers(papers, block_authors=7))
    a = sorted(map(tuple, short.collect()))
    b = sorted(map(tuple, blocked.collect()))
    assert a == b
    got = {(r.year, r.src, r.dst): r.number_coll for r in short.collect()}
    assert got[(2000, 1, 2)] == 2 and got[(2001, 5, 6)] == 2 and got[(2001, 6, 5)] == 2
    assert (2001, 5, 5) not in got
