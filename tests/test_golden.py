"""Hand-worked cases (FIXTURES.md section 3)."""

import json
import math
import os

import pytest
from pyspark.sql import functions as F

from copub.operators import ego, graph, papers, periods
from copub.sources import exports

# author 1 ("Ada"): paper, year text, author ids
ADA = [
    (11, "2015-01-01", [1, 2, 3]),
    (12, "2015", [1, 2]),
    (13, "2016-06-30", [1, 2, 4]),
    (14, "2017", [1]),
    (15, "2018", [1, 5]),
    (16, "2019", [1, 2]),
]
NAMES = {1: "Ada", 2: "Bo", 3: "Cy", 4: "Di", 5: "Ed"}
PERIODS = [(2015, 2016), (2016, 2017), (2017, 2018), (2018, 2019), (2019, 2020), (2021, 2022)]


def write_export(folder, author, rows):
    os.makedirs(folder, exist_ok=True)
    with open(os.path.join(folder, f"{author}.json"), "w") as f:
        for pid, year, ids in rows:
            rec = {"_source": {"id": pid, "year": year, "doi": f"d{pid}",
                               "authors": [{"id": i, "name": NAMES.get(i, str(i))} for i in ids]}}
            f.write(json.dumps(rec) + "\n")


@pytest.fixture()
def ada_rows(spark, tmp_dir):
    write_export(tmp_dir, 1, ADA)
    return exports.read_exports(spark, tmp_dir)


def _period_table(rows, measure="similarity"):
    out = periods.period_long(ego.links_from_exports(rows), ego.paper_rows_from_exports(rows), PERIODS, measure)
    return {r.pidx: r for r in out.collect()}


def test_author_periods_similarity(ada_rows):
    t = _period_table(ada_rows)
    assert len(t) == 6
    assert all(r.author_id == 1 and r.num_collaborators == 4 for r in t.values())
    assert t[0].cosine == pytest.approx(2 / math.sqrt(10), abs=1e-12)
    got = [(t[i].num_collaborations, t[i].gain_prev, t[i].gain_abs, t[i].num_papers) for i in range(6)]
    assert got == [(3, 3, 3, 3), (2, 0, 0, 1), (1, 1, 1, 1), (2, 1, 0, 2), (1, 0, 0, 1), (0, 0, 0, 0)]
    assert [t[i].cosine for i in range(1, 6)] == [97.0, 98.0, 0.0, 97.0, 99.0]


def test_author_periods_distance(ada_rows):
    t = _period_table(ada_rows, "distance")
    assert t[0].cosine == pytest.approx(1 - 2 / math.sqrt(10), abs=1e-12)
    assert [t[i].cosine for i in range(1, 6)] == [97.0, 98.0, 1.0, 97.0, 99.0]


def test_wide_report_columns(ada_rows):
    rows = ada_rows
    names = ego.names_from_exports(rows)
    w = periods.period_wide(ego.links_from_exports(rows), ego.paper_rows_from_exports(rows), PERIODS[:2], names)
    assert w.columns == [
        "id", "name", "num_Collaborations",
        "cosine_similarity_2015_2016", "num_collaborations_2015_2016",
        "gain_collaborators_last_two_years_2015_2016", "gain_collaborators_absolute_2015_2016",
        "num_papers_2015_2016",
        "cosine_similarity_2016_2017", "num_collaborations_2016_2017",
        "gain_collaborators_last_two_years_2016_2017", "gain_collaborators_absolute_2016_2017",
        "num_papers_2016_2017",
    ]
    r = w.collect()[0]
    assert (r.id, r.name, r.num_Collaborations) == (1, "Ada", 4)
    assert r.num_papers_2016_2017 == 1


def test_solo_only_author(spark, tmp_dir):
    write_export(tmp_dir, 9, [(91, "2015", [9]), (92, "2016", [9])])
    t = _period_table(exports.read_exports(spark, tmp_dir))
    assert all((r.cosine, r.num_collaborations, r.gain_prev, r.gain_abs, r.num_papers) == (99.0, 0, 0, 0, 0)
               for r in t.values())
    assert all(r.num_collaborators == 0 for r in t.values())


def test_same_year_twice_doubles(spark, tmp_dir):
    write_export(tmp_dir, 1, ADA)
    rows = exports.read_exports(spark, tmp_dir)
    out = periods.period_long(ego.links_from_exports(rows), ego.paper_rows_from_exports(rows), [(2015, 2015)])
    r = out.collect()[0]
    assert r.cosine == pytest.approx(1.0)
    assert (r.num_collaborations, r.num_papers) == (2, 4)


def test_mean_of_distinct_in_range(spark):
    df = spark.createDataFrame([(0, 0.5), (0, 0.5), (0, 0.0), (0, 97.0), (0, 99.0), (1, 99.0)], "pidx int, cosine double")
    got = {r.pidx: r.mean_cosine for r in periods.mean_in_range(df).collect()}
    assert got[0] == pytest.approx(0.25)
    assert got[1] is None


def test_graph_of_two_papers(spark):
    a = spark.createDataFrame(
        [(11, 2015, 1), (11, 2015, 2), (11, 2015, 3), (12, 2015, 1), (12, 2015, 2), (14, 2017, 1)],
        "paper_id bigint, year int, author_id bigint",
    )
    e = {(r.year, r.src, r.dst): r.number_coll for r in graph.edges(a).collect()}
    assert e == {(2015, 1, 2): 2, (2015, 2, 1): 2, (2015, 1, 3): 1, (2015, 3, 1): 1, (2015, 2, 3): 1, (2015, 3, 2): 1}
    d = {(r.year, r.id): r.degree for r in graph.degrees(graph.edges(a)).collect()}
    assert d == {(2015, 1): 4, (2015, 2): 4, (2015, 3): 4}
    m = {r.year: r for r in graph.graph_metrics(a).collect()}
    assert (m[2015].n_vertices, m[2015].n_edges, m[2015].avg_degree, m[2015].density) == (3, 6, 4.0, 2.0)
    assert (m[2017].n_vertices, m[2017].n_edges, m[2017].avg_degree, m[2017].density) == (1, 0, 0.0, None)


def test_limit_zero_keeps_all(spark):
    a = spark.createDataFrame([(1, 2015, 1), (1, 2015, 2), (2, 2015, 1), (2, 2015, 3)], "paper_id bigint, year int, author_id bigint")
    assert graph.limit_papers(a, 2015, 0).count() == 4
    assert graph.limit_papers(a, 2015, 1).count() == 2
    assert graph.edges_limited(a, 2015, 1).count() == 2


def test_papers_from_exports(spark, tmp_dir):
    write_export(tmp_dir, 7, [(70, "2019-03-01", [7, 7, 8])])
    write_export(tmp_dir, 8, [(70, "2019-03-01", [7, 7, 8])])
    p = papers.papers_from_exports(exports.read_exports(spark, tmp_dir)).collect()
    assert [(r.paper_id, r.year, r.authors) for r in p] == [(70, 2019, [7, 8])]


def test_flags_and_id_filter(spark, tmp_dir):
    write_export(tmp_dir, 1, ADA)
    rows = exports.read_exports(spark, tmp_dir)
    pt = papers.papers_from_exports(rows).where(F.col("paper_id").isin(11, 12, 13))
    ids = spark.createDataFrame([(12,), (99,)], "id bigint")
    flags = {r.paper_id: r.flag for r in papers.flag_papers(pt, ids).collect()}
    assert flags == {11: 0, 12: 1, 13: 0}
    # empty filter keeps all; {13} keeps only the 2016 paper
    assert ego.keep_papers(rows, []).count() == 6
    kept = ego.keep_papers(rows, [13])
    got = {(r.year, r.collab_id): r.n for r in ego.collab_counts(ego.links_from_exports(kept)).collect()}
    assert got == {(2016, 2): 1, (2016, 4): 1}


def test_read_only_listed_files(spark, tmp_dir):
    write_export(tmp_dir, 1, ADA)
    write_export(tmp_dir, 9, [(91, "2015", [9])])
    rows = exports.read_exports(spark, tmp_dir, files=["9.json"])
    assert [r.author_file for r in rows.select("author_file").distinct().collect()] == [9]
    assert exports.read_exports(spark, tmp_dir, files=[]).count() == 0


def test_name_is_first_self_mention(spark, tmp_dir):
    os.makedirs(tmp_dir, exist_ok=True)
    with open(os.path.join(tmp_dir, "3.json"), "w") as f:
        f.write(json.dumps({"_source": {"id": 1, "year": "2015", "doi": None,
                                        "authors": [{"id": 3, "name": "First"}]}}) + "\n")
        f.write(json.dumps({"_source": {"id": 2, "year": "2016", "doi": None,
                                        "authors": [{"id": 3, "name": "Second"}]}}) + "\n")
    n = ego.names_from_exports(exports.read_exports(spark, tmp_dir)).collect()
    assert [(r.author_id, r.name) for r in n] == [(3, "First")]


def test_author_missing_from_own_list(spark, tmp_dir):
    # author 5's file lists a paper without author 5 (counted; no name found)
    write_export(tmp_dir, 5, [(51, "2015", [6, 7]), (52, "2015", [6])])
    rows = exports.read_exports(spark, tmp_dir)
    assert ego.names_from_exports(rows).count() == 0
    t = {r.pidx: r for r in periods.period_long(
        ego.links_from_exports(rows), ego.paper_rows_from_exports(rows), [(2015, 2016)]).collect()}
    assert (t[0].num_collaborations, t[0].num_papers, t[0].cosine) == (2, 2, 97.0)
    w = periods.period_wide(ego.links_from_exports(rows), ego.paper_rows_from_exports(rows), [(2015, 2016)],
                            ego.names_from_exports(rows)).collect()
    assert (w[0].id, w[0].name) == (5, None)


def test_filtered_first_paper_is_ignored(spark, tmp_dir):
    write_export(tmp_dir, 1, ADA)
    rows = ego.keep_papers(exports.read_exports(spark, tmp_dir), [15, 16])
    t = {r.pidx: r for r in periods.period_long(
        ego.links_from_exports(rows), ego.paper_rows_from_exports(rows), PERIODS).collect()}
    assert t[0].cosine == 99.0 and t[3].cosine == 0.0 and t[3].num_papers == 2
    # an author whose papers are all filtered out has no row
    none = ego.keep_papers(exports.read_exports(spark, tmp_dir), [999])
    assert periods.period_long(ego.links_from_exports(none), ego.paper_rows_from_exports(none), PERIODS).count() == 0


def test_limit_takes_the_first_papers(spark):
    rows = [(p, 2015, a) for p in range(1, 400) for a in (p % 7, p % 7 + 10)]
    a = spark.createDataFrame(rows, "paper_id bigint, year int, author_id bigint")
    for n in (1, 57, 399, 1000):
        assert sorted(map(tuple, graph.limit_papers(a, 2015, n).collect())) == sorted(r for r in rows if r[0] <= n)


def test_single_projection_rows_match_two_branches(spark, tmp_dir):
    write_export(tmp_dir, 1, ADA)
    write_export(tmp_dir, 5, [(51, "2015", [6, 7]), (52, "2016", [])])
    write_export(tmp_dir, 9, [(91, "2015", [9]), (92, "2016", [9, 1, 1])])
    rows = exports.read_exports(spark, tmp_dir)
    two = periods.period_long(ego.links_from_exports(rows), ego.paper_rows_from_exports(rows), PERIODS)
    one = periods.period_long(ego.rows_from_exports(rows), None, PERIODS)
    assert sorted(map(tuple, one.collect())) == sorted(map(tuple, two.collect()))
    assert one.count() == 3 * len(PERIODS)
