"""Readers and writers: malformed values, list cells, stores, topic files."""

import json
import os

from pyspark.sql import functions as F

from copub.operators import ego, graph, papers, periods
from copub.sources import papers_csv, stores, topics


def test_papers_csv_parses_list_cells_and_bad_values(spark, tmp_dir):
    path = os.path.join(tmp_dir, "papers.csv")
    with open(path, "w") as f:
        f.write("id_paper,year,doi,authors\n")
        f.write('1,2019,d1,"[1, 2, 3]"\n')
        f.write('2,2019-05-01,d2,"[4]"\n')
        f.write("x3,abcd,d3,not-a-list\n")
    rows = {r.doi: r for r in papers_csv.read_papers_csv(spark, path).collect()}
    assert (rows["d1"].paper_id, rows["d1"].year, rows["d1"].authors) == (1, 2019, [1, 2, 3])
    assert rows["d2"].year == 2019
    assert (rows["d3"].paper_id, rows["d3"].year, rows["d3"].authors) == (None, None, [])


def test_papers_csv_roundtrip_sorted_by_year(spark, tmp_dir):
    df = spark.createDataFrame(
        [(2, 2016, "b", [3, 1]), (1, 2015, "a", [1, 2])], "paper_id bigint, year int, doi string, authors array<bigint>"
    )
    out = os.path.join(tmp_dir, "out")
    papers_csv.write_papers_csv(df.coalesce(1), out)
    text = open([os.path.join(out, f) for f in os.listdir(out) if f.endswith(".csv")][0]).read().splitlines()
    assert text[0] == "id_paper,year,doi,authors"
    assert text[1].startswith("1,2015,a,")
    back = papers_csv.read_papers_csv(spark, out).orderBy("paper_id").collect()
    assert [(r.paper_id, r.authors) for r in back] == [(1, [1, 2]), (2, [3, 1])]


def test_wide_report_csv(spark, tmp_dir):
    a = spark.createDataFrame(
        [(11, 2015, 1), (11, 2015, 2), (12, 2016, 1), (12, 2016, 2)], "paper_id bigint, year int, author_id bigint"
    )
    w = periods.period_wide(ego.links_from_authorship(a), ego.paper_rows_from_authorship(a), [(2015, 2016)])
    out = os.path.join(tmp_dir, "wide")
    papers_csv.write_csv(w, out)
    back = spark.read.schema(w.schema).option("header", True).csv(out)
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, w.collect()))


def test_topic_ids_keyed_object(spark, tmp_dir):
    os.makedirs(os.path.join(tmp_dir, "t"))
    with open(os.path.join(tmp_dir, "t", "topic.json"), "w") as f:
        json.dump({"0": {"id": 12, "title": "x"}, "1": {"id": 99}, "2": {"title": "no id"}}, f, indent=2)
    ids = sorted(r.id for r in topics.read_topic_ids(spark, os.path.join(tmp_dir, "t")).collect())
    assert ids == [12, 99]
    out = os.path.join(tmp_dir, "t2")
    topics.write_topic_ids(spark.range(1, 2501).select(F.col("id")), out, rows_per_file=1000)
    files = [f for d, _, fs in os.walk(out) for f in fs if f.startswith("part-")]
    assert len(files) == 3
    assert topics.read_topic_ids(spark, out).count() == 2500


def test_flag_column_name(spark):
    p = spark.createDataFrame([(1, "a"), (2, "b")], "paper_id bigint, doi string")
    ids = spark.createDataFrame([(2,)], "id bigint")
    got = papers.flag_papers(p, ids, flag_col="on_topic")
    assert got.columns == ["paper_id", "doi", "on_topic"]
    assert {r.paper_id: r.on_topic for r in got.collect()} == {1: 0, 2: 1}


def test_graph_store_partition_pruning(spark, tmp_dir):
    a = spark.createDataFrame(
        [(1, 2015, 1), (1, 2015, 2), (2, 2016, 1), (2, 2016, 3)], "paper_id bigint, year int, author_id bigint"
    )
    path = os.path.join(tmp_dir, "g")
    stores.write_graph(graph.vertices(a), graph.edges(a), path)
    v, e = stores.read_graph(spark, path)
    one = e.where("year = 2016")
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(year" in plan and "(year#" in plan
    assert sorted((r.src, r.dst) for r in one.collect()) == [(1, 3), (3, 1)]
    assert v.count() == 4


def test_exports_skip_lines_that_are_not_papers(spark, tmp_dir):
    from copub.sources import exports

    with open(os.path.join(tmp_dir, "4.json"), "w") as f:
        f.write(json.dumps({"_source": {"id": 1, "year": "2015", "authors": [{"id": 4, "name": "D"}, {"id": 5}]}}) + "\n")
        f.write("{not json\n")
        f.write(json.dumps({"_source": {"id": "x", "year": "2015", "authors": [{"id": 4}]}}) + "\n")
    rows = exports.read_exports(spark, tmp_dir)
    assert rows.count() == 1
    got = ego.year_papers(ego.paper_rows_from_exports(rows)).collect()
    assert [(r.author_id, r.year, r.papers) for r in got] == [(4, 2015, 1)]


def test_flags_one_row_per_id_last_copy(spark):
    p = spark.createDataFrame(
        [(1, "old", 1), (1, "new", 2), (2, "b", 1), (2, "b", 3)], "paper_id bigint, doi string, pos int"
    )
    ids = spark.createDataFrame([(1,), (1,)], "id bigint")
    got = sorted(map(tuple, papers.flag_papers(p, ids, order="pos").collect()))
    assert got == [(1, "new", 1), (2, "b", 0)]
