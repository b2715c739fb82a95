"""Tasks and buckets that grow with the input."""

import os
import re

import pytest

from copub.operators import graph
from copub.session import input_bytes, tasks_for
from copub.sources import stores


@pytest.fixture()
def authorship(spark, tmp_dir):
    path = os.path.join(tmp_dir, "authorship of all")
    rows = spark.range(4000).selectExpr("id div 4 AS paper_id", "2015 AS year", "id * 7 % 101 AS author_id")
    rows.repartition(3).write.parquet(path)
    return spark.read.parquet(path)


def test_input_bytes_are_those_of_the_files(spark, authorship):
    parts = [f for f in os.scandir(os.path.dirname(authorship.inputFiles()[0][7:]).replace("%20", " ")) if f.name.startswith("part-")]
    assert input_bytes(authorship.join(authorship, "paper_id")) == sum(f.stat().st_size for f in parts) > 0
    assert input_bytes(spark.range(5).toDF("id")) == 0
    assert tasks_for(authorship, 1 << 30) == int(spark.conf.get("spark.sql.shuffle.partitions")) and tasks_for(authorship, 1 << 30, 3) == 3


def test_pairs_are_made_by_as_many_tasks_as_the_input_asks_for(authorship, monkeypatch):
    want = sorted(map(tuple, graph.edges(authorship).collect()))
    monkeypatch.setattr(graph, "PAIR_BYTES", 500)
    edges = graph.edges(authorship)
    assert sorted(map(tuple, edges.collect())) == want
    dealt = re.findall(r"hashpartitioning\([^)]*, (\d+)\), REPARTITION_BY_NUM", edges._jdf.queryExecution().executedPlan().toString())
    assert dealt and {int(n) for n in dealt} == {tasks_for(authorship, 500) + 1} and int(dealt[0]) > 20


def test_buckets_grow_with_the_input(spark, authorship, tmp_dir, monkeypatch):
    monkeypatch.setattr(stores, "BUCKET_BYTES", 1000)
    path = os.path.join(tmp_dir, "store")
    v, e = graph.vertices(authorship), graph.edges(authorship)
    stores.write_bucketed_graph(v, e, path, buckets=2)
    assert spark.read.parquet(f"{path}/layout").first()["buckets"] == -(-input_bytes(authorship) // 1000) > 2
    got = graph.vertex_degrees(*stores.read_bucketed_graph(spark, path))
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, graph.vertex_degrees(v, e).collect()))


def test_authorship_is_dealt_before_it_is_made_distinct(spark, monkeypatch):
    from copub.plans import fixtures as fx

    from conftest import SF_SMALL

    for make in (fx.authorship_dense, fx.authorship_sparse):
        monkeypatch.setattr(fx, "DISTINCT_BYTES", 2 << 20)
        want = sorted(map(tuple, make(spark, SF_SMALL).collect()))
        assert len(want) == len(set(want))
        monkeypatch.setattr(fx, "DISTINCT_BYTES", 4000)
        got = make(spark, SF_SMALL)
        assert sorted(map(tuple, got.collect())) == want
        plan = got._jdf.queryExecution().executedPlan().toString()
        (tasks,) = set(re.findall(r", (\d+)\), REPARTITION_BY_NUM", plan))
        assert int(tasks) > int(spark.conf.get("spark.sql.shuffle.partitions"))
