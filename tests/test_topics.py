"""Keyed JSON objects read by many tasks, whatever a split begins in."""

import json
import os
import random

import pytest
from pyspark.sql import functions as F

from copub.sources import topics

from test_skew import conf


def awkward(rng, n):
    texts = ["plain", "{", "}", "}}}", "{{", 'a "quoted" {x}', "back\\slash\\", 'end\\"', "", "\n", "é{日}", '"}', '{"id": 99}']
    out = {}
    for i in range(n):
        record = {"title": rng.choice(texts), "id": rng.choice([i, str(i), None, "x"]), "inner": {"id": -5, "t": [{"id": -6, "s": rng.choice(texts)}]}}
        if rng.random() < 0.3:
            record = {"id": i}
        if rng.random() < 0.1:
            record = {"none": rng.choice(texts) * 40}
        out[f"{i}{rng.choice(texts)}"] = record
    return out


def ids_of(objects):
    found = []
    for o in objects:
        for record in o.values():
            try:
                found.append(int(record.get("id")))
            except (TypeError, ValueError):
                pass
    return sorted(found)


@pytest.mark.parametrize("bytes_per_split", [64, 257, 10_000_000])
@pytest.mark.parametrize("indent", [None, 1])
def test_objects_are_read_by_splits(spark, tmp_dir, bytes_per_split, indent):
    rng = random.Random(bytes_per_split)
    objects = [awkward(rng, 60), {}, awkward(rng, 1), awkward(rng, 25)]
    for i, o in enumerate(objects):
        with open(os.path.join(tmp_dir, f"{i}.json"), "w") as f:
            json.dump(o, f, indent=indent, ensure_ascii=i % 2 == 0)
            f.write("\n" * i)
    with conf(spark, **{"spark.sql.files.maxPartitionBytes": str(bytes_per_split), "spark.sql.files.openCostInBytes": "0"}):
        ids = topics.read_topic_ids(spark, tmp_dir)
        records = topics.read_records(spark, tmp_dir)
        got = sorted(r.id for r in ids.collect())
        assert got == ids_of(objects)
        whole = sorted(json.dumps(json.loads(r.record), sort_keys=True) for r in records.collect())
        assert whole == sorted(json.dumps(r, sort_keys=True) for o in objects for r in o.values())
        text = spark.read.text(tmp_dir, lineSep="}")
        assert text.rdd.getNumPartitions() > 20 or bytes_per_split > 1000


def test_null_and_repeated_ids_are_written_once(spark, tmp_dir):
    ids = spark.createDataFrame([(None,), (1,), (1,), (2,), (None,)], "id bigint")
    out = os.path.join(tmp_dir, "t")
    topics.write_topic_ids(ids, out, rows_per_file=1)
    assert sorted(r.id for r in topics.read_topic_ids(spark, out).collect()) == [1, 2]
    topics.write_topic_ids(ids.where("false"), os.path.join(tmp_dir, "none"))


def test_a_large_object_is_read_by_several_tasks(spark, tmp_dir):
    out = os.path.join(tmp_dir, "t")
    topics.write_topic_ids(spark.range(200_000).select("id"), out, rows_per_file=10**9)
    files = [f for d, _, fs in os.walk(out) for f in fs if f.startswith("part-")]
    assert len(files) == 1
    with conf(spark, **{"spark.sql.files.maxPartitionBytes": "1m", "spark.sql.files.openCostInBytes": "0"}):
        ids = topics.read_topic_ids(spark, out).withColumn("task", F.spark_partition_id())
        seen = ids.agg(F.count("id"), F.countDistinct("id"), F.countDistinct("task"), F.sum("id")).first()
    assert seen[0] == seen[1] == 200_000 and seen[3] == sum(range(200_000))
    assert seen[2] >= 4
