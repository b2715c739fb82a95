"""Every registered query against its DuckDB oracle, and plan checks."""

import pytest

import __spark_entry__ as entry
from copub.plans import catalog
from oracle_check import compare, duck_connection

from conftest import SF_SMALL

QUERIES = catalog.queries()
ORACLES = catalog.oracle_sql()

# Reading one large JSON object: running sums over a file's splits, and the cutting of records
SPLITS = {"topic_ids_from_json"}


@pytest.fixture(scope="module")
def duck():
    return duck_connection(SF_SMALL)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, duck, name):
    made = []

    def run(spark, sf_dir):
        made.append(QUERIES[name](spark, sf_dir))
        return made[0]

    r = compare(spark, SF_SMALL, name, run, ORACLES.get(name), duck)
    assert r["status"] == "match", r
    # no Python, nested loop or window in the plan, be it over tables or files
    plan = made[0]._jdf.queryExecution().executedPlan().toString()
    for bad in ("BatchEvalPython", "ArrowEvalPython", "MapInArrow", "CartesianProduct", "BroadcastNestedLoopJoin", "Window ["):
        assert bad not in plan or (name in SPLITS and bad in ("MapInArrow", "Window [")), f"{name}: {bad}"


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert df.columns[:3] == ["author_id", "num_collaborators", "pidx"]
