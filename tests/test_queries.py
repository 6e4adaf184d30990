"""Every query against its SQL, on the smallest tables."""

import pytest

import __spark_entry__ as entry
from compare import connect, differences
from rillflow.plans.catalog import QUERIES
from rillflow.plans.oracle import ORACLES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF)


def test_every_oracle_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert set(QUERIES) == set(ORACLES)


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns == ["endpoint", "n"] and df.count() == 10


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, con, name):
    assert differences(spark, con, name, SF) is None


def test_clustering_covers_the_connected_documents(spark):
    found = entry.queries()["graph_pic"](spark, SF)
    pairs = entry.queries()["tags_similar_pairs"](spark, SF)
    assert {r.id for r in found.collect()} == {r.src for r in pairs.collect()}


def test_contenders_are_counted_batch_by_batch(spark):
    """Not in one plan, whose additions would share a task."""
    plan = entry.queries()["contender_counts"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "Aggregate" not in plan
