"""Every registered query against its SQL, on the smallest tables."""

import pytest
from compare import connect, differences

import __spark_entry__ as entry

SF = "/root/testdata/sf0.001"
QUERIES, SQL = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return connect(SF)


def test_sql_belongs_to_queries():
    assert set(SQL) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, con, name):
    df = QUERIES[name](spark, SF)
    assert differences(spark, con, name, lambda *_: df, SQL[name], SF) == []
    text = df._jdf.queryExecution().toString()
    for word in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython"):
        assert word not in text


@pytest.mark.parametrize("name", ["sampled_donors", "cluster_profile", "kmeans_clusters"])
def test_query_without_sql_gives_rows(spark, name):
    assert QUERIES[name](spark, SF).take(1)


def test_entry(spark):
    assert entry.entry(spark).count() > 0
