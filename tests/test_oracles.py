"""Every registered query against its DuckDB oracle on the smallest data set."""

import pytest
from compare import compare, duck

from __spark_entry__ import entry, oracle_sql, queries
from answerloom.suite.queries import QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    assert compare(spark, con, SF, name, queries()[name], oracle_sql().get(name)) is None


def test_only_trained_clusters_lack_an_oracle():
    assert set(QUERIES) - set(oracle_sql()) == {"ivf_trained", "ivf_retrieve_trained"}


def test_entry(spark):
    rows = entry(spark)
    assert rows.count() == 400
    assert set(rows.columns) == {"id", "pid", "rank", "score"}
