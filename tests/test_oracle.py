"""Every registered query against its SQL counterpart, on whole tables."""

import os

import pytest
from pyspark.sql import DataFrameWriter

import __spark_entry__ as entry_file
from catalog.oracle import ORACLE
from catalog.queries import REGISTERED
from tests.compare import connect, difference

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")

# Rows through Python, and joins that pair everything with everything.
UNWANTED = ["BatchEvalPython", "ArrowEvalPython", "MapInPandas", "CartesianProduct", "BroadcastNestedLoopJoin"]


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


def test_every_query_has_sql():
    assert REGISTERED.keys() == ORACLE.keys()
    assert REGISTERED.keys() <= entry_file.queries().keys()


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def written(monkeypatch):
    """The plans of everything that a query stages, stores, or writes for the batches of a stream."""
    plans, plain = [], DataFrameWriter.parquet

    def parquet(self, *args, **options):
        plans.append(plan_of(self._df))
        return plain(self, *args, **options)

    monkeypatch.setattr(DataFrameWriter, "parquet", parquet)
    return plans


@pytest.mark.parametrize("name", sorted(REGISTERED))
def test_matches_sql(spark, con, written, name):
    df = REGISTERED[name](spark, FOLDER)
    assert not [node for plan in (plan_of(df), *written) for node in UNWANTED if node in plan]
    assert difference(df, con, ORACLE[name]) is None


def test_entry(spark):
    leaders = entry_file.entry(spark)
    assert leaders.columns[:2] == ["phone", "membershipcode"]
    assert leaders.count() > 0
