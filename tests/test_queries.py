"""Every registered query on the smallest tables, beside its SQL where it has one."""

from pathlib import Path

import pytest

import __spark_entry__ as entry
from check_queries import compare, duck
from docsignal.plans.queries import QUERIES

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(SF).exists(), reason="test tables absent")


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_runs_and_equals_its_sql(spark, con, name):
    result, sql = entry.queries()[name](spark, SF), entry.oracle_sql().get(name)
    if sql is None:
        assert result.count() > 0
    else:
        assert compare(result, con, sql) is None


def test_every_oracle_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry(spark):
    result = entry.entry(spark)
    assert result.columns == ["doc_id", "label", "md_score", "knn_score"]
    assert result.count() > 0
