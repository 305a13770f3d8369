import importlib

import pytest

entry = importlib.import_module("__spark_entry__")
check = importlib.import_module("check_queries")

SF = "/root/testdata/sf0.001"
EVERY = [f"op{n}_" for n in range(1, 14)]


def test_all_are_registered():
    names = list(entry.queries())
    assert "pipeline" in names
    for start in EVERY:
        assert sum(n.startswith(start) for n in names) == 1


@pytest.mark.parametrize("name", [n for n in entry.oracle_sql() if n.startswith("op")])
def test_queries_equal_their_sql(spark, name):
    problem = check.compare(entry.queries()[name](spark, SF), check.duck(SF), entry.oracle_sql()[name])
    assert problem is None
