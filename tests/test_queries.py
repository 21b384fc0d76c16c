"""Every registered query against its SQL, over whole tables of the smallest driver directory."""

import pytest

import __spark_entry__ as entry
from checks import registry
from checks.compare import difference, views
from tests.conftest import SMALL


@pytest.fixture(scope="module")
def con():
    return views(SMALL)


@pytest.mark.parametrize("name", list(registry.QUERIES))
def test_query_equals_its_sql(spark, con, name):
    assert difference(spark, con, SMALL, name) is None


def test_every_query_has_sql():
    assert set(registry.QUERIES) == set(registry.SQL)


def test_no_query_pairs_everything_or_leaves_the_jvm(spark, capsys):
    for name, run in registry.QUERIES.items():
        run(spark, SMALL).explain()
        plan = capsys.readouterr().out
        assert not [w for w in ("CartesianProduct", "NestedLoopJoin", "EvalPython", "InPandas") if w in plan], name


def test_entry(spark):
    assert entry.entry(spark).count() > 0
