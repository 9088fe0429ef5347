import os

import pytest

import __spark_entry__ as entry
from siltworks.plans import registry
from tests.compare import DATA, check

SF = f"{DATA}/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test data")


@pytest.mark.parametrize("name", sorted(registry.ORACLE_SQL))
def test_equals_sql(spark, name):
    check(spark, registry.QUERIES[name], registry.ORACLE_SQL[name], SF)


@pytest.mark.parametrize("name", sorted(set(registry.QUERIES) - set(registry.ORACLE_SQL)))
def test_runs(spark, name):
    df = registry.QUERIES[name](spark, SF)
    assert df.columns and len(df.collect()) > 0


def test_entry(spark):
    assert entry.entry(spark).columns == ["row_id", "selection"]


def test_every_sql_has_its_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())
