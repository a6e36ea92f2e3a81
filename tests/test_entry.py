import os
import sys

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

import pytest
from oracle import same

from lexigraft.plans import catalog

NO_SQL = sorted(set(catalog.QUERIES) - set(catalog.SQL))


@pytest.mark.parametrize("name", sorted(catalog.SQL))
def test_query_equals_sql(spark, sf, name):
    same(spark, sf, catalog.QUERIES[name], catalog.SQL[name])


@pytest.mark.parametrize("name", NO_SQL)
def test_query_runs(spark, sf, name):
    df = catalog.QUERIES[name](spark, sf)
    assert df.count() > 0 and len(set(df.columns)) == len(df.columns)


def test_contract(spark, sf):
    import __spark_entry__ as e

    assert set(e.oracle_sql()) <= set(e.queries())
    assert e.entry(spark).count() > 0
