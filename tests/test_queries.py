import os

import pytest
from folioforge.plans import registry

from . import oracle

needs_data = pytest.mark.skipif(not os.path.isdir(oracle.SF), reason="the driver's tables are not here")


@needs_data
@pytest.mark.parametrize("name", sorted(registry.SQL))
def test_agrees_with_sql(spark, name):
    oracle.agree(spark, registry.QUERIES[name], registry.SQL[name])


@needs_data
@pytest.mark.parametrize("name", sorted(set(registry.QUERIES) - set(registry.SQL)))
def test_runs(spark, name):
    assert registry.QUERIES[name](spark, oracle.SF).count() > 0


@needs_data
def test_entry(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
