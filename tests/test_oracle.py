"""Every query with SQL gives what the SQL gives."""

import pytest

from quern import registry
from tests.oracle import compare


@pytest.mark.parametrize("name", sorted(registry.queries()))
def test_query(spark, sf, name):
    df, sql = registry.queries()[name](spark, sf), registry.oracle_sql().get(name)
    assert compare(df, sql, sf) >= 0 if sql else df.count() > 0
