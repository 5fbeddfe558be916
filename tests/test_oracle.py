"""Every registered query against its DuckDB oracle (exact values)."""

import pytest

from storeops.plans import CATALOGUE
from tests.compare import compare


@pytest.mark.parametrize("name", list(CATALOGUE))
def test_query(name, spark, duck, data_dir):
    q = CATALOGUE[name]
    df = q.run(spark, data_dir)
    if q.sql is None:
        assert df.count() > 0
    else:
        problem = compare(df, duck, q.sql)
        assert problem is None, problem


def test_contract():
    import __spark_entry__ as entry

    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert set(CATALOGUE) <= set(entry.queries())
