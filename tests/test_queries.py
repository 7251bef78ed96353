"""Every registered query against its SQL on the smallest tables."""

import pytest
from compare import check_engine, difference

from __spark_entry__ import entry, oracle_sql, queries

SF, LARGER = "/root/testdata/sf0.001", "/root/testdata/sf0.01"
SQL = oracle_sql()


@pytest.fixture(scope="module")
def con():
    return check_engine(SF)


@pytest.mark.parametrize("name", sorted(queries()))
def test_query(spark, con, name):
    df = queries()[name](spark, SF)
    rows = [tuple(r) for r in df.collect()]
    if name not in SQL:
        # what a search looks for may not occur in the smallest table
        assert rows or queries()[name](spark, LARGER).count()
        return
    result = con.execute(SQL[name])
    assert df.columns == [d[0] for d in result.description]
    assert difference(rows, result.fetchall(), df.columns) is None


def test_entry_is_the_flagship(spark):
    df = entry(spark)
    assert "value_p50" in df.columns and df.limit(1).count() == 1
