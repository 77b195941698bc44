"""Every query with SQL agrees with DuckDB; every other one gives rows."""

import pytest
from compare import connect, difference

from __spark_entry__ import entry
from evenkeel.catalog import ORACLES as SQL, QUERIES



@pytest.fixture(scope="module")
def con(sf):
    return connect(sf)


@pytest.mark.parametrize("key", sorted(QUERIES))
def test_query(spark, sf, con, key):
    df = QUERIES[key](spark, sf)
    plan = df._jdf.queryExecution().executedPlan().toString()
    for costly in ("CartesianProduct", "BroadcastNestedLoopJoin", "EvalPython", "MapInPandas", "TakeOrderedAndProject"):
        assert costly not in plan or key == "importance_topn"
    if key in SQL:
        assert difference(df, con, SQL[key]) is None
    else:
        assert df.count() > 0


def test_entry_has_one_row(spark):
    assert entry(spark).count() == 1
