import pytest

import __spark_entry__ as entry
import check
from queries.registry import QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    return check.connect(SF)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, duck, name):
    sql = entry.oracle_sql()[name]
    result = entry.queries()[name](spark, SF)
    plan = result._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan
    same, text = check.compare(spark, duck, SF, name, lambda *_: result, sql)
    assert same, text


def test_entry(spark):
    assert entry.entry(spark).count() > 0
