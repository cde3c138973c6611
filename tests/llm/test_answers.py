"""The operators' queries against their SQL, on the smallest data."""

import pytest

from tests.duck import connect, difference, duck_rows, spark_rows
from tradeloom.llm import queries as q


@pytest.mark.parametrize("name", q.oracle_sql())
def test_answer(spark, small_data, name):
    columns, actual = spark_rows(q.queries()[name](spark, small_data))
    with connect(small_data) as con:
        wanted, expected = duck_rows(con, q.oracle_sql()[name])
    assert columns == wanted
    assert actual == expected, difference(actual, expected)


@pytest.mark.parametrize("name", ["op1_secret_scan", "op5_quality_ledger", "op6_exact_dedup"])
def test_native_queries_have_no_python(spark, small_data, name):
    plan = q.queries()[name](spark, small_data)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "InPandas" not in plan
