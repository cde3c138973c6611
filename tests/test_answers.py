"""Every registered query against its SQL, on the smallest data."""

import pytest

import __spark_entry__ as registered
from tests.duck import connect, difference, duck_rows, spark_rows

ANSWERS = registered.expected.all_answers()


def test_every_query_has_an_answer():
    assert set(ANSWERS) == set(registered.reports())
    assert set(registered.oracle_sql()) <= set(registered.queries())


@pytest.mark.parametrize("name", registered.reports())
def test_answer(spark, small_data, name):
    columns, actual = spark_rows(registered.queries()[name](spark, small_data))
    with connect(small_data) as con:
        wanted, expected = duck_rows(con, ANSWERS[name])
    assert columns == wanted
    assert actual == expected, difference(actual, expected)
    assert actual
