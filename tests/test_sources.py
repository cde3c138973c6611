import pytest

from oracles.views import VIEWS, with_views
from tests.duck import connect, difference, duck_rows, spark_rows
from tradeloom.sources.model import ERP_TABLES, schema
from tradeloom.sources.retail import retail_model


@pytest.mark.parametrize("table", ERP_TABLES)
def test_derived_tables_agree(spark, small_data, table):
    """Each model table holds the same rows as its DuckDB view."""
    frame = getattr(retail_model(spark, small_data), table)
    assert frame.schema == schema(table) or [f.dataType for f in frame.schema] == [f.dataType for f in schema(table)]
    with connect(small_data) as con:
        have = set(con.sql(with_views(f"SELECT * FROM {table}")).columns)
        names = [c for c in frame.columns if c in have]
        assert set(frame.columns) - have <= {"local_date"}
        _, expected = duck_rows(con, with_views(f"SELECT {', '.join(names)} FROM {table}"))
    _, actual = spark_rows(frame.select(names))
    assert actual == expected, difference(actual, expected)
    assert sum(actual.values()) > 0
    assert table in VIEWS
