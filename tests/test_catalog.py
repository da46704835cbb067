import pytest
from helpers import FOLDER, connect, rows, sql_rows

from platemark.plans import catalog


@pytest.mark.parametrize("name", sorted(catalog.oracle_sql()))
def test_query_equals_sql(spark, name):
    expected, columns = sql_rows(connect(), catalog.oracle_sql()[name])
    df = catalog.queries()[name](spark, FOLDER)
    assert sorted(df.columns) == columns
    assert rows(df) == expected


def test_every_query_has_sql():
    assert set(catalog.queries()) == set(catalog.oracle_sql())


@pytest.mark.parametrize("name", sorted(catalog.oracle_sql()))
def test_sql_has_rows(name):
    con = connect("/root/testdata/sf0.01")
    assert con.sql(f"SELECT count(*) FROM ({catalog.oracle_sql()[name]}) AS q").fetchall()[0][0] > 0


def test_every_sql_has_a_query():
    assert not set(catalog.oracle_sql()) - set(catalog.queries())
