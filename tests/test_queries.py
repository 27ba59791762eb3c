"""Every core query on the smallest tables: against its SQL where there is one, else it must run twice alike."""

import pytest

import __spark_entry__ as contract
from sedgeline.plans import catalogue
from tests.compare import assert_same, rows_of

FOLDER = "/root/testdata/sf0.001"
ORACLE = catalogue.oracle_sql()


@pytest.mark.parametrize("name", sorted(catalogue.queries()))
def test_query(spark, name):
    df = catalogue.queries()[name](spark, FOLDER)
    if name in ORACLE:
        assert_same(df, ORACLE[name], FOLDER)
    else:
        columns, rows = rows_of(df)
        assert columns and rows == rows_of(catalogue.queries()[name](spark, FOLDER))[1]


def test_contract(spark):
    assert contract.entry(spark).columns
    assert set(contract.oracle_sql()) <= set(contract.queries())
