"""Every registered query gives the rows of its SQL."""

import pytest

import __spark_entry__ as entry
from check import compare, duck
from panelcast.queries import REGISTRY

SF = "/root/testdata/sf0.001"
#: Queries without a row at this size: their place or segment has no sales yet.
EMPTY = {"channel_extract", "dosage_units", "dosage_form_gate", "second_channel", "equal_share_allocation"}


@pytest.fixture(scope="module")
def con():
    return duck(SF)


def test_every_query_has_sql():
    assert all(sql for _, sql in REGISTRY.values())
    assert REGISTRY.keys() <= entry.oracle_sql().keys()


@pytest.mark.parametrize("name", list(REGISTRY))
def test_query_equals_sql(spark, con, name):
    problem = compare(spark, con, SF, entry.queries()[name], entry.oracle_sql()[name])
    assert problem == ("no rows" if name in EMPTY else "")


def test_entry(spark):
    df = entry.entry(spark)
    assert df.count() > 0 and "units" in df.columns
