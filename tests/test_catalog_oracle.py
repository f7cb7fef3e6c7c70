"""Every registered catalog query against its SQL."""

import pytest
from oracle import assert_same

from loam.plans import catalog

SF = "/root/testdata/sf0.001"


def test_every_query_has_sql():
    assert set(catalog.queries()) == set(catalog.oracle_sql())


@pytest.mark.parametrize("name", sorted(catalog.queries()))
def test_query(spark, name):
    assert_same(catalog.queries()[name], catalog.oracle_sql()[name], spark, SF)
