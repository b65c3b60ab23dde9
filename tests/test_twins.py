"""Every query of the catalog against its SQL twin, on the smallest tables."""

from __future__ import annotations

import pytest

from forkline.plans import catalog

from .twins import compare, database

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return database(SF)


def test_every_query_has_a_twin():
    assert set(catalog.queries()) == set(catalog.oracle_sql())


@pytest.mark.parametrize("name", sorted(catalog.queries()))
def test_query_equals_its_twin(spark, con, name):
    assert compare(spark, con, SF, catalog.queries()[name], catalog.oracle_sql()[name]) == ""
