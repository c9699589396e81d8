"""Every SQL-checkable registered query equals its DuckDB twin (sf0.001)."""

import pytest

import __spark_entry__ as E
from tests.conftest import SMALL
from tests.oracle_check import duck, fingerprint

NAMES = sorted(E.oracle_sql())


@pytest.fixture(scope="module")
def con():
    return duck(SMALL)


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    got = E.queries()[name](spark, SMALL).toPandas()
    want = con.execute(E.oracle_sql()[name]).df()
    n1, c1, h1, r1 = fingerprint(got)
    n2, c2, h2, r2 = fingerprint(want)
    assert c1 == c2
    assert n1 == n2
    assert h1 == h2, (sorted(set(r1) - set(r2))[:3], sorted(set(r2) - set(r1))[:3])


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert "total_trips" in df.columns


def test_every_query_has_a_name_from_the_inventory():
    qs = E.queries()
    assert len(qs) >= 100
    assert set(E.oracle_sql()) <= set(qs)
