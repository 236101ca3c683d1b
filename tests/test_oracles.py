"""Every registered query against its SQL at the smallest scale."""

from __future__ import annotations

import pytest
import verify

import __spark_entry__ as entrypoint

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return verify.database(FOLDER)


@pytest.mark.parametrize("name", list(entrypoint.queries()))
def test_query_matches_sql(spark, con, name):
    outcome, _, _ = verify.check(spark, con, FOLDER, name)
    assert outcome in ("ok", "no sql")


def test_every_sql_has_a_query():
    assert set(entrypoint.oracle_sql()) <= set(entrypoint.queries())


def test_entry(spark):
    assert entrypoint.entry(spark).count() > 0
