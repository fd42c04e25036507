"""Every registered query against its SQL on the same tables."""

import os

import pytest

import compare
from voltscape import oracle, registry

FOLDER = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def connection():
    return compare.open_tables(FOLDER)


def test_every_query_has_sql():
    assert set(registry.QUERIES) == set(oracle.RESULTS)


@pytest.mark.parametrize("name", sorted(registry.QUERIES))
def test_query_equals_sql(name, spark, connection):
    ours, theirs = compare.results(name, spark, FOLDER, connection)
    assert ours[0] == theirs[0]
    assert ours[1] == theirs[1]
