"""Every registered query against its SQL twin."""

import os

import pytest

import __spark_entry__ as registry
from tests.compare import database, differences

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def con():
    return database(SF_DIR)


TEXT = {"pipeline", *registry.llm.QUERIES} if registry.llm else set()  # tested in tests/llm
OWN = sorted(set(registry.queries()) - TEXT)


@pytest.mark.parametrize("name", OWN)
def test_query_equals_sql(spark, con, name):
    result = registry.queries()[name](spark, SF_DIR)
    assert differences(result, con, registry.oracle_sql()[name]) is None


def test_every_query_has_sql():
    assert set(OWN) == set(registry.oracle_sql()) - TEXT


def test_entry(spark):
    result = registry.entry(spark)
    assert result.columns == ["content_type", "device", "avg_engagement_pct"]
    assert result.count() > 0
