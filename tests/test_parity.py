"""Every registered query against its SQL on the smallest data set."""

import os

import pytest

from suite import check, registry

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test data")


@pytest.fixture(scope="module")
def con():
    return check.connect(FOLDER)


@pytest.mark.parametrize("key", sorted(registry.queries()))
def test_query(spark, con, key):
    verdict, n, _ = check.compare(key, spark, con, FOLDER, registry.queries(), registry.oracle_sql())
    assert verdict in ("ok", "close"), verdict


def test_every_query_has_sql():
    assert set(registry.queries()) == set(registry.oracle_sql())


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0
