"""Every registered query against its SQL oracle, or at least run to the end."""

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from tests.oracle import connect, differences

SF_DIR = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_matches_oracle(spark, con, name):
    assert differences(queries()[name](spark, SF_DIR), oracle_sql()[name], con) is None


@pytest.mark.parametrize("name", sorted(set(queries()) - set(oracle_sql())))
def test_runs(spark, name):
    assert queries()[name](spark, SF_DIR).count() > 0


def test_entry(spark):
    assert entry(spark).count() > 0
