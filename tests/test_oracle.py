"""Every query against its SQL counterpart on the smallest tables."""

from __future__ import annotations

import os

import pytest
from compare import compare, duck

from exercises.oracle import ORACLE
from exercises.queries import REGISTRY

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="test tables not present")


@pytest.fixture(scope="module")
def con():
    return duck(SF_DIR)


def test_every_sql_has_a_query():
    assert set(ORACLE) <= set(REGISTRY)


@pytest.mark.parametrize("name", list(ORACLE))
def test_query_agrees_with_sql(spark, con, name):
    assert compare(spark, con, name, REGISTRY[name], ORACLE[name], SF_DIR) is None
