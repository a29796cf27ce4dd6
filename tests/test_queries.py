"""Every registered query beside its SQL counterpart, on the smallest given tables."""

import os

import pytest

from workload.compare import differences
from workload.oracles import ORACLES
from workload.queries import QUERIES

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


def test_every_query_has_a_counterpart():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no given tables")
@pytest.mark.parametrize("name", list(QUERIES))
def test_same_as_sql(spark, name):
    found, _ = differences(spark, FOLDER, name)
    assert not found
