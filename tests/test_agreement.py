"""Every registered query against its SQL on the smallest tables."""

import os

import pytest

from agreement import connect, disagreement
from merclake.plans.catalogue import QUERIES, SQL

SF = os.environ.get("AGREEMENT_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")


@pytest.fixture(scope="module")
def tables():
    return connect(SF)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, tables, name):
    df = QUERIES[name](spark, SF)
    if name in SQL:
        assert disagreement(tables, df, SQL[name]) is None
    else:
        assert df.count() > 0
