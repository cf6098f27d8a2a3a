"""Each query of the catalogue against its SQL on the smallest tables."""

import math
import os

import duckdb
import pytest

from fluvia.plans import catalogue

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no tables here")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    con.sql("SET TimeZone = 'UTC'")
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS FROM '{SF_DIR}/{t}.parquet'")
    return con


def comparable(rows):
    """Rows in an order that small differences of doubles do not change, doubles last."""
    return sorted(rows, key=lambda r: ([repr(x) for x in r if not isinstance(x, float)], [x for x in r if isinstance(x, float)]))


def alike(a, b):
    if isinstance(a, float) and isinstance(b, float):
        return math.isclose(a, b, rel_tol=1e-9, abs_tol=1e-12)
    return type(a) is type(b) and a == b


@pytest.mark.parametrize("name", sorted(catalogue.ORACLES))
def test_query_equals_its_sql(spark, duck, name):
    found = catalogue.QUERIES[name](spark, SF_DIR)
    columns = sorted(found.columns)
    expected = duck.sql(catalogue.ORACLES[name])
    assert columns == sorted(expected.columns)
    a = comparable([tuple(r) for r in found.select(*columns).collect()])
    b = comparable(expected.select(*(duckdb.ColumnExpression(c) for c in columns)).fetchall())
    assert len(a) == len(b) > 0
    for x, y in zip(a, b):
        assert all(map(alike, x, y)), (x, y)

