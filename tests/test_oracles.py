"""Every query with SQL gives that SQL's rows on the smallest tables; the others run."""

import glob
import math
import os

import duckdb
import pytest

from tesserae.plans import catalogue_queries, check_queries, file_queries, relational_queries, workflow_queries

SF = "/root/testdata/sf0.001"
MODULES = (relational_queries, check_queries, catalogue_queries, workflow_queries, file_queries)
QUERIES = {k: f for m in MODULES for k, f in m.QUERIES.items()}
ORACLES = {k: f for m in MODULES for k, f in m.ORACLES.items()}
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no tables here")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for path in glob.glob(f"{SF}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    return con


def plain(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return "null"
    return round(float(value), 6) if isinstance(value, (int, float)) and not isinstance(value, bool) else str(value)


def rows(columns, records):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(plain(r[i]) for i in order) for r in records), key=str)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    found = QUERIES[name](spark, SF)
    got = rows(found.columns, [tuple(r) for r in found.collect()])
    if name in ORACLES:
        cursor = duck.execute(ORACLES[name])
        columns = [c[0] for c in cursor.description]
        assert sorted(columns) == sorted(found.columns)
        assert got == rows(columns, cursor.fetchall())
