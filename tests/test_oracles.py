"""Every registered query against its SQL oracle on the smallest data, and the entry points."""

import os

import pytest

import __spark_entry__ as entry_points
from checks.compare import compare
from checks.load import ORACLES, QUERIES

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test data")


@pytest.fixture(scope="module")
def db():
    import duckdb

    from checks.__main__ import TABLES

    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF_DIR}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, db, name):
    got = QUERIES[name](spark, SF_DIR).toPandas()
    if name not in ORACLES:
        assert len(got) > 0
        return
    assert compare(got, db.execute(ORACLES[name]).df()) is None


def test_every_oracle_belongs_to_a_query():
    assert set(ORACLES) <= set(QUERIES)


def test_entry_points(spark):
    others = entry_points.queries().keys() - QUERIES.keys()
    assert QUERIES.keys() <= entry_points.queries().keys() and all(q == "pipeline" or q.startswith("op") for q in others)
    assert ORACLES.items() <= entry_points.oracle_sql().items()
    if os.path.isdir(entry_points.SMOKE_DIR):
        rows = entry_points.entry(spark).collect()
        assert {r.rule_id for r in rows} == {"SIEM-002", "SIEM-004", "SIEM-005", "SIEM-006", "SIEM-007"}
