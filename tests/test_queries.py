"""Every registered query against its SQL on the smallest tables."""

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent / "tools"))

import __spark_entry__ as entry  # noqa: E402

duckdb = pytest.importorskip("duckdb")


@pytest.fixture(scope="module")
def db(small_sf):
    from check_oracle import connect

    return connect(small_sf)


def test_every_sql_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(entry.queries()))
def test_query(name, spark, small_sf, db):
    from check_oracle import compare

    verdict = compare(entry.queries()[name](spark, small_sf), db, entry.oracle_sql().get(name))
    assert verdict.startswith(("ok", "rows only")), verdict


def test_entry(spark, small_sf):
    assert entry.entry(spark).count() > 0
