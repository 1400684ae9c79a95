"""Every registered query against its SQL in DuckDB."""

import pytest

import __spark_entry__ as entry_point
from conftest import TESTDATA
from tools.check_oracle import compare, duck


@pytest.fixture(scope="module")
def con():
    return duck(f"{TESTDATA}/sf0.001")


@pytest.mark.parametrize("name", sorted(entry_point.oracle_sql()))
def test_query(spark, con, name):
    ok, detail = compare(spark, con, f"{TESTDATA}/sf0.001", name)
    assert ok, detail


def test_every_query_has_an_oracle():
    own = set(entry_point.queries())
    if entry_point.llm is not None:  # some of these have no SQL; their own tests check them
        own -= {*entry_point.llm.QUERIES, "pipeline"}
    assert own <= set(entry_point.oracle_sql()) <= set(entry_point.queries())


def test_entry(spark):
    report = entry_point.entry(spark).collect()
    assert len(report) == 11
    assert sum(r.intervention_required == "YES" for r in report) == 1
