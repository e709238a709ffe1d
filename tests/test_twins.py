"""Every bound query against its SQL twin on the smallest tables."""

import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path[:0] = [ROOT, os.path.join(ROOT, "tools")]

import __spark_entry__ as entry  # noqa: E402
import twin_check  # noqa: E402

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return twin_check.connect(FOLDER)


@pytest.mark.parametrize("name", sorted(entry.queries()))
def test_twin(spark, con, name):
    df = entry.queries()[name](spark, FOLDER)
    text = entry.oracle_sql().get(name)
    if text:
        assert twin_check.compare(df, con, text) == ""
    else:
        assert df.count() > 0


def test_entry(spark):
    assert entry.entry(spark).columns[0] == "session_id"


def test_twins_belong_to_queries():
    assert set(entry.oracle_sql()) <= set(entry.queries())
