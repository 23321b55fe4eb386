"""Every registered query against its SQL twin at the smallest scale."""

import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.join(ROOT, "tools"))

import __spark_entry__ as entry  # noqa: E402
from compare import compare, oracle  # noqa: E402

from wanewatch.catalog import load  # noqa: E402

FOLDER = "/root/testdata/sf0.001"
TRAINED = {n for n, f in entry.queries().items() if f.__module__.endswith("model_queries")}
WITH_SQL = sorted(set(load().SQL) - TRAINED)


@pytest.fixture(scope="module")
def con():
    return oracle(FOLDER)


@pytest.mark.parametrize("name", WITH_SQL)
def test_query_matches_sql(spark, con, name):
    note, _ = compare(spark, con, FOLDER, entry.queries()[name], entry.oracle_sql()[name])
    assert note == ""


def test_entry_and_registry(spark):
    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert set(load().QUERIES) <= set(entry.queries())
