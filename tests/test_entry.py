"""Driver contract and the whole catalogue against DuckDB on sf0.001."""

import os
import sys

import pytest

from conftest import ROOT, SF_SMALL

sys.path.insert(0, os.path.join(ROOT, "tools"))

import __spark_entry__ as entry_mod  # noqa: E402
from docsift.plans import catalog  # noqa: E402
from oracle_check import compare, duck  # noqa: E402


def test_entry_runs(spark):
    df = entry_mod.entry(spark)
    assert set(df.columns) == {"conv_id", "turn", "rank", "doc_id", "chunk_no", "sim"}
    assert df.count() > 0


def test_every_query_has_an_oracle():
    q, o = catalog.queries(), catalog.oracle_sql()
    assert set(q) == set(o)
    assert set(entry_mod.oracle_sql()) <= set(entry_mod.queries())


@pytest.mark.parametrize("key", sorted(catalog.queries()))
def test_query_matches_oracle(spark, key):
    ok, msg = compare(spark, duck(SF_SMALL), SF_SMALL, key)
    assert ok, msg
