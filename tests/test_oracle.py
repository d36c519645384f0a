"""Every registered query key equals its DuckDB oracle on sf0.001 (rows, names, values)."""

import pytest

from tables import SF_SMALL
from oracle_check import compare, duck

import __spark_entry__
from __spark_entry__ import entry, oracle_sql, queries
from postsift.plans.registry import load_all

# The optional subpackage's keys have tests of their own in tests/llm.
KEYS = sorted(load_all())


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


def test_every_key_has_an_oracle():
    missing = [k for k in KEYS if k not in oracle_sql()]
    assert missing == []


@pytest.mark.parametrize("key", KEYS)
def test_query_matches_oracle(spark, con, key):
    ok, msg = compare(spark, key, SF_SMALL, con)
    assert ok, msg


def test_entry_survives_without_the_optional_subpackage(monkeypatch):
    import sys

    monkeypatch.setitem(sys.modules, "postsift.llm", None)
    monkeypatch.setitem(sys.modules, "postsift.llm.queries", None)
    assert __spark_entry__._corpus_queries() == ({}, {})
    assert sorted(queries()) == KEYS


def test_entry_runs(spark):
    df = entry(spark)
    assert df.count() > 0
    assert df.columns[:3] == ["company", "domain", "job_title"]
