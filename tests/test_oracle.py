"""Every registered query equals its DuckDB oracle on the smallest supplied tables.

The driver repeats this at sf0.01; here sf0.001 keeps the suite fast. Queries of the optional
subpackage that SQL cannot express are held against brute force in ``tests/llm``.
"""

from __future__ import annotations

import pytest

import __spark_entry__ as entry_mod
from premiumlake.plans import registry
from tests.conftest import SF_SMALL
from tests.helpers import canon

ORACLE = entry_mod.oracle_sql()
QUERIES = entry_mod.queries()


def test_every_query_has_an_oracle():
    assert set(registry.QUERIES) == set(registry.ORACLE)
    assert set(registry.QUERIES) <= set(QUERIES) and set(ORACLE) <= set(QUERIES)


def test_entry_smoke(spark):
    df = entry_mod.entry(spark)
    assert df.count() == 301
    assert df.columns[:4] == ["party", "month", "premium", "written_premium"]


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_oracle(spark, duck, name):
    df = QUERIES[name](spark, SF_SMALL)
    got_cols, got = df.columns, [tuple(r) for r in df.collect()]
    rel = duck.sql(ORACLE[name])
    want_cols, want = rel.columns, rel.fetchall()
    assert sorted(got_cols) == sorted(want_cols)
    assert len(got) == len(want)
    assert canon(got_cols, got) == canon(want_cols, want)


def test_refund_only_months_exist(spark):
    """The monthly mart must drop them, so some have to be there."""
    assert QUERIES["refund_only_dropped"](spark, SF_SMALL).count() > 0
