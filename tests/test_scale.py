"""Scale smoke: representative marts at sf0.1 equal their oracle."""

from __future__ import annotations

import duckdb
import pytest

import __spark_entry__ as entry_mod
from premiumlake.sources.files import TEST_TABLES
from tests.helpers import canon

SF = "/root/testdata/sf0.1"


@pytest.fixture(scope="module")
def duck_big():
    con = duckdb.connect()
    for t in TEST_TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", ["monthly_premiums", "concentration_hhi", "customer_ltv", "premium_waterfall"])
def test_sf01_matches_oracle(spark, duck_big, name):
    df = entry_mod.queries()[name](spark, SF)
    got = [tuple(r) for r in df.collect()]
    rel = duck_big.sql(entry_mod.oracle_sql()[name])
    want = rel.fetchall()
    assert len(got) == len(want)
    assert canon(df.columns, got) == canon(rel.columns, want)
