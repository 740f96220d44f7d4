"""CSV loads: quoted line breaks, broken records kept with reasons, counts that add up."""

from __future__ import annotations

import uuid
from decimal import Decimal as D

import pytest

from premiumlake.sources import quarantine
from premiumlake.sources.catalog import read_source

LEDGER = 'party,month,accounting_premium\n"A, ""x""\nAB",2025-01,10.25\nB,2025-01,abc\nB,2025-02\nB,2025-03,1,2\n,2025-04,5\n" ",,n/a\nC,2025-05,\nD,2025-06,1e2\n'


@pytest.fixture
def loaded(spark, tmp_path):
    spark.sql("CREATE DATABASE IF NOT EXISTS quarantine_tests")
    (tmp_path / "ledger.csv").write_text(LEDGER)
    return quarantine.load(spark, "accounting_closing", str(tmp_path), f"quarantine_tests.l_{uuid.uuid4().hex[:8]}")


def test_accepted_rows_are_typed_and_whole(loaded):
    rows = {r.party: (r.month, r.accounting_premium) for r in loaded.accepted.collect()}
    assert rows == {'A, "x"\nAB': ("2025-01", D("10.25")), "C": ("2025-05", None), "D": ("2025-06", D("100.00"))}
    assert loaded.accepted.columns == ["party", "month", "accounting_premium"]


def test_rejected_records_keep_text_reasons_and_file(loaded):
    rows = loaded.rejected.collect()
    assert sorted((r.record.replace('"', ""), tuple(r.reasons)) for r in rows) == [
        (" ,,n/a", ("missing party", "missing month", "bad accounting_premium")),
        (",2025-04,5", ("missing party",)),
        ("B,2025-01,abc", ("bad accounting_premium",)),
        ("B,2025-02", ("fields",)),
        ("B,2025-03,1,2", ("fields",)),
    ]
    assert all(r.source_file.endswith("ledger.csv") for r in rows)


def test_counts_add_up(loaded):
    counts = {(r.outcome, r.reason): r.records for r in loaded.counts.collect()}
    assert counts[("accepted", "")] == 3 and counts[("rejected", "fields")] == 2
    assert sum(counts.values()) == 8


def test_unclosed_quote_is_one_rejected_record(spark, tmp_path):
    (tmp_path / "a.csv").write_text('party,month,accounting_premium\nA,2025-01,1\n"B,2025-01,2\nC,2025-01,3\n')
    (tmp_path / "b.csv").write_text("party,month,accounting_premium\nD,2025-01,4\n")
    got = quarantine.load(spark, "accounting_closing", str(tmp_path), f"quarantine_unclosed_{uuid.uuid4().hex[:8]}")
    assert sorted(r.party for r in got.accepted.collect()) == ["A", "D"]
    assert [r.reasons for r in got.rejected.collect()] == [["fields"]]


def test_empty_file_and_other_formats(spark, tmp_path):
    (tmp_path / "a.csv").write_text("party,month,accounting_premium\n")
    got = quarantine.load(spark, "accounting_closing", str(tmp_path), f"quarantine_empty_{uuid.uuid4().hex[:8]}")
    assert (got.accepted.count(), got.rejected.count(), got.counts.count()) == (0, 0, 0)
    with pytest.raises(ValueError):
        quarantine.load(spark, "policies", str(tmp_path), "quarantine_policies")


def test_plain_reader_keeps_quoted_line_breaks(spark, tmp_path):
    (tmp_path / "raw.csv").write_text('transaction_id,created_at,premium_amount,premium_currency,charged_party,status\n1,x,2,EUR,"A\nB",processed\n')
    rows = read_source(spark, "raw_transactions", str(tmp_path)).collect()
    assert [(r.transaction_id, r.charged_party, r.status) for r in rows] == [("1", "A\nB", "processed")]
