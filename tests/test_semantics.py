"""Engine traps (T*) and business rules (B*) on tiny hand-made frames, each at its boundary."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from premiumlake import reference_values as rv
from premiumlake import schemas
from premiumlake.functions.exact import round_ratio
from premiumlake.operators import customer_marts as C
from premiumlake.operators import party_marts as P
from premiumlake.operators.ingest import clean_transactions, ingest_raw
from premiumlake.operators.spine import daily_activity, user_months, user_months_from_policies
from premiumlake.sources.files import policies_from_rows

AT = dt.datetime(2025, 9, 1, 12, 0, 0)


def raw(spark, rows):
    return spark.createDataFrame(rows, schemas.RAW_TRANSACTIONS)


def silver_of(spark, rows):
    return clean_transactions(ingest_raw(raw(spark, rows)))


def one(df):
    rows = df.collect()
    assert len(rows) == 1, rows
    return rows[0]


# --- silver -------------------------------------------------------------------------------------


def test_t1_trailing_newline_is_not_a_timestamp(spark):
    r = one(silver_of(spark, [("1", "1/5/2025 3:07:09\n", "10.00", "EUR", "dronant", "processed")]))
    assert r.created_at_ts is None and r._dq_flags == rv.FLAG_TIMESTAMP and r._is_clean is False


@pytest.mark.parametrize(
    "text,expected",
    [("n/a", None), ("1.5d", None), ("", None), (" 12.50 ", D("12.50")), ("1e3", D("1000.00")), ("-3.456", D("-3.456")), (".5", D("0.50"))],
)
def test_t2_amount_parsing(spark, text, expected):
    r = one(silver_of(spark, [("1", "1/5/2025 3:07:09", text, "EUR", "dronant", "processed")]))
    assert r.premium_amount == expected
    if expected is None:
        assert rv.FLAG_PREMIUM in r._dq_flags


@pytest.mark.parametrize("text", ["13/45/2025 1:00:00", "2/30/2025 1:00:00", "1/5/2025 24:00:00", "2025-01-01"])
def test_t6_impossible_or_misshaped_dates_are_flagged(spark, text):
    r = one(silver_of(spark, [("1", text, "1.00", "EUR", "dronant", "processed")]))
    assert r.created_at_ts is None and r._dq_flags == rv.FLAG_TIMESTAMP


def test_t13_parse_is_zone_stable(spark):
    r = one(silver_of(spark, [("1", "12/31/2025 23:59:59", "1.00", "EUR", "dronant", "processed")]))
    assert r.transaction_date == dt.date(2025, 12, 31) and r.transaction_month == "2025-12"


def test_b1_only_exact_process_is_normalised(spark):
    rows = silver_of(
        spark,
        [
            ("1", "1/5/2025 3:07:09", "1.00", "EUR", "dronant", "process"),
            ("2", "1/5/2025 3:07:09", "1.00", "EUR", "dronant", "Process"),
            ("3", "1/5/2025 3:07:09", "1.00", "EUR", "dronant", None),
        ],
    ).orderBy("transaction_id").collect()
    assert [(r.status, r._status_normalized) for r in rows] == [("processed", True), ("Process", False), (None, None)]


def test_b2_flag_order_and_zero_is_clean(spark):
    rows = silver_of(
        spark,
        [
            ("1", "bad", "-5.00", "EUR", None, "processed"),
            ("2", "1/5/2025 3:07:09", "0.00", "USD", "dronant", "processed"),
        ],
    ).orderBy("transaction_id").collect()
    assert rows[0]._dq_flags == "unparseable_timestamp,negative_premium,missing_party"
    assert rows[1]._dq_flags == "" and rows[1]._is_clean is True  # currency is not part of clean (B3)


# --- monthly mart -------------------------------------------------------------------------------


def test_monthly_rules_b3_b4_b5_b6_t9_t10(spark):
    s = silver_of(
        spark,
        [
            ("1", "1/31/2025 1:00:00", "10.00", "EUR", "dronant", "process"),  # 1 day left of 31
            ("1", "1/1/2025 1:00:00", "0.01", "EUR", "dronant", "processed"),  # duplicate id counts again
            ("2", "1/15/2025 1:00:00", "3.00", "EUR", "dronant", "refunded"),
            ("3", "1/15/2025 1:00:00", "0.00", "EUR", "dronant", "processed"),  # zero: clean, not a sale
            ("4", "2/28/2025 1:00:00", "0.14", "EUR", "dronant", "processed"),  # 0.14/28 = 0.005 → 0.01
            ("5", "3/3/2025 1:00:00", "7.00", "EUR", "getland", "refunded"),  # refund-only month: dropped
        ],
    )
    m = {(r.party, r.month): r for r in P.monthly_premiums(s).collect()}
    assert set(m) == {("dronant", "2025-01"), ("dronant", "2025-02")}
    jan = m[("dronant", "2025-01")]
    assert jan.premium == jan.written_premium == D("10.01")
    assert jan.transaction_count == 2 and jan.refunded_premium == D("3.00") and jan.refund_count == 1
    assert jan.net_premium == D("7.01")
    # 10.00 × 1/31 + 0.01 × 31/31 = 0.3326 → 0.33
    assert jan.earned_premium == D("0.33")
    feb = m[("dronant", "2025-02")]
    assert feb.refunded_premium == D("0.00") and feb.refund_count == 0 and feb.earned_premium == D("0.01")


def test_parts_of_cents_count_and_sums_are_rounded_once(spark):
    s = silver_of(
        spark,
        [
            ("1", "1/31/2025 1:00:00", "0.004", "EUR", "dronant", "processed"),
            ("2", "1/31/2025 1:00:00", "0.004", "EUR", "dronant", "process"),
            ("3", "1/31/2025 1:00:00", "0.003", "EUR", "dronant", "refunded"),
            ("4", "2/28/2025 1:00:00", "1e-3", "EUR", "dronant", "processed"),
            ("5", "3/31/2025 1:00:00", "-0.001", "EUR", "dronant", "processed"),  # negative, not zero
        ],
    )
    flags = {r.transaction_id: (r._dq_flags, r._is_clean) for r in s.collect()}
    assert flags["1"] == ("", True) and flags["5"] == ("negative_premium", False)
    m = {r.month: r for r in P.monthly_premiums(s).collect()}
    assert set(m) == {"2025-01", "2025-02"}
    jan = m["2025-01"]
    assert (jan.written_premium, jan.transaction_count, jan.refunded_premium, jan.refund_count) == (D("0.01"), 2, D("0.00"), 1)
    assert m["2025-02"].written_premium == D("0.00") and m["2025-02"].transaction_count == 1


# --- reconciliation -----------------------------------------------------------------------------


def test_b7_b8_b9_t11_reconciliation(spark):
    mart = spark.createDataFrame(
        [("a", "m1", D("100.00"), D("90.00"), D("10.00"), 3), ("a", "m9", D("5.00"), D("5.00"), D("0.00"), 1)]
        + [("a", m, D(w), D(w), D("0.00"), 1) for m, w in [("m2", "100.50"), ("m3", "1.50"), ("m4", "5.00"), ("m5", "5.00"), ("m6", "1.00")]],
        "party string, month string, written_premium decimal(38,2), net_premium decimal(38,2), refunded_premium decimal(38,2), transaction_count long",
    )
    ledger = spark.createDataFrame(
        [("a", "m1", D("100.00")), ("a", "m2", D("100.00")), ("a", "m3", D("1.49")), ("a", "m4", D("0.00")),
         ("a", "m5", D("-5.00")), ("a", "m6", None), ("a", "m7", D("10.00"))],
        "party string, month string, accounting_premium decimal(18,2)",
    )
    r = {x.month: x for x in P.reconcile(ledger, mart).collect()}
    assert "m9" not in r  # mart-only keys drop out
    assert r["m1"].reconciliation_status == "MATCH" and r["m1"].is_reconciled is True and r["m1"].net_delta == D("-10.00")
    assert r["m2"].reconciliation_status == "NEAR_MATCH" and r["m2"].delta == D("0.50") and r["m2"].delta_pct == D("0.5000")
    assert r["m3"].reconciliation_status == "NEAR_MATCH" and r["m3"].is_reconciled is False  # one cent is not a match
    assert r["m4"].delta_pct is None and r["m4"].reconciliation_status == "DISCREPANCY"
    assert r["m5"].reconciliation_status == "NEAR_MATCH" and r["m5"].delta_pct == D("-200.0000")  # negative-ledger quirk
    assert r["m6"].reconciliation_status == "DISCREPANCY" and r["m6"].is_reconciled is None
    assert r["m7"].finance_premium == D("0.00") and r["m7"].transaction_count == 0 and r["m7"].delta == D("-10.00")


# --- churn, concentration, growth -----------------------------------------------------------------


def _mart(spark, rows):
    return spark.createDataFrame(
        rows,
        "party string, month string, written_premium decimal(38,2), refunded_premium decimal(38,2), "
        "net_premium decimal(38,2), transaction_count long",
    )


def test_b19_churn_flag_uses_rounded_rate(spark):
    m = _mart(spark, [("a", "m1", D("100.00"), D("10.40"), D("89.60"), 1), ("b", "m1", D("100.00"), D("10.50"), D("89.50"), 1), ("c", "m1", D("0.00"), D("1.00"), D("-1.00"), 1)])
    r = {x.party: x for x in P.refund_churn(m).collect()}
    assert (r["a"].churn_rate, r["a"].high_churn) == (D("0.10"), False)
    assert (r["b"].churn_rate, r["b"].high_churn) == (D("0.11"), True)
    assert (r["c"].churn_rate, r["c"].high_churn) == (None, False)


def test_b20_t8_concentration(spark):
    m = _mart(
        spark,
        [("a", "m1", D("1.00"), D("0"), D("1.00"), 1), ("b", "m1", D("1.00"), D("0"), D("1.00"), 1), ("c", "m1", D("1.00"), D("0"), D("1.00"), 1),
         ("a", "m2", D("4.00"), D("0"), D("4.00"), 1), ("b", "m2", D("6.00"), D("0"), D("6.00"), 1),
         ("a", "m3", D("2.00"), D("0"), D("2.00"), 1), ("b", "m3", D("3.00"), D("0"), D("-2.00"), 1),
         ("a", "m4", D("4.00"), D("0"), D("4.00"), 1), ("b", "m4", D("6.00"), D("0"), D("5.00"), 1), ("c", "m4", D("1.00"), D("0"), D("1.00"), 1)],
    )
    r = {(x.month, x.party): x for x in P.concentration(m).collect()}
    assert r[("m1", "a")].hhi_score == D("3333.33") and r[("m1", "a")].concentration_level == "highly_concentrated"
    assert r[("m1", "a")].market_share_pct == D("33.33") and r[("m1", "a")].dominant_party_flag is False
    assert r[("m1", "a")].active_parties == 3
    assert r[("m2", "a")].hhi_score == D("5200.00") and r[("m2", "b")].dominant_party_flag is True
    assert r[("m3", "a")].hhi_score is None and r[("m3", "a")].concentration_level == "highly_concentrated"
    assert r[("m3", "a")].market_share_pct is None and r[("m3", "a")].dominant_party_flag is False
    # shares 0.4, 0.5, 0.1: exactly 40 % is not dominant, 50 % is
    assert r[("m4", "a")].market_share_pct == D("40.00") and r[("m4", "a")].dominant_party_flag is True


def test_b21_growth_uses_previous_available_row(spark):
    m = _mart(spark, [("a", "2025-01", D("100.00"), D("0"), D("0"), 1), ("a", "2025-03", D("150.00"), D("0"), D("0"), 1), ("a", "2025-04", D("0.00"), D("0"), D("0"), 1), ("a", "2025-05", D("10.00"), D("0"), D("0"), 1)])
    r = P.period_growth(m).orderBy("month").collect()
    assert [x.previous_written_premium for x in r] == [None, D("100.00"), D("150.00"), D("0.00")]
    assert [x.percentage_change for x in r] == [None, D("50.00"), D("-100.00"), None]
    assert [x.cumulative_written_premium for x in r] == [D("100.00"), D("250.00"), D("250.00"), D("260.00")]


@pytest.mark.parametrize(
    "num,den,scale,shift,want",
    [(1, 8, 2, 0, "0.13"), (-1, 8, 2, 0, "-0.13"), (1, -8, 2, 0, "-0.13"), (1, 3, 1, 2, "33.3"), (2, 3, 0, 0, "1"), (5, 0, 2, 0, None)],
)
def test_t7_round_ratio_half_away_from_zero(spark, num, den, scale, shift, want):
    df = spark.createDataFrame([(D(num), D(den))], "n decimal(10,0), d decimal(10,0)")
    got = one(df.select(round_ratio(F.col("n"), F.col("d"), scale, shift).alias("r"))).r
    assert got == (None if want is None else D(want))


# --- spine and customer marts ------------------------------------------------------------------------


def sample_policies(spark):
    rows = [
        (u, dt.date.fromisoformat(a), dt.date.fromisoformat(s), dt.date.fromisoformat(c) if c else None, D(p), g)
        for u, a, s, c, p, g in rv.SAMPLE_POLICIES
    ]
    return policies_from_rows(spark, rows)


SAMPLE_AS_OF = dt.date(2025, 7, 31)


def test_t16_inline_null_column_is_typed(spark):
    assert dict(sample_policies(spark).dtypes)["churned_at"] == "date"


def test_b10_t3_t12_spine(spark):
    pol = policies_from_rows(
        spark,
        [
            ("U1", dt.date(2025, 1, 1), dt.date(2025, 1, 30), dt.date(2025, 2, 2), D("9.99"), "legal"),
            ("U2", dt.date(2025, 1, 1), dt.date(2025, 3, 5), dt.date(2025, 3, 4), D("9.99"), "legal"),  # empty spine
            ("U3", dt.date(2025, 1, 1), dt.date(2025, 3, 30), None, D("9.99"), "legal"),  # open → as_of
        ],
    )
    rows = daily_activity(pol, dt.date(2025, 4, 1)).collect()
    by_user = {}
    for r in rows:
        by_user.setdefault(r.user_id, []).append(r)
    assert len(by_user["U1"]) == 4 and "U2" not in by_user and len(by_user["U3"]) == 3
    jan = [r for r in by_user["U1"] if r.activity_date.month == 1][0]
    assert jan.daily_premium == D("0.322258") and jan.days_since_acquisition == 29 and jan.activity_month == "2025-01"


def test_inline_sample_acceptance(spark):
    pol = sample_policies(spark)
    act = daily_activity(pol, SAMPLE_AS_OF)
    assert act.count() == 626
    um = user_months(act)
    kinds = {r.transaction_type: r.n for r in C.classify_user_months(um).groupBy("transaction_type").agg(F.count("*").alias("n")).collect()}
    assert kinds == {"new_business": 3, "renewal": 17, "reactivation": 2}
    ltv = {r.user_id: r.decile for r in C.customer_ltv(um).collect()}
    assert ltv == {"USR004": 1, "USR001": 2, "USR002": 3, "USR003": 4, "USR005": 5}
    cohort = C.cohort_retention(um).where((F.col("cohort_month") == dt.date(2025, 1, 1)) & (F.col("product_group") == "liability"))
    assert all(r.cohort_size is None and r.retention_rate is None for r in cohort.collect())
    assert cohort.schema["cohort_month"].dataType.simpleString() == "date"  # T14


def test_month_level_user_months_equal_daily_aggregation(spark):
    pol = sample_policies(spark)
    a = sorted(tuple(r) for r in user_months(daily_activity(pol, SAMPLE_AS_OF)).collect())
    b = sorted(tuple(r) for r in user_months_from_policies(pol, SAMPLE_AS_OF).collect())
    assert a == b


def _um(spark, rows):
    return spark.createDataFrame(
        [(u, "g", dt.date.fromisoformat(m), dt.date.fromisoformat(a), D(p), dt.date.fromisoformat(a)) for u, m, a, p in rows],
        "user_id string, product_group string, month date, acquisition_month date, premium decimal(38,6), acquisition_date date",
    )


def test_b16_b17_b18_waterfall(spark):
    um = _um(
        spark,
        [
            ("u1", "2025-01-01", "2025-01-01", "10"),  # new
            ("u1", "2025-02-01", "2025-01-01", "10"),  # renewal, lapses into March
            ("u1", "2025-05-01", "2025-01-01", "10"),  # reactivation, lapses into June (no active rows: lost)
            ("u2", "2025-03-01", "2025-02-01", "7"),  # first active month after acquisition: reactivation
        ],
    )
    r = {x.month: x for x in C.premium_waterfall(um).collect()}
    assert set(r) == {dt.date(2025, 1, 1), dt.date(2025, 2, 1), dt.date(2025, 3, 1), dt.date(2025, 5, 1)}
    assert (r[dt.date(2025, 1, 1)].new_business_premium, r[dt.date(2025, 1, 1)].lapse_to_new_business_ratio) == (D("10.00"), D("0.00"))
    assert r[dt.date(2025, 2, 1)].renewal_premium == D("10.00")
    mar = r[dt.date(2025, 3, 1)]
    assert (mar.new_business_premium, mar.renewal_premium, mar.lapsed_premium, mar.net_written_premium) == (D("0.00"), D("0.00"), D("10.00"), D("-10.00"))
    assert mar.lapse_to_new_business_ratio is None
    may = r[dt.date(2025, 5, 1)]
    assert (may.new_business_premium, may.renewal_premium, may.net_written_premium) == (D("0.00"), D("0.00"), D("0.00"))


def test_b12_b13_cohort(spark):
    um = _um(spark, [("u1", "2025-01-01", "2025-01-01", "1"), ("u1", "2025-02-01", "2025-01-01", "1"), ("u2", "2025-02-01", "2025-01-01", "1"), ("u3", "2025-03-01", "2025-02-01", "1")])
    r = {(x.cohort_month, x.months_since_acquisition): x for x in C.cohort_retention(um).collect()}
    assert r[(dt.date(2025, 1, 1), 0)].cohort_size == 1 and r[(dt.date(2025, 1, 1), 1)].active_customers == 2
    assert r[(dt.date(2025, 1, 1), 1)].retention_rate == D("200.0")
    assert r[(dt.date(2025, 2, 1), 1)].cohort_size is None and r[(dt.date(2025, 2, 1), 1)].retention_rate is None


def test_b15_ltv_buckets_half_open(spark):
    df = spark.createDataFrame([(D(x) if x is not None else None,) for x in ["49.999999", "50", "199.99", "200", "500", None]], "v decimal(38,6)")
    got = [r.b for r in df.select(C.ltv_bucket(F.col("v")).alias("b")).collect()]
    assert got == ["0-50 EUR", "50-200 EUR", "50-200 EUR", "200-500 EUR", "500+ EUR", "500+ EUR"]


def test_decimal38_inputs_keep_comparisons_exact(spark):
    """Inputs typed decimal(38,2) must not lose the scale of 4-place tolerances and shares."""
    m = _mart(spark, [("a", "m1", D("4.01"), D("0"), D("4.01"), 1), ("b", "m1", D("3.00"), D("0"), D("3.00"), 1), ("c", "m1", D("3.00"), D("0"), D("3.00"), 1)])
    r = {x.party: x for x in P.concentration(m).collect()}
    assert r["a"].dominant_party_flag is True  # 4.01 > 0.40 × 10.01 = 4.004
    ledger = spark.createDataFrame([("a", "m1", D("401.00"))], "party string, month string, accounting_premium decimal(38,2)")
    mart = spark.createDataFrame([("a", "m1", D("404.99"), D("1"), D("0"), 1)], "party string, month string, written_premium decimal(38,2), net_premium decimal(38,2), refunded_premium decimal(38,2), transaction_count long")
    assert one(P.reconcile(ledger, mart)).reconciliation_status == "NEAR_MATCH"  # 3.99 < 0.01 × 401.00 = 4.01


def test_concentration_thresholds_are_parameters(spark):
    m = _mart(spark, [("a", "m1", D("1.00"), D("0"), D("1.00"), 1), ("b", "m1", D("1.00"), D("0"), D("1.00"), 1),
                      ("c", "m1", D("1.00"), D("0"), D("1.00"), 1), ("d", "m1", D("1.00"), D("0"), D("1.00"), 1)])
    assert {r.concentration_level for r in P.concentration(m).collect()} == {"moderately_concentrated"}  # HHI 2500
    assert {r.concentration_level for r in P.concentration(m, moderate_up_to=2000).collect()} == {"highly_concentrated"}
    assert {r.concentration_level for r in P.concentration(m, competitive_below=3000).collect()} == {"competitive"}
