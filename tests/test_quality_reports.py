"""Declared checks, audit suites, profile (B25–B27), report filters and guarded SQL (B24, B28)."""

from __future__ import annotations

from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from premiumlake.operators import guarded_sql as G
from premiumlake.operators import quality as Q
from premiumlake.operators import reports as R


@pytest.fixture
def frame(spark):
    return spark.createDataFrame(
        [("a", "x", 1), ("a", "y", 1), ("b", None, 2), (None, "z", 3), ("c", "z", 3)], "k string, v string, n int"
    )


def report(df):
    return {r.check_name: r for r in df.collect()}


def test_checks_count_like_dbt(spark, frame):
    checks = [
        *Q.not_null("k", "v"),
        Q.unique("k", severity="warn"),
        Q.unique_combination("v", "n"),
        Q.accepted_values("v", ["x", "y"]),
        Q.expression("n_positive", F.col("n") <= 0),
    ]
    r = report(Q.run_suite(frame, checks))
    assert (r["not_null_k"].failures, r["not_null_k"].status) == (1, "fail")
    assert r["unique_k"].failures == 1 and r["unique_k"].status == "warn"  # NULL keys are not duplicates
    assert r["unique_combination_of_v__n"].failures == 1
    assert r["accepted_values_v"].failures == 1  # distinct offending values; NULL passes
    assert r["n_positive"].status == "pass"


def test_b25_broken_check_is_isolated(spark, frame):
    r = report(Q.run_suite(frame, [*Q.not_null("k"), *Q.not_null("missing")]))
    assert r["not_null_missing"].status == "error" and "missing" in r["not_null_missing"].message
    assert r["not_null_k"].failures == 1


def test_b26_b27_audit(spark):
    mart = spark.createDataFrame(
        [("dronant", "2025-01", D("10.00"), D("10.00"), D("1.00"), D("9.00"), D("5.00"), 2),
         ("dronant", "2025-01", D("10.00"), D("10.00"), D("1.00"), D("8.00"), D("5.00"), 2),
         ("other", "2025-02", D("1.00"), D("1.00"), D("0.00"), D("1.00"), None, 1)],
        "party string, month string, premium decimal(28,2), written_premium decimal(28,2), refunded_premium decimal(28,2), "
        "net_premium decimal(28,2), earned_premium decimal(28,2), transaction_count long",
    )
    assert Q.resolve_table("premium numbers") == "gold_fct_monthly_premiums"
    assert Q.resolve_table(None) == "gold_fct_monthly_premiums"
    assert Q.resolve_table("daily kpis") == "gold_fct_customer_activity_daily"
    r = report(Q.audit(mart, "monthly"))
    assert r["row_count"].passed and r["row_count"].metric == 3
    assert not r["null_check"].passed and r["null_check"].metric == 1
    assert not r["uniqueness_check"].passed and r["uniqueness_check"].metric == 1
    assert not r["invalid_party_values"].passed and r["invalid_party_values"].metric == 1
    assert not r["net_premium_sanity"].passed and r["net_premium_sanity"].metric == 1
    assert r["summary_by_party"].passed and r["summary_by_party"].metric == 2
    with pytest.raises(ValueError):
        Q.audit(mart, "gold_fct_unknown")


def test_profile_handles_any_column_name(spark):
    df = spark.createDataFrame([(1, None), (None, "x")], "`a-b` int, c string")
    got = [(r.position, r.column_name, r.data_type, r.row_count, r.null_count) for r in Q.profile(df).orderBy("position").collect()]
    assert got == [(1, "a-b", "int", 2, 1), (2, "c", "string", 2, 1)]


def test_filters(spark):
    df = spark.createDataFrame(
        [("dronant", "1998-01", D("1.005")), ("dronant", "1999-01", D("2")), ("getland", "1998-02", D("3"))],
        "party string, month string, written_premium decimal(28,3)",
    )
    allowed = ("party", "month")
    assert R.apply_filters(df, allowed, {"month": "1998"}).count() == 2
    assert R.apply_filters(df, allowed, {"party": "dronant", "month": "ALL"}).count() == 2
    assert R.apply_filters(df, allowed, {"party": "x' OR '1'='1"}).count() == 3  # unsafe value dropped
    assert R.apply_filters(df, allowed, {"region": "EU", "party": "None"}).count() == 3
    assert R.apply_filters(df, allowed, {"party": "getland"}).count() == 1


def test_b28_reports_round_again(spark):
    df = spark.createDataFrame(
        [("dronant", "1998-01", D("1.005"), D("1.005"), D("0"), 1)],
        "party string, month string, written_premium decimal(28,3), net_premium decimal(28,3), refunded_premium decimal(28,3), transaction_count long",
    )
    r = R.premium_report(df, "party").collect()[0]
    assert r.written_premium == D("1.01") and r.transaction_count == 1


@pytest.mark.parametrize(
    "sql,ok",
    [
        ("SELECT 1 AS x", True),
        ("  with t AS (SELECT 1 AS x) SELECT * FROM t;", True),
        ("INSERT INTO t VALUES (1)", False),
        ("DROP TABLE t", False),
        ("WITH x AS (SELECT 1 AS a) INSERT INTO t SELECT * FROM x", False),
        ("SELECT 1; DROP TABLE t", False),
        ("SELECT 1 -- trailing comment", True),
        ("SELECT nope FROM no_such_table", False),
    ],
)
def test_b24_guarded_select(spark, sql, ok):
    assert G.validate_select(spark, sql)[0] is ok


def test_b24_cap_always_applies_and_errors_are_values(spark):
    spark.range(500).createOrReplaceTempView("r500")
    res = G.run_select(spark, "SELECT id AS limit_col FROM r500", limit=100)
    assert res.ok and res.df.count() == 100
    res = G.run_select(spark, "SELECT * FROM r500 WHERE id > :lo", limit=1000, args={"lo": 494})
    assert res.df.count() == 5
    bad = G.run_select(spark, "DELETE FROM r500")
    assert not bad.ok and bad.df is None and bad.error
    assert G.table_ready(spark, "no_such_table_anywhere") is False


def test_report_dispatch_views_and_ranges(spark):
    from premiumlake.session import CLUSTER_CONF, cluster_conf
    from premiumlake.sources.files import register_views
    from tests.conftest import SF_SMALL

    mart = spark.createDataFrame(
        [("dronant", "1998-01", D("1.00"), D("1.00"), D("0"), 1, D("10.00")), ("getland", "1999-12", D("2.00"), D("2.00"), D("0"), 1, D("90.00"))],
        "party string, month string, written_premium decimal(28,2), net_premium decimal(28,2), refunded_premium decimal(28,2), "
        "transaction_count long, market_share_pct decimal(28,2)",
    )
    assert R.month_range(mart, "1998", "1998").count() == 1
    assert R.month_range(mart, "1998-02", None).count() == 1
    tables = {"gold_fct_monthly_premiums": mart, "some_table": mart}
    assert R.dashboard(tables, None, "party").columns[0] == "party"
    assert R.dashboard(tables, "some_table", filters={"party": "dronant"}).count() == 2  # not an allowed key there
    assert R.default_view("gold_fct_premium_share_by_party", mart).columns == ["month", "party", "market_share_pct"]
    assert R.default_view("anything_else", mart).count() == 2
    register_views(spark, SF_SMALL, ["nation"])
    assert G.run_select(spark, "SELECT count(*) AS n FROM nation").df.collect()[0].n == 25
    saved = {k: spark.conf.get(k, None) for k in CLUSTER_CONF}
    try:
        cluster_conf(spark, {"spark.sql.shuffle.partitions": "8"})
        assert spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes") == CLUSTER_CONF["spark.sql.adaptive.advisoryPartitionSizeInBytes"]
    finally:
        for k, v in saved.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def test_audit_goes_on_without_a_missing_column(spark):
    mart = spark.createDataFrame([("a", "2024-01")] * 2, "party string, month string")
    report = Q.audit(mart, "gold_fct_monthly_premiums")
    got = {r.check_name: (r.passed, r.metric) for r in report.collect()}
    assert got["row_count"] == (True, 2) and got["uniqueness_check"] == (False, 1)
    assert got["null_check"] == got["net_premium_sanity"] == got["summary_by_party"] == (False, None)
    verdict = Q.audit_verdict(report).first()
    assert (verdict.success, verdict.passed, verdict.failed) == (False, 1, len(got) - 1)


def test_guard_decides_on_the_analysed_plan(spark, tmp_path):
    from premiumlake.operators import guarded_sql as G

    path = str(tmp_path / "t.parquet")
    spark.range(3).write.parquet(path)
    spark.read.parquet(path).createOrReplaceTempView("guard_view")
    spark.sql("CREATE TABLE IF NOT EXISTS guard_table USING parquet AS SELECT id FROM range(3)")
    spark.udf.register("guard_udf", lambda x: x, "long")
    allowed = [
        "SELECT id FROM guard_view",
        "SELECT id FROM guard_table",
        "SELECT 'text.`/etc/hostname` and reflect(1)' AS quoted",
        "SELECT id AS `java_method(` FROM guard_table -- parquet.`x`",
        "WITH a AS (SELECT max(id) AS m FROM guard_view) SELECT * FROM a WHERE EXISTS (SELECT 1 FROM guard_table WHERE id = m)",
        "SELECT e, sum(id) OVER (PARTITION BY e) AS s FROM guard_view LATERAL VIEW explode(array(1, 2)) t AS e ORDER BY 1 LIMIT 3",
        "SELECT id FROM guard_view UNION SELECT id FROM guard_table EXCEPT SELECT 1",
    ]
    for sql in allowed:
        assert G.validate_select(spark, sql) == (True, None), sql
    refused = [
        f"SELECT * FROM `parquet`.`{path}`",
        f"SELECT * FROM PARQUET . `{path}`",
        f"SELECT id FROM guard_view WHERE id IN (SELECT id FROM parquet.`{path}`)",
        f"WITH a AS (SELECT * FROM parquet.`{path}`) SELECT count(*) FROM a",
        f"SELECT (SELECT max(id) FROM parquet.`{path}`) AS m",
        "SELECT id FROM guard_view ORDER BY reflect('java.lang.Math', 'abs', 1)",
        "SELECT id FROM guard_view WHERE try_reflect('java.lang.Math', 'abs', 1) = '1'",
        "SELECT guard_udf(id) FROM guard_view",
        "INSERT INTO guard_table SELECT 9",
        "SELECT 1) UNION ALL (SELECT 2); DROP TABLE guard_table; SELECT * FROM (SELECT 1",
    ]
    for sql in refused:
        ok, error = G.validate_select(spark, sql)
        assert not ok and error, sql
    assert spark.table("guard_table").count() == 3


def test_a_daily_combination_is_counted_by_month_and_exactly(spark):
    import datetime as dt

    day = lambda n: dt.date(2021, 1, 1) + dt.timedelta(days=n)
    data = [("a", day(n), 1.5) for n in range(70)] + [("a", day(30), None)] * 5 + [("b", day(0), 0.0), ("b", day(0), -0.0)]
    data += [(None, day(1), 1.0)] * 2 + [("b", None, 1.0)] * 2 + [(None, None, 1.0), ("c", day(31), float("nan")), ("c", day(31), float("nan"))]
    frame = spark.createDataFrame(data, "user string, at date, x double").repartition(5)
    checks = [*Q.not_null("user", "at", "x"), Q.expression("small", F.col("x") < 1), Q.unique_combination("user", "at")]
    got = {r.check_name: r.failures for r in Q.run_suite(frame, checks).collect()}
    combo = "unique_combination_of_user__at"
    assert got == {"not_null_user": 3, "not_null_at": 3, "not_null_x": 5, "small": 2, combo: 5}
    three = Q.run_suite(frame, [Q.unique_combination("user", "at", "x")]).collect()[0]
    assert three.failures == 4  # five rows without x, two of no user, two without day, NaN twice; 0.0 is not -0.0
    assert [r.failures for r in Q.run_suite(frame.where("false"), checks).collect()] == [0] * 5
    # days are combined by month before the shuffle, without a row for each of their keys
    plan = Q.run_suite(frame, checks)._jdf.queryExecution().executedPlan().toString()
    assert "explode(" not in plan and "partial_sum" in plan and "trunc(at" in plan
