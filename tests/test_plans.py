"""Plan shape of the registered queries, and properties of the marts that must hold at any scale."""

from __future__ import annotations

import random
import re
from decimal import Decimal as D

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

import __spark_entry__ as entry_mod
from premiumlake.operators.ntile import ntile
from premiumlake.plans.inputs import Inputs
from premiumlake.operators import customer_marts as C
from premiumlake.operators import party_marts as P
from tests.conftest import SF_SMALL

QUERIES = entry_mod.queries()
FORBIDDEN = ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython", "PythonUDF")


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_cross_join_and_no_python_in_plans(spark, name):
    plan = plan_of(QUERIES[name](spark, SF_SMALL))
    for bad in FORBIDDEN:
        assert bad not in plan, f"{name}: {bad}"


def test_monthly_is_one_shuffle_with_partial_aggregation_and_pruned_scan(spark):
    plan = plan_of(QUERIES["monthly_premiums"](spark, SF_SMALL))
    assert plan.count("Exchange hashpartitioning") == 1
    assert "partial_sum" in plan
    assert "o_orderpriority" not in plan  # the scan reads only the columns the mart needs
    assert plan.count("gettimestamp") == 1  # the timestamp is parsed once per row


def test_ltv_has_no_global_window(spark):
    plan = plan_of(QUERIES["customer_ltv"](spark, SF_SMALL))
    assert "ntile(" not in plan.lower()


def test_waterfall_has_no_join(spark):
    i = Inputs(spark, SF_SMALL)
    plan = plan_of(C.premium_waterfall(i.user_months))
    # the only joins are the fixture's customer ⋈ first-order lookup, never a lapse self-join
    assert "LeftOuter" not in plan and "LeftAnti" not in plan


def test_customer_marts_reuse_user_month_partitioning(spark):
    i = Inputs(spark, SF_SMALL)
    plan = re.sub(r"#\d+L?", "", plan_of(C.premium_waterfall(i.user_months)))
    # the user-month aggregate, then one re-partition on (user_id, product_group) that serves
    # both windows; after that only the small (product, month) aggregate shuffles.
    assert plan.count("hashpartitioning(user_id, product_group, month, acquisition_month") == 1
    assert plan.count("hashpartitioning(user_id, product_group, 8)") == 1
    assert plan.count("hashpartitioning(product_group, _groupingexpression") == 1
    assert plan.count("Exchange") - plan.count("BroadcastExchange") == 4  # 1 in the fixture + the 3 above


# --- properties ----------------------------------------------------------------------------------


@pytest.mark.parametrize("seed,n,parts", [(1, 1, 3), (2, 9, 4), (3, 10, 2), (4, 1003, 4), (5, 2500, 7)])
def test_scalable_ntile_equals_ntile(spark, seed, n, parts):
    rnd = random.Random(seed)
    rows = [(i, rnd.choice([None, D(rnd.randint(0, 30))]) if rnd.random() < 0.9 else None) for i in range(n)]
    df = spark.createDataFrame(rows, "id int, v decimal(10,0)")
    order = [F.col("v").desc_nulls_first(), F.col("id").asc()]
    want = {r.id: r.t for r in df.select("id", F.ntile(10).over(Window.orderBy(*order)).alias("t")).collect()}
    got = {r.id: r.t for r in ntile(df, 10, order, out="t", partitions=parts).collect()}
    assert got == want
    sizes = {}
    for t in got.values():
        sizes[t] = sizes.get(t, 0) + 1
    assert max(sizes.values()) - min(sizes.values()) <= 1


def test_spine_sums_to_monthly_premium_over_full_months(spark):
    i = Inputs(spark, SF_SMALL)
    act = i.activity
    full = (
        act.groupBy("user_id", "activity_month", "monthly_premium", "started_at", "churned_at")
        .agg(F.sum("daily_premium").alias("s"), F.count("*").alias("days"), F.max(F.dayofmonth(F.last_day("activity_date"))).alias("dim"))
        .where(F.col("days") == F.col("dim"))
    )
    worst = full.agg(F.max(F.abs(F.col("s") - F.col("monthly_premium"))).alias("w")).collect()[0].w
    assert worst is not None and worst <= D("0.0000155")  # 31 days × half a unit of the 6th place


def test_shares_sum_to_100_and_running_total_ends_at_total(spark):
    i = Inputs(spark, SF_SMALL)
    hhi = P.concentration(i.monthly)
    bad = (
        hhi.groupBy("month")
        .agg(F.sum("market_share_pct").alias("s"), F.count("*").alias("n"), F.min("net_premium").alias("lo"))
        .where((F.col("lo") > 0) & (F.abs(F.col("s") - 100) > F.col("n") * F.lit(D("0.005"))))
    )
    assert bad.count() == 0
    g = P.period_growth(i.monthly)
    last = g.withColumn("rn", F.row_number().over(Window.partitionBy("party").orderBy(F.col("month").desc()))).where("rn = 1")
    totals = i.monthly.groupBy("party").agg(F.sum("written_premium").alias("t"))
    assert last.join(totals, "party").where(F.col("t") != F.col("cumulative_written_premium")).count() == 0


def test_waterfall_classes_partition_active_premium(spark):
    i = Inputs(spark, SF_SMALL)
    um = i.user_months
    cls = C.classify_user_months(um)
    per_kind = cls.agg(F.sum("premium").alias("t")).collect()[0].t
    assert per_kind == um.agg(F.sum("premium").alias("t")).collect()[0].t
    counts = {r.transaction_type: r.n for r in cls.groupBy("transaction_type").agg(F.count("*").alias("n")).collect()}
    assert counts == {"new_business": 108, "renewal": 1127, "reactivation": 59}  # acceptance numbers, sf0.001


def test_hot_user_spine_is_spread_over_tasks(spark):
    """One user holding every policy: the day explode still runs on many tasks."""
    import datetime as dt

    from premiumlake.operators.spine import daily_activity
    from premiumlake.sources.files import policies_from_rows

    base = dt.date(2020, 1, 1)
    rows = [("HOT", base, base + dt.timedelta(days=i), base + dt.timedelta(days=i + 60), D("30.00"), "legal") for i in range(400)]
    spine = daily_activity(policies_from_rows(spark, rows), dt.date(2021, 12, 31))
    per_task = [r.n for r in spine.groupBy(F.spark_partition_id().alias("p")).agg(F.count("*").alias("n")).collect()]
    assert sum(per_task) == 400 * 61
    assert len(per_task) >= 6 and max(per_task) < 0.4 * sum(per_task)


def test_concentration_has_no_window_and_spreads_a_hot_period(spark):
    rows = [("hot" if k % 3 == 0 else f"m{k % 40}", f"p{k}", D(k % 17)) for k in range(3_000)]
    mart = spark.createDataFrame(rows, "month string, party string, net_premium decimal(18,2)")
    mart = mart.withColumn("written_premium", F.col("net_premium")).withColumn("transaction_count", F.lit(1))
    out = P.concentration(mart)
    plan = plan_of(out)
    assert "Window" not in plan and "collect_set" not in plan
    assert re.search(r"hashpartitioning\(month#\d+, party#\d+", plan)  # a period is spread by entity before it is folded
    hot = [r for r in out.collect() if r.month == "hot"]
    values = [v for m, _, v in rows if m == "hot"]
    assert len(hot) == 1000 and {r.active_parties for r in hot} == {1000}
    assert {r.total_net_premium for r in hot} == {sum(values)}
    expected = (D(10000) * sum(v * v for v in values) / (sum(values) ** 2)).quantize(D("0.01"))
    assert {r.hhi_score for r in hot} == {expected}
