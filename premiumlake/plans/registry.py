"""Registered queries: one Spark plan per operator, each paired with its DuckDB oracle.

Each Spark callable takes ``(spark, sf_dir)`` and returns a lazy DataFrame over the whole
supplied tables. Column names match the oracle's exactly; audit timestamps are never output.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from premiumlake.operators import customer_marts, party_marts
from premiumlake.plans import oracle as O
from premiumlake.operators.spine import user_months
from premiumlake.plans.inputs import Inputs
from premiumlake.plans.scratch import staged

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None):
    def deco(fn: Callable[[Inputs], DataFrame]) -> Callable[[Inputs], DataFrame]:
        QUERIES[name] = lambda spark, sf_dir, _fn=fn: _fn(Inputs(spark, sf_dir))
        if sql is not None:
            ORACLE[name] = sql
        return fn

    return deco


# --- silver --------------------------------------------------------------------------------

SILVER_OUT = (
    "transaction_id, created_at_ts, transaction_date, transaction_month, premium_amount, premium_currency, "
    "party, status, status_raw, _status_normalized, _dq_flags, _is_clean, _source_file"
)


@register("silver_clean", O.with_ctes(f"SELECT {SILVER_OUT} FROM silver", "silver"))
def silver_clean(i: Inputs) -> DataFrame:
    # created_at_ts is shown as a wall-clock value (timestamp without zone), as the oracle has it.
    return i.silver.withColumn("created_at_ts", F.col("created_at_ts").cast("timestamp_ntz"))


@register(
    "silver_dq_flags",
    O.with_ctes(
        "SELECT _dq_flags, _is_clean, count(*) AS row_count FROM silver GROUP BY _dq_flags, _is_clean", "silver"
    ),
)
def silver_dq_flags(i: Inputs) -> DataFrame:
    return i.silver.groupBy("_dq_flags", "_is_clean").agg(F.count(F.lit(1)).alias("row_count"))


@register(
    "silver_status_audit",
    O.with_ctes(
        "SELECT status_raw, status, _status_normalized, count(*) AS row_count FROM silver "
        "GROUP BY status_raw, status, _status_normalized",
        "silver",
    ),
)
def silver_status_audit(i: Inputs) -> DataFrame:
    return i.silver.groupBy("status_raw", "status", "_status_normalized").agg(F.count(F.lit(1)).alias("row_count"))


# --- party marts ---------------------------------------------------------------------------


@register("monthly_premiums", O.with_ctes("SELECT * FROM monthly", "monthly"))
def monthly(i: Inputs) -> DataFrame:
    return i.monthly


@register(
    "earned_premium",
    O.with_ctes(
        "SELECT month, CAST(sum(written_premium) AS DECIMAL(28,2)) AS written_premium, "
        "CAST(sum(earned_premium) AS DECIMAL(28,2)) AS earned_premium FROM monthly GROUP BY month",
        "monthly",
    ),
)
def earned(i: Inputs) -> DataFrame:
    return i.monthly.groupBy("month").agg(
        F.sum("written_premium").cast("decimal(28,2)").alias("written_premium"),
        F.sum("earned_premium").cast("decimal(28,2)").alias("earned_premium"),
    )


@register(
    "refund_only_dropped",
    O.with_ctes(
        "SELECT r.party, r.month, r.refund_count FROM ("
        "SELECT party, transaction_month AS month, count(*) AS refund_count FROM silver "
        "WHERE status_raw = 'refunded' AND _is_clean AND premium_amount > 0 GROUP BY party, transaction_month) r "
        "WHERE NOT EXISTS (SELECT 1 FROM monthly m WHERE m.party = r.party AND m.month = r.month)",
        "silver",
        "monthly",
    ),
)
def refund_only_dropped(i: Inputs) -> DataFrame:
    """Party-months with clean refunds but no sale: the monthly mart leaves them out (T10)."""
    positive_clean = F.col("_is_clean") & (F.col("premium_amount") > 0)
    flags = i.silver.select(
        "party",
        F.col("transaction_month").alias("month"),
        ((F.col("status_raw") == "refunded") & positive_clean).alias("_refund"),
        ((F.col("status") == "processed") & positive_clean).alias("_sale"),
    )
    groups = flags.groupBy("party", "month").agg(
        F.count_if(F.col("_refund")).alias("refund_count"), F.count_if(F.col("_sale")).alias("_sales")
    )
    return groups.where((F.col("refund_count") > 0) & (F.col("_sales") == 0)).drop("_sales")


@register("reconcile", O.with_ctes("SELECT * FROM recon", "recon"))
def reconcile(i: Inputs) -> DataFrame:
    return party_marts.reconcile(i.ledger, i.monthly)


@register(
    "reconcile_status_mix",
    O.with_ctes(
        "SELECT reconciliation_status, is_reconciled, count(*) AS row_count FROM recon "
        "GROUP BY reconciliation_status, is_reconciled",
        "recon",
    ),
)
def reconcile_status_mix(i: Inputs) -> DataFrame:
    return (
        party_marts.reconcile(i.ledger, i.monthly)
        .groupBy("reconciliation_status", "is_reconciled")
        .agg(F.count(F.lit(1)).alias("row_count"))
    )


@register("churn_rate", O.with_ctes("SELECT * FROM churn", "churn"))
def churn(i: Inputs) -> DataFrame:
    return party_marts.refund_churn(i.monthly)


@register("concentration_hhi", O.with_ctes("SELECT * FROM hhi_mart", "hhi_mart"))
def hhi(i: Inputs) -> DataFrame:
    return party_marts.concentration(staged(i.monthly))


@register("mom_growth", O.with_ctes("SELECT * FROM growth", "growth"))
def growth(i: Inputs) -> DataFrame:
    return party_marts.period_growth(i.monthly)


# --- daily spine and customer marts --------------------------------------------------------


@register("daily_activity_rows", O.with_ctes("SELECT * FROM activity", "activity"))
def activity_rows(i: Inputs) -> DataFrame:
    return i.activity


@register(
    "daily_activity_by_month",
    O.with_ctes(
        "SELECT activity_month, product_group, count(*) AS active_days, count(DISTINCT user_id) AS customers, "
        "CAST(sum(daily_premium) AS DECIMAL(28,6)) AS premium FROM activity GROUP BY activity_month, product_group",
        "activity",
    ),
)
def activity_by_month(i: Inputs) -> DataFrame:
    return i.activity.groupBy("activity_month", "product_group").agg(
        F.count(F.lit(1)).alias("active_days"),
        F.countDistinct("user_id").alias("customers"),
        F.sum("daily_premium").cast("decimal(28,6)").alias("premium"),
    )


@register("cohort_retention", O.with_ctes("SELECT * FROM cohort", "cohort"))
def cohort(i: Inputs) -> DataFrame:
    return customer_marts.cohort_retention(i.user_months)


@register("customer_ltv", O.with_ctes("SELECT * FROM ltv", "ltv"))
def ltv(i: Inputs) -> DataFrame:
    return customer_marts.customer_ltv(i.user_months)


@register(
    "ltv_decile_sizes",
    O.with_ctes(
        "SELECT decile, count(*) AS customers, CAST(sum(lifetime_premium) AS DECIMAL(28,6)) AS lifetime_premium "
        "FROM ltv GROUP BY decile",
        "ltv",
    ),
)
def ltv_deciles(i: Inputs) -> DataFrame:
    return (
        customer_marts.customer_ltv(i.user_months)
        .groupBy("decile")
        .agg(F.count(F.lit(1)).alias("customers"), F.sum("lifetime_premium").cast("decimal(28,6)").alias("lifetime_premium"))
    )


@register("user_months", O.with_ctes("SELECT * FROM ump", "ump"))
def user_month_table(i: Inputs) -> DataFrame:
    # the stored-table path: aggregated from the daily spine rows
    return user_months(i.activity)


@register(
    "waterfall_classes",
    O.with_ctes(
        "SELECT transaction_type, count(*) AS user_months, CAST(sum(premium) AS DECIMAL(28,6)) AS premium "
        "FROM kinds GROUP BY transaction_type",
        "kinds",
    ),
)
def waterfall_classes(i: Inputs) -> DataFrame:
    return (
        customer_marts.classify_user_months(i.user_months)
        .groupBy("transaction_type")
        .agg(F.count(F.lit(1)).alias("user_months"), F.sum("premium").cast("decimal(28,6)").alias("premium"))
    )


@register("lapsed_premium", O.with_ctes("SELECT * FROM gone", "gone"))
def lapsed_premium(i: Inputs) -> DataFrame:
    lapses = customer_marts.classify_user_months(i.user_months).where(F.col("lapses_next_month"))
    return lapses.groupBy("product_group", F.add_months("month", 1).alias("month")).agg(
        F.sum("premium").cast("decimal(28,6)").alias("lapsed_premium")
    )


@register("premium_waterfall", O.with_ctes("SELECT * FROM waterfall", "waterfall"))
def waterfall(i: Inputs) -> DataFrame:
    return customer_marts.premium_waterfall(i.user_months)


# --- declared data-quality tests -------------------------------------------------------------

from premiumlake.operators import quality as Q  # noqa: E402

LINEITEM_UNIQUE = [Q.unique("l_orderkey"), Q.unique("l_suppkey", severity="warn")]
LINEITEM_COMBO = [Q.unique_combination("l_orderkey", "l_linenumber"), Q.unique_combination("l_orderkey", "l_partkey", "l_suppkey", severity="warn")]
RAW_NOT_NULL = Q.not_null("transaction_id", "created_at", "premium_amount", "premium_currency", "charged_party", "status")
RAW_ACCEPTED = [c for c in Q.raw_transaction_tests() if c.kind == "accepted_values"]


@register("dq_not_null", O.with_ctes(O.suite_sql("raw", RAW_NOT_NULL), "raw"))
def dq_not_null(i: Inputs) -> DataFrame:
    return Q.run_suite(i.raw, RAW_NOT_NULL)


@register("dq_accepted_values", O.with_ctes(O.suite_sql("raw", RAW_ACCEPTED), "raw"))
def dq_accepted(i: Inputs) -> DataFrame:
    return Q.run_suite(i.raw, RAW_ACCEPTED)


@register("dq_unique", O.suite_sql("lineitem", LINEITEM_UNIQUE))
def dq_unique(i: Inputs) -> DataFrame:
    return Q.run_suite(i.table("lineitem"), LINEITEM_UNIQUE)


@register("dq_unique_combo", O.suite_sql("lineitem", LINEITEM_COMBO))
def dq_unique_combo(i: Inputs) -> DataFrame:
    return Q.run_suite(i.table("lineitem"), LINEITEM_COMBO)


@register("dq_silver_declared", O.with_ctes(O.suite_sql("silver", Q.silver_tests()), "silver"))
def dq_silver(i: Inputs) -> DataFrame:
    return Q.run_suite(i.silver, Q.silver_tests())


@register(
    "dq_gold_declared",
    O.with_ctes(
        "\nUNION ALL\n".join(
            f"SELECT '{name}' AS table_name, * FROM ({O.suite_sql(cte, tests)})"
            for name, cte, tests in [
                ("monthly", "monthly", Q.monthly_tests()),
                ("recon", "recon", Q.recon_tests()),
                ("churn", "churn", Q.party_month_tests()),
                ("hhi", "hhi_mart", Q.concentration_tests()),
                ("growth", "growth", Q.party_month_tests()),
                ("cohort", "cohort", Q.cohort_tests()),
                ("ltv", "ltv", Q.ltv_tests()),
                ("waterfall", "waterfall", Q.waterfall_tests()),
                ("activity", "activity", Q.activity_tests()),
            ]
        ),
        "monthly", "recon", "churn", "hhi_mart", "growth", "cohort", "ltv", "waterfall", "activity",
    ),
)
def dq_gold(i: Inputs) -> DataFrame:
    # what several marts read is written once, so the raw feed is read once; the days are made anew from
    # the written policies where they are read, since writing them takes longer
    silver = staged(i.silver)
    monthly = staged(party_marts.monthly_premiums(silver))
    activity = daily_activity(staged(i.policies), i.as_of, by_month=True)
    months = staged(user_months(activity))
    marts = [
        ("monthly", monthly, Q.monthly_tests()),
        ("recon", staged(party_marts.reconcile(fixtures.accounting_closing(silver), monthly)), Q.recon_tests()),
        ("churn", party_marts.refund_churn(monthly), Q.party_month_tests()),
        ("hhi", party_marts.concentration(monthly), Q.concentration_tests()),
        ("growth", party_marts.period_growth(monthly), Q.party_month_tests()),
        ("cohort", customer_marts.cohort_retention(months), Q.cohort_tests()),
        ("ltv", customer_marts.customer_ltv(months), Q.ltv_tests()),
        ("waterfall", customer_marts.premium_waterfall(months), Q.waterfall_tests()),
        ("activity", activity, Q.activity_tests()),
    ]
    out = None
    for name, df, tests in marts:
        part = Q.run_suite(df, tests).select(F.lit(name).alias("table_name"), "*")
        out = part if out is None else out.unionByName(part)
    return out


# --- mart audit suites -------------------------------------------------------------------------

def _audit_sql(table: str, cte: str, rows: list[tuple[str, str, str]]) -> str:
    return O.with_ctes(
        "\nUNION ALL\n".join(
            f"SELECT '{table}' AS table_name, '{name}' AS check_name, {passed} AS passed, CAST({metric} AS BIGINT) AS metric FROM ({src}) s"
            for name, passed, metric, src in rows
        ),
        cte,
    )


_MONTHLY_NULLS = " + ".join(
    f"count(*) FILTER (WHERE {c} IS NULL)" for c in ["party", "month", "premium", "written_premium", "net_premium", "earned_premium"]
)
_PARTIES_SQL = ", ".join(f"'{p}'" for p in Q.rv.PARTIES)


@register(
    "suite_monthly",
    _audit_sql(
        "gold_fct_monthly_premiums",
        "monthly",
        [
            ("row_count", "true", "n", "SELECT count(*) AS n FROM monthly"),
            ("null_check", "n = 0", "n", f"SELECT {_MONTHLY_NULLS} AS n FROM monthly"),
            ("uniqueness_check", "n = 0", "n", "SELECT count(*) AS n FROM (SELECT party, month FROM monthly GROUP BY party, month HAVING count(*) > 1) d"),
            ("invalid_party_values", "n = 0", "n", f"SELECT count(*) AS n FROM (SELECT party FROM monthly WHERE party NOT IN ({_PARTIES_SQL}) GROUP BY party) d"),
            ("net_premium_sanity", "n = 0", "n", "SELECT count(*) FILTER (WHERE abs(net_premium - (written_premium - refunded_premium)) > 0.01) AS n FROM monthly"),
            ("summary_by_party", "true", "n", "SELECT count(DISTINCT party) + max(CASE WHEN party IS NULL THEN 1 ELSE 0 END) AS n FROM monthly"),
        ],
    ),
)
def suite_monthly(i: Inputs) -> DataFrame:
    return Q.audit(i.monthly, "gold_fct_monthly_premiums")


_RECON_NULLS = " + ".join(
    f"count(*) FILTER (WHERE {c} IS NULL)" for c in ["party", "month", "accounting_premium", "finance_premium", "reconciliation_status"]
)


@register(
    "suite_recon",
    _audit_sql(
        "gold_fct_accounting_reconciliation",
        "recon",
        [
            ("row_count", "true", "n", "SELECT count(*) AS n FROM recon"),
            ("null_check", "n = 0", "n", f"SELECT {_RECON_NULLS} AS n FROM recon"),
            ("uniqueness_check", "n = 0", "n", "SELECT count(*) AS n FROM (SELECT party, month FROM recon GROUP BY party, month HAVING count(*) > 1) d"),
            ("invalid_status_values", "n = 0", "n", "SELECT count(*) AS n FROM (SELECT reconciliation_status FROM recon WHERE reconciliation_status NOT IN ('MATCH', 'NEAR_MATCH', 'DISCREPANCY') GROUP BY 1) d"),
            ("status_distribution", "true", "n", "SELECT count(DISTINCT reconciliation_status) AS n FROM recon"),
            ("top_discrepancies", "true", "n", "SELECT least(count(*), 5) AS n FROM recon"),
        ],
    ),
)
def suite_recon(i: Inputs) -> DataFrame:
    return Q.audit(party_marts.reconcile(i.ledger, i.monthly), "reconciliation")


_ACT_NULLS = " + ".join(f"count(*) FILTER (WHERE {c} IS NULL)" for c in ["user_id", "activity_date", "product_group", "daily_premium"])


@register(
    "suite_activity",
    _audit_sql(
        "gold_fct_customer_activity_daily",
        "activity",
        [
            ("row_count", "true", "n", "SELECT count(*) AS n FROM activity"),
            ("null_check", "n = 0", "n", f"SELECT {_ACT_NULLS} AS n FROM activity"),
            ("uniqueness_check", "n = 0", "n", "SELECT count(*) AS n FROM (SELECT user_id, activity_date FROM activity GROUP BY 1, 2 HAVING count(*) > 1) d"),
            ("date_range", "true", "n", "SELECT count(DISTINCT activity_date) AS n FROM activity"),
            ("customer_summary", "true", "n", "SELECT count(*) AS n FROM (SELECT DISTINCT user_id, product_group FROM activity) d"),
            ("product_group_breakdown", "true", "n", "SELECT count(DISTINCT product_group) AS n FROM activity"),
        ],
    ),
)
def suite_activity(i: Inputs) -> DataFrame:
    return Q.audit(i.activity, "daily activity")


@register(
    "activity_date_range",
    O.with_ctes(
        "SELECT min(activity_date) AS earliest, max(activity_date) AS latest, count(DISTINCT activity_date) AS distinct_dates FROM activity",
        "activity",
    ),
)
def activity_date_range(i: Inputs) -> DataFrame:
    return Q.date_range(i.activity)


@register(
    "audit_verdict",
    "SELECT table_name, bool_and(passed) AS success, count(*) FILTER (WHERE passed) AS passed, "
    f"count(*) FILTER (WHERE NOT passed) AS failed FROM ({ORACLE['suite_monthly']}) r GROUP BY table_name",
)
def audit_verdict(i: Inputs) -> DataFrame:
    return Q.audit_verdict(Q.audit(i.monthly, "gold_fct_monthly_premiums"))


@register(
    "summary_by_party",
    O.with_ctes(
        "SELECT party, count(*) AS months, min(month) AS earliest_month, max(month) AS latest_month, "
        "CAST(sum(written_premium) AS DECIMAL(28,2)) AS total_written_eur, CAST(sum(refunded_premium) AS DECIMAL(28,2)) AS total_refunded_eur, "
        "CAST(sum(net_premium) AS DECIMAL(28,2)) AS total_net_eur, CAST(sum(transaction_count) AS BIGINT) AS total_transactions "
        "FROM monthly GROUP BY party",
        "monthly",
    ),
)
def summary_by_party(i: Inputs) -> DataFrame:
    return Q.suite_monthly(i.monthly)["summary_by_party"]


@register(
    "status_distribution",
    O.with_ctes(
        "SELECT reconciliation_status, count(*) AS occurrences, "
        f"{O.rr('sum(' + O.units('abs(delta)', 2) + ')', 'count(*) * 100', 2)} AS avg_abs_delta_eur, "
        "CAST(max(abs(delta)) AS DECIMAL(28,2)) AS max_abs_delta_eur, "
        f"{O.rr('sum(' + O.units('delta_pct', 4) + ')', 'count(delta_pct) * 10000', 4)} AS avg_delta_pct "
        "FROM recon GROUP BY reconciliation_status",
        "recon",
    ),
)
def status_distribution(i: Inputs) -> DataFrame:
    return Q.status_distribution(party_marts.reconcile(i.ledger, i.monthly))


@register(
    "top_discrepancies",
    O.with_ctes(
        "SELECT party, month, finance_premium, accounting_premium, delta, delta_pct, reconciliation_status "
        "FROM recon ORDER BY abs(delta) DESC, party, month LIMIT 5",
        "recon",
    ),
)
def top_discrepancies(i: Inputs) -> DataFrame:
    return Q.top_discrepancies(party_marts.reconcile(i.ledger, i.monthly))


@register(
    "customer_summary",
    O.with_ctes(
        "SELECT user_id, product_group, min(activity_date) AS first_active, max(activity_date) AS last_active, "
        "count(*) AS active_days, CAST(round(sum(daily_premium), 2) AS DECIMAL(28,2)) AS total_earned_eur, "
        "CASE WHEN max(churned_at) IS NOT NULL THEN 'churned' ELSE 'active' END AS status "
        "FROM activity GROUP BY user_id, product_group",
        "activity",
    ),
)
def customer_summary(i: Inputs) -> DataFrame:
    return Q.customer_summary(i.activity)


@register(
    "product_group_breakdown",
    O.with_ctes(
        "SELECT product_group, count(DISTINCT user_id) AS customers, "
        f"{O.rr('sum(' + O.units('monthly_premium', 2) + ')', 'count(monthly_premium) * 100', 2)} AS avg_monthly_premium_eur, "
        "count(*) FILTER (WHERE churned_at IS NOT NULL) AS churned_user_days FROM activity GROUP BY product_group",
        "activity",
    ),
)
def product_group_breakdown(i: Inputs) -> DataFrame:
    return Q.product_group_breakdown(i.activity)


_LINEITEM_COLS = [
    ("l_orderkey", "bigint"), ("l_partkey", "bigint"), ("l_suppkey", "bigint"), ("l_linenumber", "int"),
    ("l_quantity", "double"), ("l_extendedprice", "double"), ("l_discount", "double"), ("l_tax", "double"),
    ("l_returnflag", "string"), ("l_linestatus", "string"), ("l_shipdate", "timestamp_ntz"),
]


@register(
    "table_profile",
    "\nUNION ALL\n".join(
        f"SELECT {n + 1} AS position, '{c}' AS column_name, "
        "(SELECT CASE data_type WHEN 'BIGINT' THEN 'bigint' WHEN 'INTEGER' THEN 'int' WHEN 'DOUBLE' THEN 'double' "
        "WHEN 'VARCHAR' THEN 'string' WHEN 'TIMESTAMP' THEN 'timestamp_ntz' WHEN 'DATE' THEN 'date' ELSE lower(data_type) END "
        f"FROM information_schema.columns WHERE table_name = 'lineitem' AND column_name = '{c}') AS data_type, "
        f"'YES' AS is_nullable, count(*) AS row_count, count(*) FILTER (WHERE {c} IS NULL) AS null_count FROM lineitem"
        for n, (c, _t) in enumerate(_LINEITEM_COLS)
    ),
)
def table_profile(i: Inputs) -> DataFrame:
    return Q.profile(i.table("lineitem"))


# --- keyed history and loads ---------------------------------------------------------------------

import datetime as _dt  # noqa: E402

from premiumlake.operators import history as H  # noqa: E402
from premiumlake.operators.spine import daily_activity  # noqa: E402
from premiumlake.sources import fixtures  # noqa: E402

SNAP_T1 = _dt.datetime(2025, 1, 1)
SNAP_T2 = _dt.datetime(2025, 2, 1)


@register("scd2_two_batches", O.with_ctes("SELECT * FROM snap_history", "snap_history"))
def scd2(i: Inputs) -> DataFrame:
    b1 = i.silver.select(*[c.strip() for c in O.SNAPSHOT_COLS.split(",")])
    b2 = fixtures.scd2_second_batch(b1)
    h1 = H.scd2_snapshot(None, b1, "transaction_id", ["status", "premium_amount"], SNAP_T1)
    h2 = H.scd2_snapshot(h1, b2, "transaction_id", ["status", "premium_amount"], SNAP_T2)
    fmt = "yyyy-MM-dd HH:mm:ss"
    return h2.withColumn(H.VALID_FROM, F.date_format(H.VALID_FROM, fmt)).withColumn(H.VALID_TO, F.date_format(H.VALID_TO, fmt))


@register(
    "delete_insert",
    O.with_ctes(
        "SELECT * FROM activity t WHERE NOT EXISTS (SELECT 1 FROM activity_batch b "
        "WHERE b.user_id = t.user_id AND b.activity_date = t.activity_date) "
        "UNION ALL SELECT * FROM activity_batch",
        "activity",
        "activity_batch",
    ),
)
def delete_insert(i: Inputs) -> DataFrame:
    # both sides lie by (user, month), so that the days are neither shuffled nor sorted for the join
    target = daily_activity(i.policies, i.as_of, by_month=True)
    batch = daily_activity(fixtures.policies_recut(i.policies, i.table("customer"), i.as_of), i.as_of, by_month=True)
    return H.delete_insert(target, batch, ["user_id", "activity_date"], within=["user_id", "activity_month"])


@register(
    "schema_sync",
    O.with_ctes(
        "SELECT party, month, premium, written_premium, refunded_premium, refund_count, net_premium, transaction_count, "
        "first_transaction_date, last_transaction_date, CAST(NULL AS DECIMAL(28,2)) AS avg_ticket FROM monthly t "
        "WHERE NOT EXISTS (SELECT 1 FROM monthly b WHERE b.month >= '2000-01' AND b.party = t.party AND b.month = t.month) "
        "UNION ALL SELECT party, month, premium, written_premium, refunded_premium, refund_count, net_premium, transaction_count, "
        f"first_transaction_date, last_transaction_date, {O.rr(O.units('written_premium', 2), 'transaction_count * 100', 2)} AS avg_ticket "
        "FROM monthly WHERE month >= '2000-01'",
        "monthly",
    ),
)
def schema_sync(i: Inputs) -> DataFrame:
    from premiumlake.functions.exact import round_ratio

    batch = (
        i.monthly.where(F.col("month") >= "2000-01")
        .withColumn("avg_ticket", round_ratio(F.col("written_premium"), F.col("transaction_count"), 2))
        .drop("earned_premium")
    )
    return H.delete_insert(i.monthly, batch, ["party", "month"], sync=True)


@register(
    "keyed_upsert",
    O.with_ctes(
        "SELECT coalesce(t.c_custkey, b.c_custkey) AS c_custkey, "
        "CASE WHEN t.c_custkey IS NOT NULL THEN t.c_name ELSE b.c_name END AS c_name, "
        "CASE WHEN t.c_custkey IS NOT NULL THEN t.c_nationkey ELSE b.c_nationkey END AS c_nationkey, "
        "CASE WHEN b.c_custkey IS NOT NULL THEN b.c_acctbal ELSE t.c_acctbal END AS c_acctbal, "
        "CASE WHEN t.c_custkey IS NOT NULL THEN t.c_mktsegment ELSE b.c_mktsegment END AS c_mktsegment "
        "FROM customer t FULL OUTER JOIN customer_batch b ON t.c_custkey = b.c_custkey",
        "customer_batch",
    ),
)
def keyed_upsert(i: Inputs) -> DataFrame:
    customer = i.table("customer")
    return H.upsert(customer, fixtures.customer_update_batch(customer), ["c_custkey"], ["c_acctbal"])


@register(
    "keyed_delete",
    "SELECT * FROM customer c WHERE NOT EXISTS (SELECT 1 FROM orders o WHERE o.o_orderstatus = 'P' AND o.o_custkey = c.c_custkey)",
)
def keyed_delete(i: Inputs) -> DataFrame:
    doomed = i.table("orders").where(F.col("o_orderstatus") == "P").select(F.col("o_custkey").alias("c_custkey"))
    return H.delete_keys(i.table("customer"), doomed)


# --- reports ---------------------------------------------------------------------------------

from premiumlake.operators import guarded_sql as G  # noqa: E402
from premiumlake.operators import reports as R  # noqa: E402

_SUMS = (
    "CAST(round(sum(written_premium), 2) AS DECIMAL(28,2)) AS written_premium, "
    "CAST(round(sum(net_premium), 2) AS DECIMAL(28,2)) AS net_premium, "
    "CAST(round(sum(refunded_premium), 2) AS DECIMAL(28,2)) AS refunded_premium"
)


@register(
    "report_by_party",
    O.with_ctes(f"SELECT party, {_SUMS}, CAST(sum(transaction_count) AS BIGINT) AS transaction_count FROM monthly GROUP BY party", "monthly"),
)
def report_by_party(i: Inputs) -> DataFrame:
    return R.premium_report(i.monthly, "party")


@register("report_by_month", O.with_ctes(f"SELECT month, {_SUMS} FROM monthly GROUP BY month", "monthly"))
def report_by_month(i: Inputs) -> DataFrame:
    return R.premium_report(i.monthly, "month")


@register(
    "report_party_month",
    O.with_ctes(f"SELECT party, month, {_SUMS} FROM monthly WHERE party = 'dronant' GROUP BY party, month", "monthly"),
)
def report_party_month(i: Inputs) -> DataFrame:
    # the 'month': 'all' filter is a placeholder and is ignored; 'region' is not an allowed key
    return R.premium_report(i.monthly, "party_month", {"party": "dronant", "month": "all", "region": "EU"})


@register(
    "filters_year_prefix",
    O.with_ctes(f"SELECT month, {_SUMS} FROM monthly WHERE month LIKE '1998-%' GROUP BY month", "monthly"),
)
def filters_year_prefix(i: Inputs) -> DataFrame:
    # a bare year becomes a prefix filter; an unsafe value is dropped instead of reaching SQL
    return R.premium_report(i.monthly, "month", {"month": "1998", "party": "x' OR '1'='1"})


@register(
    "report_recon_party",
    O.with_ctes(
        "SELECT party, CAST(round(sum(finance_premium), 2) AS DECIMAL(28,2)) AS finance_premium, "
        "CAST(round(sum(accounting_premium), 2) AS DECIMAL(28,2)) AS accounting_premium, "
        "CAST(round(sum(delta), 2) AS DECIMAL(28,2)) AS total_delta, "
        f"{O.rr('sum(' + O.units('delta_pct', 4) + ')', 'count(delta_pct) * 10000', 2)} AS avg_delta_pct "
        "FROM recon GROUP BY party",
        "recon",
    ),
)
def report_recon_party(i: Inputs) -> DataFrame:
    return R.recon_report(party_marts.reconcile(i.ledger, i.monthly), "party")


@register(
    "report_recon_detail",
    O.with_ctes(
        "SELECT party, month, CAST(round(finance_premium, 2) AS DECIMAL(28,2)) AS finance_premium, "
        "CAST(round(accounting_premium, 2) AS DECIMAL(28,2)) AS accounting_premium, "
        "CAST(round(delta, 2) AS DECIMAL(28,2)) AS delta, CAST(round(delta_pct, 2) AS DECIMAL(28,2)) AS delta_pct, "
        "reconciliation_status FROM recon WHERE reconciliation_status = 'DISCREPANCY'",
        "recon",
    ),
)
def report_recon_detail(i: Inputs) -> DataFrame:
    return R.recon_report(party_marts.reconcile(i.ledger, i.monthly), "detail", {"reconciliation_status": "DISCREPANCY"})


@register(
    "report_customers",
    O.with_ctes(
        "SELECT product_group, count(DISTINCT user_id) AS customers, "
        "CAST(round(sum(daily_premium), 2) AS DECIMAL(28,2)) AS total_daily_premium, "
        f"{O.rr('sum(' + O.units('monthly_premium', 2) + ')', 'count(monthly_premium) * 100', 2)} AS avg_monthly_premium "
        "FROM activity GROUP BY product_group",
        "activity",
    ),
)
def report_customers(i: Inputs) -> DataFrame:
    return R.customer_report(i.activity)


@register(
    "month_metric",
    O.with_ctes("SELECT DISTINCT month, hhi_score, concentration_level, active_parties FROM hhi_mart", "hhi_mart"),
)
def month_metric(i: Inputs) -> DataFrame:
    return R.month_metric(party_marts.concentration(staged(i.monthly)))


@register("share_by_month", O.with_ctes("SELECT month, party, market_share_pct FROM hhi_mart", "hhi_mart"))
def share_by_month(i: Inputs) -> DataFrame:
    return R.share_by_month(party_marts.concentration(staged(i.monthly)))


@register("top_customers", O.with_ctes("SELECT user_id, product_group, ltv_bucket, lifetime_premium FROM ltv", "ltv"))
def top_customers(i: Inputs) -> DataFrame:
    return R.top_customers(customer_marts.customer_ltv(i.user_months))


# --- guarded SQL over the supplied tables ------------------------------------------------------

RUN_SELECT_SQL = (
    "SELECT o_orderstatus, count(*) AS orders, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DECIMAL(28,2)) AS total_price "
    "FROM orders GROUP BY o_orderstatus"
)
RUN_SELECT_PARAM_SQL = (
    "SELECT c_mktsegment, count(*) AS customers FROM customer WHERE c_acctbal > :min_balance GROUP BY c_mktsegment"
)


def _views(i: Inputs, *names: str) -> None:
    for n in names:
        i.table(n).createOrReplaceTempView(n)


@register("run_select", RUN_SELECT_SQL)
def run_select(i: Inputs) -> DataFrame:
    _views(i, "orders")
    res = G.run_select(i.spark, RUN_SELECT_SQL + ";")
    if not res.ok:
        raise RuntimeError(res.error)
    return res.df


@register("run_select_params", RUN_SELECT_PARAM_SQL.replace(":min_balance", "5000"))
def run_select_params(i: Inputs) -> DataFrame:
    _views(i, "customer")
    res = G.run_select(i.spark, RUN_SELECT_PARAM_SQL, args={"min_balance": 5000})
    if not res.ok:
        raise RuntimeError(res.error)
    return res.df


_STATEMENTS = [
    ("aggregate", "SELECT o_orderstatus, count(*) AS n FROM orders GROUP BY o_orderstatus", True),
    ("subquery", "SELECT o_orderkey FROM orders WHERE o_totalprice = (SELECT max(o_totalprice) FROM orders)", True),
    ("cte", "WITH big AS (SELECT * FROM orders WHERE o_totalprice > 100000) SELECT count(*) AS n FROM big a JOIN big b ON a.o_orderkey = b.o_orderkey", True),
    ("window", "SELECT o_orderkey, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS nth FROM orders", True),
    ("path in a string", "SELECT 'parquet.`/x`, reflect(1)' AS words FROM orders", True),
    ("path", "SELECT * FROM `parquet`.`{path}`", False),
    ("path in a subquery", "SELECT o_orderkey FROM orders WHERE o_custkey IN (SELECT o_custkey FROM parquet.`{path}`)", False),
    ("jvm method", "SELECT java_method('java.lang.Math', 'abs', 1) AS n", False),
    ("jvm method in a cte", "WITH x AS (SELECT try_reflect('java.lang.Math', 'abs', 1) AS n) SELECT n FROM x", False),
    ("insert", "WITH x AS (SELECT 1 AS n) INSERT INTO orders SELECT n FROM x", False),
    ("drop", "DROP VIEW orders", False),
    ("two statements", "SELECT 1; SELECT 2", False),
    ("unknown table", "SELECT * FROM no_such_table", False),
]


@register(
    "validate_select",
    "SELECT statement, allowed, CASE WHEN allowed AND statement = 'aggregate' THEN (SELECT count(DISTINCT o_orderstatus) FROM orders) "
    "WHEN allowed AND statement = 'subquery' THEN (SELECT count(*) FROM orders WHERE o_totalprice = (SELECT max(o_totalprice) FROM orders)) "
    "WHEN allowed AND statement = 'cte' THEN 1 WHEN allowed THEN (SELECT count(*) FROM orders) END AS row_count, "
    "statement <> 'unknown table' AS ready FROM (VALUES "
    + ", ".join(f"('{name}', {str(allowed).lower()})" for name, _, allowed in _STATEMENTS)
    + ") t(statement, allowed)",
)
def validate_select(i: Inputs) -> DataFrame:
    """(statement, allowed, row_count of what is allowed, ready: the table gate) for statements over orders."""
    _views(i, "orders")
    i.spark.catalog.dropTempView("no_such_table")
    path = f"{i.sf_dir.rstrip('/')}/orders.parquet"
    rows = []
    for name, sql, _ in _STATEMENTS:
        result = G.run_select(i.spark, sql.replace("{path}", path))
        ready = G.table_ready(i.spark, "no_such_table" if name == "unknown table" else "orders")
        rows.append((name, result.ok, result.row_count if result.ok else None, ready))
    return i.spark.createDataFrame(rows, "statement string, allowed boolean, row_count long, ready boolean")
