"""Party × month marts: monthly premiums (M3), ledger reconciliation (M4), refund churn (M9),
concentration / HHI (M10) and period growth (M11).

Plan shape at scale: the only pass over the transaction volume is ``monthly_premiums`` — one
hash aggregate with map-side partial aggregation, so a party holding a third of all rows is
combined on every mapper before the shuffle, and the shuffle carries at most one partial row per
(party, month) per task. Everything downstream works on the small party-month grain: windows
partitioned by month or party instead of self-joins, and a left join whose strategy AQE picks
from runtime sizes.
"""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from premiumlake import reference_values as rv
from premiumlake.functions.calendar import days_in_month, days_left_in_month
from premiumlake.functions.exact import MONEY, round_ratio


def _audit(df: DataFrame, name: str, at: dt.datetime | None) -> DataFrame:
    return df if at is None else df.withColumn(name, F.lit(at).cast("timestamp"))


def monthly_premiums(silver: DataFrame, at: dt.datetime | None = None) -> DataFrame:
    """Written, refunded, net and earned premium per (party, month).

    Sales are clean rows whose *normalised* status is ``processed``; refunds are clean rows
    whose *raw* status is ``refunded``; both need a strictly positive amount. The two filtered
    aggregates of the reference are fused into one conditional aggregate (one scan, one
    shuffle); party-months with refunds but no sales are dropped, as the reference's left join
    from sales drops them. Earned premium prorates each sale by the days left in its month:
    Σ(amount × days_left) is exact and divided once by the month length (constant in a group).
    """
    # No `where` on silver's derived columns: Catalyst would push such a filter below silver's
    # projection and inline the timestamp / amount parsing into it, parsing every row twice.
    # The conditions ride inside the conditional aggregates instead; groups without a sale are
    # dropped after the (map-side combined) aggregate.
    positive_clean = F.col("_is_clean") & (F.col("premium_amount") > 0)
    eligible = silver.select(
        "party",
        F.col("transaction_month").alias("month"),
        "premium_amount",
        "transaction_date",
        ((F.col("status") == "processed") & positive_clean).alias("_sale"),
        ((F.col("status_raw") == "refunded") & positive_clean).alias("_refund"),
    )
    sale, refund, amount = F.col("_sale"), F.col("_refund"), F.col("premium_amount")
    agg = eligible.groupBy("party", "month").agg(
        F.sum(F.when(sale, amount)).cast(MONEY).alias("written_premium"),
        F.sum(F.when(sale, amount * days_left_in_month(F.col("transaction_date")))).alias("_prorated"),
        F.max(F.when(sale, days_in_month(F.col("transaction_date")))).alias("_month_days"),
        F.count(F.when(sale, 1)).alias("transaction_count"),
        F.min(F.when(sale, F.col("transaction_date"))).alias("first_transaction_date"),
        F.max(F.when(sale, F.col("transaction_date"))).alias("last_transaction_date"),
        F.coalesce(F.sum(F.when(refund, amount)), F.lit(0)).cast(MONEY).alias("refunded_premium"),
        F.count(F.when(refund, 1)).alias("refund_count"),
    )
    out = agg.where(F.col("transaction_count") > 0).select(
        "party",
        "month",
        F.col("written_premium").alias("premium"),
        "written_premium",
        "refunded_premium",
        "refund_count",
        (F.col("written_premium") - F.col("refunded_premium")).cast(MONEY).alias("net_premium"),
        round_ratio(F.col("_prorated"), F.col("_month_days"), 2).alias("earned_premium"),
        "transaction_count",
        "first_transaction_date",
        "last_transaction_date",
    )
    return _audit(out, "_created_at", at)


def reconcile(
    ledger: DataFrame,
    mart: DataFrame,
    keys: tuple[str, ...] = ("party", "month"),
    abs_tol: str = rv.RECON_ABS_TOLERANCE,
    rel_tol: str = rv.RECON_REL_TOLERANCE,
    at: dt.datetime | None = None,
) -> DataFrame:
    """Ledger-driven comparison of accounting figures with the mart's written premium.

    Keys only in the mart drop out; ledger keys without mart rows compare against 0. Status:
    MATCH when |delta| < abs_tol; else NEAR_MATCH when |delta| / ledger < rel_tol (a zero ledger
    gives a NULL ratio, a negative ledger a negative one, which is always below the tolerance);
    else DISCREPANCY. A NULL ledger figure is a DISCREPANCY with a NULL ``is_reconciled``.

    Deliberate divergence: the reference compares in double precision, where a difference of
    exactly one cent is sometimes below 0.01; here all figures are decimals, so a one-cent
    difference is never a MATCH.
    """
    finance = mart.select(
        *keys,
        F.col("written_premium").alias("_w"),
        F.col("net_premium").alias("_n"),
        F.col("refunded_premium").alias("_r"),
        F.col("transaction_count").alias("_c"),
    )
    joined = ledger.select(*keys, F.col("accounting_premium").cast(MONEY).alias("accounting_premium")).join(
        finance, list(keys), "left"
    )
    acct = F.col("accounting_premium")
    fin = F.coalesce(F.col("_w"), F.lit(Decimal("0.00"))).cast(MONEY)
    diff = fin - acct
    abs_diff = F.abs(diff)
    tol_a, tol_r = F.lit(Decimal(abs_tol)), F.lit(Decimal(rel_tol))
    # |diff| / acct < rel_tol, exactly: multiply out instead of dividing (sign of acct matters).
    near = F.when(acct > 0, abs_diff < tol_r * acct).when(acct < 0, F.lit(True))
    status = (
        F.when(abs_diff < tol_a, F.lit("MATCH"))
        .when(near, F.lit("NEAR_MATCH"))
        .otherwise(F.lit("DISCREPANCY"))
    )
    out = joined.select(
        *keys,
        acct.alias("accounting_premium"),
        fin.alias("finance_premium"),
        F.coalesce(F.col("_n"), F.lit(Decimal("0.00"))).cast(MONEY).alias("net_premium"),
        F.coalesce(F.col("_r"), F.lit(Decimal("0.00"))).cast(MONEY).alias("refunded_premium"),
        (F.coalesce(F.col("_n"), F.lit(Decimal("0.00"))) - acct).cast(MONEY).alias("net_delta"),
        F.coalesce(F.col("_c"), F.lit(0)).cast("long").alias("transaction_count"),
        diff.cast(MONEY).alias("delta"),
        round_ratio(abs_diff, acct, 4, shift=2).alias("delta_pct"),
        status.alias("reconciliation_status"),
        (abs_diff < tol_a).alias("is_reconciled"),
    )
    return _audit(out, "_reconciled_at", at)


def refund_churn(mart: DataFrame, threshold: str = rv.HIGH_CHURN_RATE, at: dt.datetime | None = None) -> DataFrame:
    """Refund rate = refunded / written rounded to 2 places; the flag tests the *rounded* rate
    (0.104 → 0.10 → not high) and a NULL rate is not high."""
    rate = round_ratio(F.col("refunded_premium"), F.col("written_premium"), 2)
    out = mart.select(
        "party",
        "month",
        rate.alias("churn_rate"),
        "written_premium",
        "refunded_premium",
        "net_premium",
        "transaction_count",
        F.coalesce(rate > F.lit(Decimal(threshold)), F.lit(False)).alias("high_churn"),
    )
    return _audit(out, "_created_at", at)


def concentration(
    mart: DataFrame,
    by: str = "month",
    entity: str = "party",
    value: str = "net_premium",
    dominant_share: str = rv.DOMINANT_SHARE,
    at: dt.datetime | None = None,
    competitive_below: int = rv.HHI_COMPETITIVE_BELOW,
    moderate_up_to: int = rv.HHI_MODERATE_UP_TO,
) -> DataFrame:
    """Market share and Herfindahl-Hirschman index per period.

    HHI = 10000 × Σ value² / (Σ value)², computed from exact sums with one rounding; a zero
    period total gives NULL shares and score and the level ``highly_concentrated``. Dominance is
    a share strictly above ``dominant_share`` on the unrounded share.

    The moments of a period (sum, sum of squares, greatest, least, distinct entities) are mergeable:
    they are combined by (period, entity) on every task, then by period, so that a period that holds
    a third of all rows is spread, and joined back, one row a period. ``mart`` is read twice.
    """
    v = F.col(value).cast(MONEY)  # see MONEY: keeps comparisons with 4-place products exact
    moments = mart.groupBy(F.col(by).alias("_period")).agg(
        F.sum(v).cast(MONEY).alias("total_net_premium"),
        F.sum(v * v).alias("_sum_sq"),
        F.max(v).alias("_max_v"),
        F.min(v).alias("_min_v"),
        F.count_distinct(F.col(entity)).alias("active_parties"),
    )
    rows = mart.select(entity, by, v.alias(value), "written_premium", "transaction_count")
    staged = rows.join(moments, F.col(by).eqNullSafe(F.col("_period")))
    tot = F.col("total_net_premium")
    hhi = round_ratio(F.col("_sum_sq") * F.lit(10000), tot * tot, 2)
    limit = F.lit(Decimal(dominant_share))
    dominant = (
        F.when(tot > 0, F.col("_max_v") > limit * tot)
        .when(tot < 0, F.col("_min_v") < limit * tot)
        .otherwise(F.lit(False))
    )
    level = (
        F.when(hhi < competitive_below, F.lit("competitive"))
        .when(hhi <= moderate_up_to, F.lit("moderately_concentrated"))
        .otherwise(F.lit("highly_concentrated"))
    )
    out = staged.select(
        entity,
        by,
        value,
        "written_premium",
        "total_net_premium",
        round_ratio(v, tot, 2, shift=2).alias("market_share_pct"),
        hhi.alias("hhi_score"),
        "active_parties",
        level.alias("concentration_level"),
        dominant.alias("dominant_party_flag"),
        "transaction_count",
    )
    return _audit(out, "_created_at", at)


def period_growth(
    mart: DataFrame,
    key: str = "party",
    order: str = "month",
    value: str = "written_premium",
    at: dt.datetime | None = None,
) -> DataFrame:
    """Previous value, % change against the previous *available* row (not the previous calendar
    month; NULL on the first row or a zero previous value) and a running total. Both windows
    share one partitioning and sort."""
    w = Window.partitionBy(key).orderBy(order)
    prev = F.lag(value).over(w)
    v = F.col(value)
    out = mart.select(
        key,
        order,
        prev.alias(f"previous_{value}"),
        value,
        F.sum(v).over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow)).cast(MONEY).alias(
            f"cumulative_{value}"
        ),
    )
    out = out.select(
        key,
        order,
        f"previous_{value}",
        value,
        round_ratio(v - F.col(f"previous_{value}"), F.col(f"previous_{value}"), 2, shift=2).alias(
            "percentage_change"
        ),
        f"cumulative_{value}",
    )
    return _audit(out, "_created_at", at)
