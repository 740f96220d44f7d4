"""Customer marts on the user-month table: cohort retention (M6), lifetime value (M7) and the
new / renewal / lapse premium waterfall (M8).

``user_months`` arrives hash-partitioned on (user_id, product_group), which satisfies the LTV
aggregate and both waterfall windows, so those add no exchange. Each mart then reduces to a
small (cohort | product) × month grain through a partially-aggregated shuffle.
"""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from premiumlake import reference_values as rv
from premiumlake.functions.calendar import month_index, months_between_starts, month_start
from premiumlake.functions.exact import dec, round_money, round_ratio
from premiumlake.operators.ntile import ntile


def _audit(df: DataFrame, at: dt.datetime | None) -> DataFrame:
    return df if at is None else df.withColumn("_created_at", F.lit(at).cast("timestamp"))


def cohort_retention(user_months: DataFrame, at: dt.datetime | None = None) -> DataFrame:
    """Active customers per (acquisition month, product, months since acquisition) and their
    share of the cohort size.

    The cohort size counts only users active *in* the acquisition month; a cohort whose users
    all start later has a NULL size and a NULL rate (the reference's left join). ``user_months``
    is unique on (user, product, month, acquisition month), so a row count per group is the
    distinct-user count. The cohort size is a window over the aggregated rows instead of a
    second aggregate joined back.
    """
    active = user_months.groupBy(
        F.col("acquisition_month").alias("cohort_month"), "product_group", "month"
    ).agg(F.count(F.lit(1)).alias("active_customers"))
    cohort = Window.partitionBy("cohort_month", "product_group")
    size = F.max(F.when(F.col("month") == F.col("cohort_month"), F.col("active_customers"))).over(cohort)
    staged = active.select(
        "cohort_month",
        "product_group",
        months_between_starts(F.col("month"), F.col("cohort_month")).alias("months_since_acquisition"),
        size.alias("cohort_size"),
        "active_customers",
    )
    out = staged.withColumn(
        "retention_rate", round_ratio(F.col("active_customers"), F.col("cohort_size"), 1, shift=2)
    )
    return _audit(out, at)


def ltv_bucket(lifetime, edges=rv.LTV_BUCKET_EDGES, labels=rv.LTV_BUCKETS):
    """Half-open buckets [., e1) [e1, e2) … [ek, .); NULL falls in the top bucket."""
    expr = None
    for edge, label in zip(edges, labels):
        cond = lifetime < F.lit(edge)
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    return expr.otherwise(F.lit(labels[len(edges)]))


def customer_ltv(
    user_months: DataFrame,
    tiles: int = rv.LTV_TILES,
    edges: tuple = rv.LTV_BUCKET_EDGES,
    at: dt.datetime | None = None,
) -> DataFrame:
    """Lifetime premium per (user, product) with acquisition cohort, last active month, active
    months, mean premium per active month, a decile (1 = highest lifetime premium; ties broken
    by user_id then product_group, NULLs first as PostgreSQL orders DESC) and a value bucket."""
    per_user = user_months.groupBy("user_id", "product_group").agg(
        month_start(F.min("acquisition_date")).alias("cohort_month"),
        F.max("month").alias("last_active_month"),
        F.countDistinct("month").alias("active_months"),
        F.sum("premium").cast(dec(6)).alias("lifetime_premium"),
    )
    lifetime = F.col("lifetime_premium")
    staged = per_user.select(
        "user_id",
        "product_group",
        "cohort_month",
        "last_active_month",
        "active_months",
        "lifetime_premium",
        round_ratio(lifetime, F.col("active_months"), 2).alias("avg_monthly_premium"),
        ltv_bucket(lifetime, edges).alias("ltv_bucket"),
    )
    order = [lifetime.desc_nulls_first(), F.col("user_id").asc(), F.col("product_group").asc()]
    out = ntile(staged, tiles, order, out="decile").select(
        "user_id",
        "product_group",
        "cohort_month",
        "last_active_month",
        "active_months",
        "lifetime_premium",
        "avg_monthly_premium",
        "decile",
        "ltv_bucket",
    )
    return _audit(out, at)


def classify_user_months(user_months: DataFrame) -> DataFrame:
    """Each user-month as new_business (its acquisition month), renewal (the previous active
    row is exactly the previous calendar month) or reactivation (anything else), plus whether
    its premium lapses into the next month (no row for the next calendar month)."""
    mi = month_index(F.col("month"))
    w = Window.partitionBy("user_id", "product_group").orderBy(mi)
    prev_month = F.lag("month").over(w)
    next_rows = F.count(F.lit(1)).over(w.rangeBetween(1, 1))
    kind = (
        F.when(F.col("month") == F.col("acquisition_month"), F.lit("new_business"))
        .when(prev_month == F.add_months(F.col("month"), -1), F.lit("renewal"))
        .otherwise(F.lit("reactivation"))
    )
    return user_months.select(
        "user_id",
        "product_group",
        "month",
        "acquisition_month",
        "premium",
        kind.alias("transaction_type"),
        (next_rows == 0).alias("lapses_next_month"),
    )


def premium_waterfall(user_months: DataFrame, at: dt.datetime | None = None) -> DataFrame:
    """New business, renewal and lapsed premium per (product, month), net written premium and
    the lapse-to-new-business ratio (NULL when there is no new business).

    A lapse is booked in the month *after* the last active month; it only appears for
    product-months that have active rows (the reference's left join from active premiums).
    Reactivation premium is in no column and not in net. Active rows and lapse rows are emitted
    from one pass and folded by a single aggregate: no self-join, no second scan.
    """
    zero = F.lit(Decimal("0")).cast(dec(6))
    classified = classify_user_months(user_months)
    p, kind = F.col("premium"), F.col("transaction_type")
    events = classified.select(
        "product_group",
        F.explode(
            F.array(
                F.struct(
                    F.col("month").alias("month"),
                    F.when(kind == "new_business", p).otherwise(zero).alias("nb"),
                    F.when(kind == "renewal", p).otherwise(zero).alias("rn"),
                    zero.alias("lp"),
                    F.lit(True).alias("active"),
                ),
                F.struct(
                    F.add_months(F.col("month"), 1).alias("month"),
                    zero.alias("nb"),
                    zero.alias("rn"),
                    F.when(F.col("lapses_next_month"), p).otherwise(zero).alias("lp"),
                    F.lit(False).alias("active"),
                ),
            )
        ).alias("e"),
        F.col("lapses_next_month"),
    ).where(F.col("e.active") | F.col("lapses_next_month"))
    folded = events.groupBy("product_group", F.col("e.month").alias("month")).agg(
        F.sum("e.nb").alias("nb"),
        F.sum("e.rn").alias("rn"),
        F.sum("e.lp").alias("lp"),
        F.max(F.col("e.active").cast("int")).alias("_active"),
    )
    nb, rn, lp = F.col("nb"), F.col("rn"), F.col("lp")
    out = folded.where(F.col("_active") == 1).select(
        F.col("product_group").alias("party"),
        "month",
        round_money(nb).alias("new_business_premium"),
        round_money(rn).alias("renewal_premium"),
        round_money(lp).alias("lapsed_premium"),
        round_money(nb + rn - lp).alias("net_written_premium"),
        round_ratio(lp, nb, 2).alias("lapse_to_new_business_ratio"),
    )
    return _audit(out, at)
