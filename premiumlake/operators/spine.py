"""Daily activity spine (M5) and the user-month table the customer marts share.

The spine multiplies rows (one per policy per day): the small policy input is spread over an
explicit number of tasks first, then the ``explode`` itself is narrow. The customer marts (cohort, LTV, waterfall) only need user × month figures; they start
from ``user_months`` — either aggregated from stored daily rows, or, for a fresh build, derived
straight from the policies by exploding *months* instead of days (about 30× fewer rows, same
exact sums because a policy's daily premium is constant within a month).
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from premiumlake.functions.calendar import days_in_month, month_key, month_start
from premiumlake.functions.exact import DAILY, dec

USER_MONTH_KEYS = ("user_id", "product_group", "month", "acquisition_month")


def daily_premium(monthly_premium: Column, day: Column) -> Column:
    """monthly premium / days in that month, half-up at 6 places (decimal division rounds the
    exact quotient once)."""
    return (monthly_premium / days_in_month(day).cast("decimal(2,0)")).cast(DAILY)


def _policy_end(as_of: dt.date | Column) -> Column:
    end_default = as_of if isinstance(as_of, Column) else F.lit(as_of)
    return F.coalesce(F.col("churned_at"), end_default)


def _spread(policies: DataFrame) -> DataFrame:
    """Hash-partition policies on (user, start) before the day explode.

    The explode multiplies each row by its length in days, so parallelism must be set on the
    small input: AQE sizes (and may coalesce) partitions by *input* bytes and would leave a
    handful of tasks to generate the whole spine; an explicit partition count is not coalesced.
    The start date is part of the key so that even a user holding a large share of all
    policies is spread over many tasks.
    """
    parts = int(policies.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return policies.repartition(parts, "user_id", "started_at")


def _policy_days(policies: DataFrame, end: Column, by_month: bool) -> DataFrame:
    """A row per policy and day, spread by (user, start) or by (user, month)."""
    whole = policies.where(F.col("started_at") <= end)
    kept = ["user_id", "product_group", "acquisition_date", "started_at", "churned_at", "monthly_premium"]
    if not by_month:
        days = F.sequence(F.col("started_at"), end, F.expr("INTERVAL 1 DAY"))
        return _spread(whole).select(*kept, F.explode(days).alias("activity_date"))
    months = F.sequence(month_start(F.col("started_at")), month_start(end), F.expr("INTERVAL 1 MONTH"))
    pieces = whole.select(*kept, F.explode(months).alias("_m"))
    # constant within a month, so not worked out for every day
    pieces = pieces.withColumns({"activity_month": month_key(F.col("_m")), "daily_premium": daily_premium(F.col("monthly_premium"), F.col("_m"))})
    parts = int(policies.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    pieces = pieces.repartition(parts, "user_id", "activity_month")
    first, last = F.greatest(F.col("started_at"), F.col("_m")), F.least(end, F.last_day("_m"))
    return pieces.select(*kept, "activity_month", "daily_premium", F.explode(F.sequence(first, last, F.expr("INTERVAL 1 DAY"))).alias("activity_date"))


def daily_activity(policies: DataFrame, as_of: dt.date, at: dt.datetime | None = None, by_month: bool = False) -> DataFrame:
    """One row per policy per day from start to churn (both included); open policies run to
    ``as_of``. Policies ending before they start give no rows (guarded: ``sequence`` would
    raise). Every run recomputes all days; loading into a stored mart is ``delete_insert``.

    ``by_month`` gives the same rows hash-partitioned on (user_id, activity_month): the months of
    the policies are shuffled instead of the policies, so that a join or an aggregate of the days
    on these two columns needs no shuffle of the days."""
    days = _policy_days(policies, _policy_end(as_of), by_month)
    d = F.col("activity_date")
    cols = [
        d,
        F.col("user_id"),
        F.col("product_group"),
        F.col("acquisition_date"),
        F.col("started_at"),
        F.col("churned_at"),
        F.col("daily_premium") if by_month else daily_premium(F.col("monthly_premium"), d).alias("daily_premium"),
        F.col("monthly_premium"),
        F.datediff(d, F.col("acquisition_date")).alias("days_since_acquisition"),
        F.col("activity_month") if by_month else month_key(d).alias("activity_month"),
    ]
    if at is not None:
        cols.append(F.lit(at).cast("timestamp").alias("_loaded_at"))
    return days.select(*cols)


def _user_month_agg(df: DataFrame, premium: Column) -> DataFrame:
    """Aggregate to the user-month grain, then hash-partition the (small) result on
    (user, product) so every later window and aggregate of the customer marts is satisfied
    without a new exchange.

    Aggregating on all four keys first lets map-side partial aggregation shrink the input
    before any shuffle and spreads even a very large user over tasks by month; the grain
    itself is bounded (months × acquisition months per user and product).
    """
    aggs = [F.sum(premium).cast(dec(6)).alias("premium"), F.min("acquisition_date").alias("acquisition_date")]
    return df.groupBy(*USER_MONTH_KEYS).agg(*aggs).repartition("user_id", "product_group")


def user_months(activity: DataFrame) -> DataFrame:
    """(user, product, month, acquisition month) → Σ daily premium, from stored daily rows."""
    d = F.col("activity_date")
    staged = activity.select(
        "user_id",
        "product_group",
        month_start(d).alias("month"),
        month_start(F.col("acquisition_date")).alias("acquisition_month"),
        "acquisition_date",
        "daily_premium",
    )
    return _user_month_agg(staged, F.col("daily_premium"))


def user_months_from_policies(policies: DataFrame, as_of: dt.date) -> DataFrame:
    """Same table as ``user_months(daily_activity(policies, as_of))``, without the daily rows:
    each policy explodes to the months it touches, weighted by the days it covers in each."""
    end = _policy_end(as_of)
    months = policies.where(F.col("started_at") <= end).select(
        "user_id",
        "product_group",
        "acquisition_date",
        "monthly_premium",
        F.col("started_at").alias("_s"),
        end.alias("_e"),
        F.explode(F.sequence(month_start(F.col("started_at")), month_start(end), F.expr("INTERVAL 1 MONTH"))).alias(
            "month"
        ),
    )
    m = F.col("month")
    first_day = F.greatest(F.col("_s"), m)
    last_day = F.least(F.col("_e"), F.last_day(m))
    covered = F.datediff(last_day, first_day) + 1
    staged = months.select(
        "user_id",
        "product_group",
        m,
        month_start(F.col("acquisition_date")).alias("acquisition_month"),
        "acquisition_date",
        (daily_premium(F.col("monthly_premium"), m) * covered).alias("_premium"),
    )
    return _user_month_agg(staged, F.col("_premium"))
