"""Adapter from the supplied TPC-H-like tables to the premium inputs.

The reference ships no raw transaction file and only five inline policies, so the marts are fed
from ``orders`` and ``customer`` by plain arithmetic on keys. Every rule is a Column expression:
the inputs grow with the supplied tables and are derived on the executors. The same rules are
spelled in DuckDB SQL in ``premiumlake.plans.oracle``; both must produce identical inputs.
Let ``k`` be the order key (transactions) or customer key (policies).
"""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from premiumlake import reference_values as rv
from premiumlake.functions.exact import AMOUNT, MONEY, MONEY_IN

AS_OF = dt.date(2001, 12, 31)  # end of open policies in every fixture run, passed as a literal
LEDGER_ONLY_MONTH = "2002-01"
LEDGER_ONLY_VALUE = Decimal("100.00")


def _party_of(custkey: Column) -> Column:
    return F.element_at(F.array(*[F.lit(p) for p in rv.PARTIES]), (custkey % 4 + 1).cast("int"))


def raw_transactions(orders: DataFrame) -> DataFrame:
    """Raw feed (all strings) with every defect the silver layer handles:
    wrong-shape and impossible timestamps, unparseable / NULL / zero / negative amounts, parts of cents,
    missing party, the ``process`` status variant, refunds and failures, months of refunds alone."""
    k = F.col("o_orderkey")
    d = F.col("o_orderdate")
    created_at = (
        F.when(k % 97 == 0, F.concat(F.year(d).cast("string"), F.lit("-01-01")))
        .when(k % 193 == 0, F.lit("13/45/2025 1:00:00"))
        .otherwise(
            F.concat(
                F.month(d).cast("string"), F.lit("/"),
                F.dayofmonth(d).cast("string"), F.lit("/"),
                F.year(d).cast("string"), F.lit(" "),
                (k % 24).cast("string"), F.lit(":"),
                F.lpad((k % 60).cast("string"), 2, "0"), F.lit(":"),
                F.lpad((k * 7 % 60).cast("string"), 2, "0"),
            )
        )
    )
    amount_text = F.col("o_totalprice").cast(MONEY_IN).cast("string")
    premium_amount = (
        F.when(k % 101 == 0, F.lit("n/a"))
        .when(k % 107 == 0, F.lit(None).cast("string"))
        .when(k % 109 == 0, F.lit("0.00"))
        .when(k % 103 == 0, F.concat(F.lit("-"), amount_text))
        .when(k % 127 == 0, F.lit("0.004"))
        .when(k % 131 == 0, F.concat(amount_text, F.lit("4567")))
        .otherwise(amount_text)
    )
    # one party sells nothing in May of odd years: months of refunds alone
    refunds_only = (F.col("o_custkey") % 4 == 3) & (F.month(d) == 5) & (F.year(d) % 2 == 1)
    status = (
        F.when(refunds_only, F.when(k % 2 == 0, F.lit("refunded")).otherwise(F.lit("failed")))
        .when(F.col("o_orderstatus") == "F", F.lit("processed"))
        .when(F.col("o_orderstatus") == "O", F.when(k % 2 == 0, F.lit("process")).otherwise(F.lit("processed")))
        .when(
            F.col("o_orderstatus") == "P",
            F.when(k % 3 == 0, F.lit("refunded")).when(k % 3 == 1, F.lit("failed")).otherwise(F.lit("processed")),
        )
    )
    return orders.select(
        k.cast("string").alias("transaction_id"),
        created_at.alias("created_at"),
        premium_amount.alias("premium_amount"),
        F.lit("EUR").alias("premium_currency"),
        F.when(k % 113 != 0, _party_of(F.col("o_custkey"))).alias("charged_party"),
        status.alias("status"),
    )


def accounting_closing(silver: DataFrame) -> DataFrame:
    """Ledger built from the clean processed rows, bent per (party, month) so that every
    reconciliation status and quirk occurs; some mart keys are left out and four ledger-only
    keys are added."""
    sale = (F.col("status") == "processed") & F.col("_is_clean") & (F.col("premium_amount") > 0)
    base = (
        silver.select("party", F.col("transaction_month").alias("month"), "premium_amount", sale.alias("_sale"))
        .groupBy("party", "month")
        .agg(F.sum(F.when(F.col("_sale"), F.col("premium_amount"))).cast(MONEY).alias("w"), F.count_if(F.col("_sale")).alias("_n"))
        .where(F.col("_n") > 0)
    )
    mi = F.substring("month", 1, 4).cast("int") * 12 + F.substring("month", 6, 2).cast("int")
    pix = F.array_position(F.array(*[F.lit(p) for p in rv.PARTIES]), F.col("party")).cast("int") - 1
    case = (mi + pix) % 5
    w = F.col("w")
    figure = (
        F.when(case == 0, w)
        .when(case == 1, w * F.lit(Decimal("1.005")))
        .when(case == 2, w * F.lit(Decimal("1.05")))
        .when(case == 3, F.lit(Decimal("0.00")))
        .otherwise(-w)
    )
    ledger = base.where(mi % 17 != 0).select("party", "month", figure.cast(MONEY_IN).alias("accounting_premium"))
    only = silver.sparkSession.createDataFrame(
        [(p, LEDGER_ONLY_MONTH, LEDGER_ONLY_VALUE) for p in rv.PARTIES],
        "party string, month string, accounting_premium decimal(18,2)",
    )
    return ledger.unionByName(only)


def _csv_line(*values: Column) -> Column:
    """A CSV record: quoted fields, quotes doubled, NULL as nothing."""
    quote = lambda c: F.coalesce(F.concat(F.lit('"'), F.replace(c.cast("string"), F.lit('"'), F.lit('""')), F.lit('"')), F.lit(""))
    return F.concat_ws(",", *[quote(c) for c in values])


def raw_csv_lines(raw: DataFrame) -> DataFrame:
    """The raw feed as CSV text with broken records: no id where the amount is NULL, two fields too few
    where it is ``n/a``, one too many where it is zero; a quoted status of two lines where the party is
    NULL."""
    amount, status = F.col("premium_amount"), F.col("status")
    first = [F.col(c) for c in ("created_at", "premium_amount", "premium_currency", "charged_party")]
    number = F.col("transaction_id")
    two_lines = F.concat(F.lit('a "b"\n'), status)
    line = (
        F.when(amount.isNull(), _csv_line(F.lit(None), *first, status))
        .when(amount == "n/a", _csv_line(number, *first[:3]))
        .when(amount == "0.00", _csv_line(number, *first, status, F.lit("more")))
        .otherwise(_csv_line(number, *first, F.when(F.col("charged_party").isNull(), two_lines).otherwise(status)))
    )
    return raw.select(line.alias("value"))


def ledger_csv_lines(ledger: DataFrame) -> DataFrame:
    """The ledger as CSV text; June has words for figures, July no party."""
    month = F.substring("month", 6, 2)
    figure = F.when(month == "06", F.lit("to follow")).otherwise(F.col("accounting_premium").cast("string"))
    return ledger.select(_csv_line(F.when(month != "07", F.col("party")), F.col("month"), figure).alias("value"))


def _product_group(segment: Column) -> Column:
    return (
        F.when(segment.isin("HOUSEHOLD", "BUILDING"), F.lit("household"))
        .when(segment.isin("MACHINERY", "AUTOMOBILE"), F.lit("liability"))
        .otherwise(F.lit("legal"))
    )


def policies(customer: DataFrame, orders: DataFrame) -> DataFrame:
    """One policy per customer with at least one order, plus a second, later policy for every
    seventh customer (a gap, a reactivation and a second lapse). Open policies (NULL churn) and
    empty spines (churn before start) are included."""
    first_order = orders.groupBy(F.col("o_custkey").alias("c_custkey")).agg(
        F.to_date(F.min("o_orderdate")).alias("acquisition_date")
    )
    k = F.col("c_custkey")
    started = F.date_add("acquisition_date", (k % 20).cast("int"))
    churned = (
        F.when(k % 20 == 0, F.lit(None).cast("date"))
        .when(k % 50 == 1, F.date_sub(started, 1))
        .otherwise(F.date_add(started, (k % 400 + 30).cast("int")))
    )
    premium = (F.abs(F.col("c_acctbal")).cast(MONEY_IN) / F.lit(100)).cast(MONEY_IN)
    user = F.concat(F.lit("USR"), k.cast("string"))
    group = _product_group(F.col("c_mktsegment"))

    def policy(start: Column, end: Column) -> Column:
        return F.struct(
            user.alias("user_id"),
            F.col("acquisition_date"),
            start.alias("started_at"),
            end.alias("churned_at"),
            premium.alias("monthly_premium"),
            group.alias("product_group"),
        )

    # Both policies of a customer come from one joined row (one join, one pass).
    second_start = F.date_add(churned, 90)
    second = F.when((k % 7 == 0) & (k % 20 != 0) & (k % 50 != 1), policy(second_start, F.date_add(second_start, 60)))
    both = F.filter(F.array(policy(started, churned), second), lambda p: p.isNotNull())
    return customer.join(first_order, "c_custkey").select(F.inline(both))


def policy_key(user_id: Column) -> Column:
    return F.substring(user_id, 4, 20).cast("long")


def policies_recut(policies_df: DataFrame, customer: DataFrame, as_of: dt.date = AS_OF) -> DataFrame:
    """Second load of the daily mart: every fifth customer's policies end 15 days after start
    (days after the new end are left stale in the target, as in the reference), plus one new
    policy for a new user."""
    k = policy_key(F.col("user_id"))
    end = F.coalesce(F.col("churned_at"), F.lit(as_of))
    recut = policies_df.where(k % 5 == 0).withColumn(
        "churned_at", F.least(end, F.date_add("started_at", 15))
    )
    newcomer = (
        customer.agg(F.min("c_custkey").alias("k"))
        .select(
            F.concat(F.lit("NEW"), F.col("k").cast("string")).alias("user_id"),
            F.lit(dt.date(2001, 11, 20)).alias("acquisition_date"),
            F.lit(dt.date(2001, 11, 25)).alias("started_at"),
            F.lit(None).cast("date").alias("churned_at"),
            F.lit(Decimal("10.00")).cast(MONEY_IN).alias("monthly_premium"),
            F.lit("legal").alias("product_group"),
        )
    )
    return recut.unionByName(newcomer)


def scd2_second_batch(snapshot_rows: DataFrame) -> DataFrame:
    """Second snapshot input: hard deletes, status and amount changes (new versions), a change
    of an unchecked column (no new version) and ten new keys."""
    k = F.col("transaction_id").cast("long")
    changed = snapshot_rows.where(k % 11 != 0).select(
        *[
            (
                F.when(k % 13 == 0, F.lit("refunded")).otherwise(F.col("status")).alias("status")
                if c == "status"
                else F.when(k % 17 == 0, (F.col(c) + F.lit(Decimal("1.00"))).cast(AMOUNT)).otherwise(F.col(c)).alias(c)
                if c == "premium_amount"
                else F.when(k % 19 == 0, F.concat(F.col(c), F.lit("-moved"))).otherwise(F.col(c)).alias(c)
                if c == "party"
                else F.col(c)
            )
            for c in snapshot_rows.columns
        ]
    )
    newcomers = (
        snapshot_rows.where(k % 101 == 0).withColumn("transaction_id", F.concat(F.lit("new-"), F.col("transaction_id")))
    )
    return changed.unionByName(newcomers)


def customer_update_batch(customer: DataFrame) -> DataFrame:
    """Upsert batch for the customer table: every ninth customer with a new balance and a new
    name (only the balance is an update column, so the name must survive), and re-keyed copies
    of every 97th customer as new keys."""
    k = F.col("c_custkey")
    updates = customer.where(k % 9 == 0).select(
        k,
        F.concat(F.col("c_name"), F.lit(" (renamed)")).alias("c_name"),
        F.col("c_nationkey"),
        (F.col("c_acctbal") + F.lit(1.0)).alias("c_acctbal"),
        F.col("c_mktsegment"),
    )
    inserts = customer.where(k % 97 == 0).select(
        (k + F.lit(10_000_000)).alias("c_custkey"), "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"
    )
    return updates.unionByName(inserts)
