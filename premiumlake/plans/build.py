"""Layered build (M38): sources → bronze → silver → gold marts, SCD2 snapshot and the incremental
daily mart, one database per layer.

Every model reads its inputs from the *published* upstream tables, so each write cuts the lineage
(a lost executor recomputes from the last table, not from the raw feed) and the day-level mart is
produced once and scanned by its three consumers. Models that read their own previous version
(delete+insert, snapshot) are checkpointed before they overwrite it.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from premiumlake.operators import customer_marts, party_marts, quality
from premiumlake.operators.history import IS_CURRENT, scd2_snapshot
from premiumlake.operators.ingest import clean_transactions, ingest_raw
from premiumlake.operators.spine import daily_activity, user_months
from premiumlake.plans import graph
from premiumlake.plans.graph import Model
from premiumlake.session import checkpoint_dir
from premiumlake.sources.tables import merge_partitions, overwrite_partitions, publish

LAYERS = ("seeds", "bronze", "silver", "gold", "snapshots")

# Model catalog: layer, materialisation and tags (select models by tag with `models_tagged`).
MODELS = {
    "accounting_closing": {"layer": "seeds", "materialized": "seed", "tags": ()},
    "bronze_raw_transactions": {"layer": "bronze", "materialized": "table", "tags": ("bronze",)},
    "silver_transactions": {"layer": "silver", "materialized": "table", "tags": ("silver",)},
    "gold_fct_monthly_premiums": {"layer": "gold", "materialized": "table", "tags": ("gold", "finance")},
    "gold_fct_accounting_reconciliation": {"layer": "gold", "materialized": "table", "tags": ("gold", "finance", "reconciliation")},
    "gold_fct_monthly_churn_rate_by_party": {"layer": "gold", "materialized": "table", "tags": ("gold",)},
    "gold_fct_premium_concentration_hhi": {"layer": "gold", "materialized": "table", "tags": ("gold",)},
    "gold_fct_premium_mom_growth": {"layer": "gold", "materialized": "table", "tags": ("gold",)},
    "gold_fct_customer_activity_daily": {"layer": "gold", "materialized": "incremental", "tags": ("gold", "kpi")},
    "int_customer_months": {"layer": "gold", "materialized": "table", "tags": ("gold", "intermediate")},
    "gold_fct_cohort_retention": {"layer": "gold", "materialized": "table", "tags": ("gold",)},
    "gold_fct_customer_ltv": {"layer": "gold", "materialized": "table", "tags": ("gold",)},
    "gold_fct_gwp_waterfall": {"layer": "gold", "materialized": "table", "tags": ("gold",)},
    "snp_silver_transactions": {"layer": "snapshots", "materialized": "snapshot", "tags": ()},
}

SNAPSHOT_COLUMNS = (
    "transaction_id", "transaction_date", "transaction_month", "premium_amount", "premium_currency", "party",
    "status", "status_raw", "_status_normalized", "_dq_flags", "_is_clean", "_bronze_ingested_at",
    "_silver_transformed_at",
)


def models_tagged(tag: str) -> list[str]:
    return [m for m, meta in MODELS.items() if tag in meta["tags"]]


@dataclass
class Sources:
    raw_transactions: DataFrame  # all-string raw feed
    accounting_closing: DataFrame  # party, month, accounting_premium (money)
    policies: DataFrame  # user_id, acquisition_date, started_at, churned_at, monthly_premium, product_group


def table_name(model: str, prefix: str = "") -> str:
    return f"{prefix}{MODELS[model]['layer']}.{model}"


def _write_activity(df: DataFrame) -> DataFrame:
    """Range-partition the day mart on (month, user) before writing it partitioned by month:
    tasks of even size, each writing into one or two month folders (no tiny-file explosion,
    no single task per month)."""
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartitionByRange(parts, "activity_month", "user_id")


def build_all(
    spark: SparkSession,
    sources: Sources,
    at: dt.datetime,
    as_of: dt.date,
    prefix: str = "",
    select: Iterable[str] | None = None,
    buckets: int | None = None,
) -> list[str]:
    """Build the models in dependency order; returns the tables written. ``select`` limits the
    run to the given models (their upstream tables must already exist).

    Silver and the snapshot are stored bucketed on ``transaction_id`` into the same number of
    ``buckets`` (default: the session's shuffle partitions), so each snapshot run joins the
    open history with the new silver without shuffling either table. Keep the count stable
    between runs; a changed count costs one shuffle on the next run and is then re-bucketed.
    """
    wanted = set(select) if select is not None else set(MODELS)
    n_buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    by_transaction = (n_buckets, ["transaction_id"])
    for layer in LAYERS:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {prefix}{layer}")
    t = lambda m: table_name(m, prefix)
    written: list[str] = []

    def run(model: str, make, partition_by: Iterable[str] = (), bucket_by=None) -> None:
        if model in wanted:
            reads_self = MODELS[model]["materialized"] in ("incremental", "snapshot")
            publish(spark, make(), t(model), partition_by, reads_self=reads_self, bucket_by=bucket_by)
            written.append(t(model))

    run("accounting_closing", lambda: sources.accounting_closing)
    run("bronze_raw_transactions", lambda: ingest_raw(sources.raw_transactions, at=at))
    run(
        "silver_transactions",
        lambda: clean_transactions(spark.table(t("bronze_raw_transactions")), at=at),
        bucket_by=by_transaction,
    )

    if "snp_silver_transactions" in wanted:
        snapshot_run(spark, t("snp_silver_transactions"), spark.table(t("silver_transactions")), at, n_buckets)
        written.append(t("snp_silver_transactions"))
    run("gold_fct_monthly_premiums", lambda: party_marts.monthly_premiums(spark.table(t("silver_transactions")), at=at))
    monthly = lambda: spark.table(t("gold_fct_monthly_premiums"))
    run(
        "gold_fct_accounting_reconciliation",
        lambda: party_marts.reconcile(spark.table(t("accounting_closing")), monthly(), at=at),
    )
    run("gold_fct_monthly_churn_rate_by_party", lambda: party_marts.refund_churn(monthly(), at=at))
    run("gold_fct_premium_concentration_hhi", lambda: party_marts.concentration(monthly(), at=at))
    run("gold_fct_premium_mom_growth", lambda: party_marts.period_growth(monthly(), at=at))

    if "gold_fct_customer_activity_daily" in wanted:
        # delete+insert scoped to the month partitions the batch touches (dynamic overwrite)
        merge_partitions(
            spark,
            t("gold_fct_customer_activity_daily"),
            daily_activity(sources.policies, as_of, at=at),
            ["user_id", "activity_date"],
            "activity_month",
            prepare=_write_activity,
        )
        written.append(t("gold_fct_customer_activity_daily"))
    # Intermediate model: the day mart folded once to user × month (about 30× smaller), bucketed
    # on (user, product) so the LTV aggregate and the waterfall windows read it without a shuffle.
    run(
        "int_customer_months",
        lambda: user_months(spark.table(t("gold_fct_customer_activity_daily"))),
        bucket_by=(n_buckets, ["user_id", "product_group"]),
    )
    um = lambda: spark.table(t("int_customer_months"))
    run("gold_fct_cohort_retention", lambda: customer_marts.cohort_retention(um(), at=at))
    run("gold_fct_customer_ltv", lambda: customer_marts.customer_ltv(um(), at=at))
    run("gold_fct_gwp_waterfall", lambda: customer_marts.premium_waterfall(um(), at=at))
    return written


def premium_models(at: dt.datetime, as_of: dt.date, prefix: str = "", buckets: int = 8) -> list[Model]:
    """The models with their inputs and declared tests, for ``graph.build``. ``raw_transactions``,
    ``ledger`` and ``policies`` are the sources. Incremental models audit the batch that is about to
    be merged; the snapshot has no tests and reads audited silver."""
    keyed = (buckets, ("transaction_id",))

    def model(name, inputs, make, tests=(), **more) -> Model:
        return Model(name, inputs, make, tuple(tests), MODELS[name]["tags"], table_name(name, prefix), **more)

    def merge_activity(spark, batch, name):
        merge_partitions(spark, name, batch, ["user_id", "activity_date"], "activity_month", prepare=_write_activity)

    monthly, months = ("gold_fct_monthly_premiums",), ("int_customer_months",)
    return [
        model("accounting_closing", ("ledger",), lambda ledger: ledger),
        model("bronze_raw_transactions", ("raw_transactions",), lambda raw: ingest_raw(raw, at=at)),
        model(
            "silver_transactions", ("bronze_raw_transactions",), lambda bronze: clean_transactions(bronze, at=at),
            quality.silver_tests(), bucket_by=keyed,
        ),
        model(
            "snp_silver_transactions", ("silver_transactions",), lambda silver: silver,
            publish=lambda spark, silver, name: snapshot_run(spark, name, silver, at, buckets),
        ),
        model("gold_fct_monthly_premiums", ("silver_transactions",), lambda silver: party_marts.monthly_premiums(silver, at=at), quality.monthly_tests()),
        model(
            "gold_fct_accounting_reconciliation", ("accounting_closing", *monthly), lambda ledger, mart: party_marts.reconcile(ledger, mart, at=at),
            quality.recon_tests(),
        ),
        model("gold_fct_monthly_churn_rate_by_party", monthly, lambda mart: party_marts.refund_churn(mart, at=at), quality.party_month_tests()),
        model("gold_fct_premium_concentration_hhi", monthly, lambda mart: party_marts.concentration(mart, at=at), quality.concentration_tests()),
        model("gold_fct_premium_mom_growth", monthly, lambda mart: party_marts.period_growth(mart, at=at), quality.party_month_tests()),
        model(
            "gold_fct_customer_activity_daily", ("policies",), lambda policies: daily_activity(policies, as_of, at=at),
            quality.activity_tests(), publish=merge_activity,
        ),
        model("int_customer_months", ("gold_fct_customer_activity_daily",), user_months, bucket_by=(buckets, ("user_id", "product_group"))),
        model("gold_fct_cohort_retention", months, lambda um: customer_marts.cohort_retention(um, at=at), quality.cohort_tests()),
        model("gold_fct_customer_ltv", months, lambda um: customer_marts.customer_ltv(um, at=at), quality.ltv_tests()),
        model("gold_fct_gwp_waterfall", months, lambda um: customer_marts.premium_waterfall(um, at=at), quality.waterfall_tests()),
    ]


def build_audited(
    spark: SparkSession,
    sources: Sources,
    at: dt.datetime,
    as_of: dt.date,
    prefix: str = "",
    select: Iterable[str] | None = None,
    buckets: int | None = None,
    location: str | None = None,
) -> DataFrame:
    """Write, audit, publish: ``build_all`` by the model graph, with the declared tests as a gate.

    Returns the report of ``graph.build``. ``select`` takes names and ``tag:`` terms with ``+`` for
    up- and downstream; ``location``: folder of the databases (default: the warehouse)."""
    buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    make_databases(spark, prefix, location)
    given = {"raw_transactions": sources.raw_transactions, "ledger": sources.accounting_closing, "policies": sources.policies}
    return graph.build(spark, premium_models(at, as_of, prefix, buckets), given, select)


def make_databases(spark: SparkSession, prefix: str = "", location: str | None = None) -> None:
    for layer in LAYERS:
        where = f" LOCATION '{location.rstrip('/')}/{prefix}{layer}'" if location else ""
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {prefix}{layer}{where}")


CLOSED_RUN = "_closed_run"  # partition column: the closing run, or OPEN for open versions
OPEN = "open"


def snapshot_run(spark: SparkSession, name: str, silver: DataFrame, at: dt.datetime, buckets: int) -> None:
    """One SCD2 run of the silver snapshot, reading and writing only what a run can change.

    The table is partitioned on ``_closed_run``: open versions live in the partition ``open``,
    versions closed by a run in that run's partition, and all of it is bucketed on the key.
    A run joins the open partition with silver (no exchange: both sides bucketed alike), then
    one dynamic-overwrite write replaces the open partition and creates this run's partition.
    History that other runs closed is never read or rewritten. A run that is repeated with the
    same ``at`` also reads the versions it closed before and keeps them, so a corrected source
    closes more without losing those; versions that opened at ``at`` and are replaced by the
    repeat have no duration and go. When no version stays open, the open partition is dropped:
    a dynamic overwrite leaves partitions without rows as they are.
    """
    current = silver.select(*SNAPSHOT_COLUMNS)
    keys = (buckets, ["transaction_id"])
    if not spark.catalog.tableExists(name):
        first = scd2_snapshot(None, current, "transaction_id", ["status", "premium_amount"], at)
        publish(spark, first.withColumn(CLOSED_RUN, F.lit(OPEN)), name, partition_by=[CLOSED_RUN], bucket_by=keys)
        return
    run = at.strftime("%Y%m%d%H%M%S") + (f"{at.microsecond:06d}" if at.microsecond else "")
    history = spark.table(name).where(F.col(CLOSED_RUN).isin(OPEN, run)).drop(CLOSED_RUN)
    out = scd2_snapshot(history, current, "transaction_id", ["status", "premium_amount"], at)
    out = out.where(F.col(IS_CURRENT) | (F.col("valid_from") < F.col("valid_to")))
    out = out.withColumn(CLOSED_RUN, F.when(F.col(IS_CURRENT), F.lit(OPEN)).otherwise(F.lit(run)))
    checkpoint_dir(spark)
    out = out.repartition(buckets, "transaction_id").checkpoint(eager=True)  # reads the open partition
    overwrite_partitions(spark, out, name)
    if out.where(F.col(IS_CURRENT)).isEmpty():
        spark.sql(f"ALTER TABLE {name} DROP IF EXISTS PARTITION ({CLOSED_RUN} = '{OPEN}')")


def current_snapshot(spark: SparkSession, prefix: str = "") -> DataFrame:
    return spark.table(table_name("snp_silver_transactions", prefix)).where(F.col(IS_CURRENT))
