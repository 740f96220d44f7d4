"""Declared schemas of every source the marts read.

Raw feeds land as strings (typed at the edge, never inferred); the ledger and the policy table
carry explicit types. A bare NULL column would otherwise be typed ``void`` by Spark.
"""

from __future__ import annotations

from pyspark.sql import types as T

RAW_TRANSACTIONS = T.StructType(
    [
        T.StructField("transaction_id", T.StringType()),
        T.StructField("created_at", T.StringType()),
        T.StructField("premium_amount", T.StringType()),
        T.StructField("premium_currency", T.StringType()),
        T.StructField("charged_party", T.StringType()),
        T.StructField("status", T.StringType()),
    ]
)

# The ledger seed as shipped (party, month, double figure); the reader narrows it to money.
ACCOUNTING_CLOSING = T.StructType(
    [
        T.StructField("party", T.StringType()),
        T.StructField("month", T.StringType()),
        T.StructField("accounting_premium", T.DoubleType()),
    ]
)

POLICIES = T.StructType(
    [
        T.StructField("user_id", T.StringType()),
        T.StructField("acquisition_date", T.DateType()),
        T.StructField("started_at", T.DateType()),
        T.StructField("churned_at", T.DateType()),
        T.StructField("monthly_premium", T.DecimalType(18, 2)),
        T.StructField("product_group", T.StringType()),
    ]
)

# Keyed application-state table (create-if-absent, upsert, delete, full load).
TRACKED_STATE = T.StructType(
    [
        T.StructField("pr_number", T.IntegerType(), False),
        T.StructField("model_name", T.StringType(), False),
        T.StructField("ticket_identifier", T.StringType(), False),
        T.StructField("issue_id", T.StringType(), False),
        T.StructField("label_ids", T.ArrayType(T.StringType()), False),
        T.StructField("created_at", T.TimestampType()),
    ]
)

# Output column order of each mart (audit timestamp columns are appended only when a run
# timestamp is passed).
SILVER_COLUMNS = [
    "transaction_id",
    "created_at_ts",
    "transaction_date",
    "transaction_month",
    "premium_amount",
    "premium_currency",
    "party",
    "status",
    "status_raw",
    "_status_normalized",
    "_dq_flags",
    "_is_clean",
    "_source_file",
    "_bronze_ingested_at",
]

MONTHLY_COLUMNS = [
    "party",
    "month",
    "premium",
    "written_premium",
    "refunded_premium",
    "refund_count",
    "net_premium",
    "earned_premium",
    "transaction_count",
    "first_transaction_date",
    "last_transaction_date",
]

RECON_COLUMNS = [
    "party",
    "month",
    "accounting_premium",
    "finance_premium",
    "net_premium",
    "refunded_premium",
    "net_delta",
    "transaction_count",
    "delta",
    "delta_pct",
    "reconciliation_status",
    "is_reconciled",
]

ACTIVITY_COLUMNS = [
    "activity_date",
    "user_id",
    "product_group",
    "acquisition_date",
    "started_at",
    "churned_at",
    "daily_premium",
    "monthly_premium",
    "days_since_acquisition",
    "activity_month",
]
