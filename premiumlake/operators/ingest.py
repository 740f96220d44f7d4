"""Bronze ingest (M1) and silver cleaning (M2).

Both are narrow per-row projections: no shuffle, fully pipelined in one codegen stage, so they
scale linearly with the feed. Malformed input becomes NULL plus a flag instead of failing the load.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from premiumlake import reference_values as rv
from premiumlake.functions.calendar import month_key, parse_created_at
from premiumlake.functions.exact import AMOUNT

# A number PostgreSQL would accept as double precision: optional sign, digits with an optional
# fraction (or a bare fraction), optional exponent, surrounding blanks. Anything else is NULL.
NUMERIC_TEXT = r"^\s*[+-]?(\d+(\.\d*)?|\.\d+)([eE][+-]?\d+)?\s*\z"


def parse_amount(raw: Column) -> Column:
    """Text → decimal(22,6), not rounded to cents; NULL for text that is not a plain number (``try_cast`` alone would
    accept Java-isms such as ``1.5d``)."""
    return F.when(raw.rlike(NUMERIC_TEXT), F.trim(raw).try_cast(AMOUNT))


def ingest_raw(raw: DataFrame, source_file: str = rv.RAW_SOURCE_FILE, at: dt.datetime | None = None) -> DataFrame:
    """Bronze: raw strings, the amount typed as money, plus lineage (source file, ingest time).

    ``at`` is the load timestamp; it is a parameter so a rebuild is reproducible.
    """
    cols = [
        F.col("transaction_id"),
        F.col("created_at"),
        parse_amount(F.col("premium_amount")).alias("premium_amount"),
        F.col("premium_currency"),
        F.col("charged_party"),
        F.col("status"),
        F.lit(source_file).alias("_source_file"),
    ]
    if at is not None:
        cols.append(F.lit(at).cast("timestamp").alias("_ingested_at"))
    return raw.select(*cols)


def dq_flags(ts: Column, amount: Column, party: Column) -> Column:
    """Comma-joined data-quality flags in fixed order; '' when the row is clean."""
    return F.concat_ws(
        ",",
        F.when(ts.isNull(), F.lit(rv.FLAG_TIMESTAMP)),
        F.when(amount.isNull(), F.lit(rv.FLAG_PREMIUM)),
        F.when(amount < 0, F.lit(rv.FLAG_NEGATIVE)),
        F.when(party.isNull(), F.lit(rv.FLAG_PARTY)),
    )


def clean_transactions(bronze: DataFrame, at: dt.datetime | None = None) -> DataFrame:
    """Silver: parse the timestamp once (date and ``yyyy-MM`` month derive from it), normalise
    the ``process`` status variant (case is not folded; NULL stays NULL), and attach flags.

    Currency and transaction id do not affect ``_is_clean``; duplicate ids pass through.
    """
    ts = parse_created_at(F.col("created_at"))
    parsed = bronze.select(
        F.col("transaction_id"),
        ts.alias("created_at_ts"),
        F.col("premium_amount"),
        F.col("premium_currency"),
        F.col("charged_party").alias("party"),
        F.col("status").alias("status_raw"),
        F.col("_source_file"),
        *([F.col("_ingested_at")] if "_ingested_at" in bronze.columns else []),
    )
    ts_c, amount, party, raw_status = (
        F.col("created_at_ts"),
        F.col("premium_amount"),
        F.col("party"),
        F.col("status_raw"),
    )
    cols = [
        F.col("transaction_id"),
        ts_c,
        F.to_date(ts_c).alias("transaction_date"),
        month_key(ts_c).alias("transaction_month"),
        amount,
        F.col("premium_currency"),
        party,
        F.when(raw_status == rv.STATUS_VARIANT, F.lit(rv.STATUS_NORMALISED)).otherwise(raw_status).alias("status"),
        raw_status,
        (raw_status == rv.STATUS_VARIANT).alias("_status_normalized"),
        dq_flags(ts_c, amount, party).alias("_dq_flags"),
        (ts_c.isNotNull() & amount.isNotNull() & (amount >= 0) & party.isNotNull()).alias("_is_clean"),
        F.col("_source_file"),
    ]
    if "_ingested_at" in parsed.columns:
        cols.append(F.col("_ingested_at").alias("_bronze_ingested_at"))
    if at is not None:
        cols.append(F.lit(at).cast("timestamp").alias("_silver_transformed_at"))
    return parsed.select(*cols)
