"""Keyed application-state table: create-if-absent, upsert, delete and full load.

The table is keyed by an integer, has three NOT NULL text columns, a text array defaulting to
empty and a creation time defaulting to the load time that an upsert never touches. It is a keyed
table (``sources.keyed``): key, NOT NULL and defaults are in its metadata and hold for every
writer, and a write rewrites only the buckets of its keys.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from premiumlake import schemas
from premiumlake.sources import keyed

KEY = "pr_number"
UPDATABLE = ["model_name", "ticket_identifier", "issue_id", "label_ids"]
DEFAULTS = {"label_ids": "array()", "created_at": "current_timestamp()"}


def ensure_state_table(spark: SparkSession, name: str, buckets: int = 16) -> DataFrame:
    """Create the table if it does not exist; return it."""
    keyed.create(spark, name, schemas.TRACKED_STATE, [KEY], buckets, DEFAULTS)
    return keyed.read(spark, name)


def upsert_state(spark: SparkSession, name: str, batch: DataFrame, at: dt.datetime) -> None:
    """Insert new keys, update the listed columns of existing ones; ``created_at`` keeps its
    first value, ``label_ids`` defaults to an empty array."""
    ensure_state_table(spark, name)
    if "label_ids" in batch.columns:
        batch = batch.withColumn("label_ids", F.coalesce(F.col("label_ids"), F.array().cast("array<string>")))
    keyed.upsert(spark, name, batch.withColumn("created_at", F.lit(at).cast("timestamp")), UPDATABLE)


def delete_state(spark: SparkSession, name: str, keys: DataFrame) -> None:
    ensure_state_table(spark, name)
    keyed.delete(spark, name, keys)


def load_state(spark: SparkSession, name: str) -> DataFrame:
    return ensure_state_table(spark, name)
