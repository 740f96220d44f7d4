"""Structured Streaming entry for the incremental daily mart.

The reference's only stream-shaped behaviour is the keyed delete+insert load of the daily
activity mart. Here a stream of policy records (any streaming source: files landing in a
folder, a message bus) drives it: each micro-batch is expanded to its day spine and merged into
the published table through ``foreachBatch``, rewriting only the month partitions the batch
touches. A micro-batch retried after a failure is skipped if the table's ledger has it, else applied
again, which is idempotent, so with the stream checkpoint each batch takes effect exactly once. The
checkpoint lives under the cluster's shared ``spark.checkpoint.dir`` unless a location is given.
"""

from __future__ import annotations

import datetime as dt
import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from premiumlake.operators.spine import daily_activity
from premiumlake.plans.build import _write_activity
from premiumlake.sources.tables import merge_partitions
from premiumlake.session import checkpoint_dir

ACTIVITY_KEYS = ["user_id", "activity_date"]


def merge_policies_batch(spark: SparkSession, batch: DataFrame, table: str, as_of: dt.date, batch_id: str | None = None) -> bool:
    """Expand one batch of policies to days and delete+insert it into ``table``, rewriting only
    the month partitions the batch touches; False where the ledger has ``batch_id`` already."""
    days = daily_activity(batch, as_of)
    return merge_partitions(spark, table, days, ACTIVITY_KEYS, "activity_month", prepare=_write_activity, batch_id=batch_id)


def stream_activity(
    spark: SparkSession,
    policies_stream: DataFrame,
    table: str,
    as_of: dt.date,
    checkpoint_location: str | None = None,
    available_now: bool = True,
) -> StreamingQuery:
    """Start the stream; with ``available_now`` it processes what has arrived and stops."""
    location = checkpoint_location or os.path.join(checkpoint_dir(spark), "streams", table.replace(".", "_"))
    writer = (
        policies_stream.writeStream.foreachBatch(
            lambda df, epoch: merge_policies_batch(df.sparkSession, df, table, as_of, f"{location}#{epoch}")
        )
        .option("checkpointLocation", location)
        .queryName(f"activity_{table.replace('.', '_')}")
    )
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()
