"""Table sink: overwrite a catalog table, safely when the plan reads the table it replaces, and merge
batches into partitioned tables.

Which partitions an overwrite replaces is an option of the table (``dynamic_overwrite``), so that
no write changes a setting of the session. New columns of a merged batch are a change of the
table's metadata: files written before give NULL. Batches that carry an id are entered into a
ledger beside the table, and one that is there already is skipped.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from premiumlake.session import checkpoint_dir


def publish(
    spark: SparkSession,
    df: DataFrame,
    name: str,
    partition_by: Iterable[str] = (),
    reads_self: bool = False,
    bucket_by: tuple[int, Sequence[str]] | None = None,
) -> None:
    """Write ``df`` as table ``name`` (overwrite).

    A model that reads its own previous version (delete+insert, snapshot, upsert) is first
    checkpointed to the cluster's shared checkpoint folder: that cuts the lineage to the files
    about to be replaced, so the overwrite never reads what it deletes, and a failed write can be
    retried from the checkpoint. ``bucket_by=(n, keys)`` stores the table hash-bucketed and
    sorted on ``keys``: a later join or window on those keys between tables bucketed the same
    way needs no shuffle.
    """
    if bucket_by is not None:
        # One task per bucket: Spark's bucket id is the same Murmur3 hash as `repartition(n,
        # keys)`, so each task writes exactly one file per bucket instead of every task writing
        # a file into every bucket (tasks × buckets files).
        df = df.repartition(bucket_by[0], *bucket_by[1])
    if reads_self:
        checkpoint_dir(spark)
        df = df.checkpoint(eager=True)
    writer = df.write.mode("overwrite").format("parquet")
    parts = list(partition_by)
    if parts:
        writer = writer.partitionBy(*parts)
    if bucket_by is not None:
        n, keys = bucket_by
        writer = writer.bucketBy(n, *keys).sortBy(*keys)
    writer.saveAsTable(name)
    spark.catalog.refreshTable(name)


def quoted(name: str) -> str:
    return ".".join(f"`{part}`" for part in name.split("."))


def dynamic_overwrite(spark: SparkSession, name: str) -> None:
    """Make overwrites of the partitioned table ``name`` replace only the partitions that they have
    rows in, in any session."""
    spark.sql(f"ALTER TABLE {quoted(name)} SET SERDEPROPERTIES ('partitionOverwriteMode' = 'dynamic')")
    spark.catalog.refreshTable(name)


def ledger(name: str) -> str:
    """Name of the table that lists the applied batches of ``name``: batch_id, applied_at."""
    return f"{name}__batches"


def is_applied(spark: SparkSession, name: str, batch_id: str) -> bool:
    book = ledger(name)
    return spark.catalog.tableExists(book) and not spark.table(book).where(F.col("batch_id") == batch_id).isEmpty()


def _enter(spark: SparkSession, name: str, batch_id: str) -> None:
    book = ledger(name)
    spark.sql(f"CREATE TABLE IF NOT EXISTS {quoted(book)} (batch_id STRING, applied_at TIMESTAMP) USING parquet")
    entry = spark.range(1).select(F.lit(batch_id).alias("batch_id"), F.current_timestamp().alias("applied_at"))
    entry.coalesce(1).write.mode("append").insertInto(book)
    spark.catalog.refreshTable(book)


def add_columns(spark: SparkSession, name: str, batch: DataFrame) -> bool:
    """Add the columns that only ``batch`` has to the table's metadata; no file is read or written.
    False where that is not enough: the batch lacks a column or has one of another type."""
    have = {f.name: f.dataType for f in spark.table(name).schema.fields}
    give = {f.name: f.dataType for f in batch.schema.fields}
    if any(give.get(c) != kind for c, kind in have.items()):
        return False
    if new := [c for c in give if c not in have]:
        spark.sql(f"ALTER TABLE {quoted(name)} ADD COLUMNS ({', '.join(f'`{c}` {give[c].simpleString()}' for c in new)})")
        spark.catalog.refreshTable(name)
    return True


def merge_partitions(
    spark: SparkSession,
    name: str,
    batch: DataFrame,
    keys: Sequence[str],
    partition_col: str,
    prepare=None,
    batch_id: str | None = None,
) -> bool:
    """Delete+insert ``batch`` into the table partitioned by ``partition_col``, rewriting only
    the partitions the batch touches.

    ``partition_col`` must be a function of ``keys`` (the daily mart: month of the activity
    date), so a target row whose key is in the batch can only live in a partition the batch
    touches; rows elsewhere are neither read nor rewritten. The target is semi-joined to the
    batch's distinct partition values (dynamic partition pruning at any number of them), the
    partition of NULL values included. New columns of the batch are added to the table's metadata; a
    batch that lacks columns, or changes the type of one, has the whole table merged and rewritten.
    ``prepare`` (e.g. a range re-partitioning) is applied to the rows before they are written.

    A batch with a ``batch_id`` that was applied before is skipped (returns False). The id is
    entered after the write: a run that ends between the two applies the batch once more, which
    gives the same rows.
    """
    if batch_id is not None and is_applied(spark, name, batch_id):
        return False
    _merge(spark, name, batch, keys, partition_col, prepare or (lambda df: df))
    if batch_id is not None:
        _enter(spark, name, batch_id)
    return True


def _merge(spark: SparkSession, name: str, batch: DataFrame, keys: Sequence[str], partition_col: str, prepare) -> None:
    from premiumlake.operators.history import delete_insert

    if not spark.catalog.tableExists(name):
        publish(spark, prepare(batch), name, partition_by=[partition_col])
        return
    if not add_columns(spark, name, batch):
        merged = delete_insert(spark.table(name), batch, keys, sync=True)
        publish(spark, prepare(merged), name, partition_by=[partition_col], reads_self=True)
        return
    target = spark.table(name)
    checkpoint_dir(spark)
    batch = batch.select(*target.columns).checkpoint(eager=True)  # read three times below, produced once
    values = batch.select(partition_col)
    touched = target.join(values.distinct(), partition_col, "left_semi").select(*target.columns)
    if not values.where(F.col(partition_col).isNull()).isEmpty():
        touched = touched.unionByName(target.where(F.col(partition_col).isNull()))
    merged = prepare(delete_insert(touched, batch, keys, sync=False)).checkpoint(eager=True)
    overwrite_partitions(spark, merged, name)


def overwrite_partitions(spark: SparkSession, df: DataFrame, name: str) -> None:
    """Replace exactly the partitions of ``name`` that ``df`` has rows in (dynamic partition
    overwrite); ``df`` must carry the table's columns. Other partitions are not touched."""
    dynamic_overwrite(spark, name)
    df.select(*spark.table(name).columns).write.mode("overwrite").insertInto(name)
    spark.catalog.refreshTable(name)
