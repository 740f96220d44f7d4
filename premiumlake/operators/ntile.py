"""NTILE over a whole table without funnelling it through one task.

``ntile(n) OVER (ORDER BY …)`` with no PARTITION BY makes Spark move every row to a single
partition. Here the rows are range-partitioned on the ordering key (the key includes a unique
tie-break, so the order is total), sorted inside each partition, and numbered by position; the
per-partition counts (one row per partition — a bound fixed by the partition count, not by the
data) give each partition's offset, and rank → tile is arithmetic:
with N rows and q, r = divmod(N, n), the first r tiles hold q + 1 rows and the rest q rows.

Consistency between the count branch and the numbering branch: the range bounds are sampled
from the data, and column pruning makes the two branches' exchanges differ, so Spark would not
reuse one shuffle for both (checked in the plan) and could sample different bounds. The
numbered rows are therefore checkpointed once to the cluster's checkpoint folder (reliable
storage, survives executor loss, cuts the lineage) and both branches read that copy. The copy
holds one narrow row per ranked entity, far smaller than the data the ranking came from.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from premiumlake.functions.exact import int_div
from premiumlake.session import checkpoint_dir

_POS_BITS = 33  # monotonically_increasing_id: partition index above bit 33, row position below


def _tile_of(rank: Column, total: Column, n: int) -> Column:
    q = int_div(total, F.lit(n))
    r = total % n
    big = r * (q + 1)  # rows held by the first r (larger) tiles
    return (
        F.when(rank <= big, int_div(rank - 1, q + 1) + 1)
        .otherwise(r + int_div(rank - 1 - big, F.when(q != 0, q)) + 1)
        .cast("int")
    )


def ntile(df: DataFrame, n: int, order: Sequence[Column], out: str = "ntile", partitions: int | None = None) -> DataFrame:
    """Add ``out`` = NTILE(n) over the total order ``order`` (callers append a unique
    tie-break). Output partitioning follows the range partitioning of the key."""
    spark = df.sparkSession
    parts = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    numbered = (
        df.repartitionByRange(parts, *order)
        .sortWithinPartitions(*order)
        .withColumn("_mid", F.monotonically_increasing_id())
        .withColumn("_pid", F.shiftright(F.col("_mid"), _POS_BITS))
        .withColumn("_pos", F.col("_mid").bitwiseAND((1 << _POS_BITS) - 1))
        .drop("_mid")
    )
    checkpoint_dir(spark)
    numbered = numbered.checkpoint(eager=True)
    counts = numbered.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(
        "_pid",
        F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"),
        F.sum("_n").over(Window.partitionBy()).alias("_total"),
    )
    # `offsets` has one row per range partition: a size bound set by `parts`, safe to broadcast.
    ranked = numbered.join(F.broadcast(offsets), "_pid")
    rank = F.col("_offset") + F.col("_pos") + 1
    return ranked.withColumn(out, _tile_of(rank, F.col("_total"), n)).drop("_pid", "_pos", "_offset", "_total")
