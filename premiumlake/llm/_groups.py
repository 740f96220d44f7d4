"""Shared pieces of the operators on groups: whole groups from sorted batches, and components."""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from premiumlake.llm._store import stored


def changes(table: pa.Table | pa.RecordBatch, keys: Sequence[str]) -> np.ndarray:
    """Where a new value of the (non-null) key columns begins, for rows sorted by them."""
    new = np.zeros(table.num_rows, bool)
    new[:1] = True
    for key in keys:
        values = table.column(key).to_numpy(zero_copy_only=False) if isinstance(table, pa.RecordBatch) else table.column(key).to_numpy()
        new[1:] |= values[1:] != values[:-1]
    return new


def whole_groups(batches: Iterable[pa.RecordBatch], keys: Sequence[str], size: int) -> Iterator[pa.Table]:
    """Tables of whole groups, about ``size`` bytes each (a larger group alone), from batches that
    are sorted by ``keys``."""
    held: list[pa.RecordBatch] = []
    total = 0
    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        total += batch.nbytes
        if total >= size:
            table = pa.Table.from_batches(held).combine_chunks()
            cut = int(np.flatnonzero(changes(table, keys))[-1])
            if cut:
                yield table.slice(0, cut)
                held = table.slice(cut).combine_chunks().to_batches()
                total = sum(b.nbytes for b in held)
    if held:
        yield pa.Table.from_batches(held).combine_chunks()


def components(edges: DataFrame, name: str) -> DataFrame:
    """(node, root) of the graph of (a, b) edges, null-free longs: the root is the smallest node of
    the component, and is not listed itself.

    Alternating large and small stars: every node points its larger, then its smaller neighbours
    to the least of them, until nothing changes; rounds grow with the logarithm of the size. All
    minima are combined before a shuffle, so hubs cost no more than other nodes.
    """
    now = stored(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a > b").distinct(), f"{name}-0")
    seen = None
    for number in range(1, 100):
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(least.select("a", F.col("m").alias("b")))
        now = stored(small.where("a > b").distinct(), f"{name}-{number}")
        mark = tuple(now.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b"))).first())
        if mark == seen:
            break
        seen = mark
    return now.select(F.col("a").alias("node"), F.col("b").alias("root"))
