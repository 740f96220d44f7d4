"""Readers for the declared sources: CSV feeds with explicit schemas, Parquet tables, inline rows.

Parquet is the default storage; CSV appears only at the raw edge, as in the reference's seeds.
Every reader stays lazy.
"""

from __future__ import annotations

import os
from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from premiumlake import schemas
from premiumlake.sources.catalog import read_source

# Supplied test tables (one Parquet file each).
TEST_TABLES = (
    "region",
    "nation",
    "customer",
    "supplier",
    "part",
    "orders",
    "lineitem",
    "events",
    "documents",
    "embeddings",
    "pages",
    "benchmark",
    "labels",
    "conversations",
)


_SCHEMAS: dict[str, StructType] = {}


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One supplied table as a lazy Parquet scan (filters and projections push into it).

    The footer schema is inferred once per path and then passed explicitly, which saves a
    schema-inference job on every later read of the same table.
    """
    path = os.path.join(sf_dir, f"{name}.parquet")
    schema = _SCHEMAS.get(path)
    if schema is None:
        df = spark.read.parquet(path)
        _SCHEMAS[path] = df.schema
        return df
    return spark.read.schema(schema).parquet(path)


def register_views(spark: SparkSession, sf_dir: str, names: Iterable[str] = TEST_TABLES) -> None:
    """Temp views over the supplied tables, for SQL entry points."""
    for name in names:
        read_table(spark, sf_dir, name).createOrReplaceTempView(name)


def read_raw_transactions_csv(spark: SparkSession, path: str) -> DataFrame:
    """Raw transaction feed: header row, every column a string (types come later, in silver)."""
    return read_source(spark, "raw_transactions", path)


def read_accounting_csv(spark: SparkSession, path: str) -> DataFrame:
    """Ledger seed (party, month, accounting_premium); the figure is narrowed to money."""
    return read_source(spark, "accounting_closing", path)


def policies_from_rows(spark: SparkSession, rows: Sequence[tuple]) -> DataFrame:
    """Inline policy rows with the declared schema (a bare NULL would be typed void)."""
    return spark.createDataFrame(list(rows), schemas.POLICIES)


def read_jdbc(
    spark: SparkSession,
    url: str,
    table: str,
    properties: dict | None = None,
    partition_column: str | None = None,
    lower_bound: int | None = None,
    upper_bound: int | None = None,
    num_partitions: int | None = None,
) -> DataFrame:
    """Optional relational source; needs the JDBC driver on the cluster's classpath.

    With ``partition_column`` (numeric, date or timestamp) and bounds, Spark reads
    ``num_partitions`` ranges over parallel connections instead of one query on one connection.
    """
    if partition_column is None:
        return spark.read.jdbc(url, table, properties=properties or {})
    return spark.read.jdbc(
        url,
        table,
        column=partition_column,
        lowerBound=lower_bound,
        upperBound=upper_bound,
        numPartitions=num_partitions,
        properties=properties or {},
    )
