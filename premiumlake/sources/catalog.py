"""Declared sources: name, description, format and schema, read by name.

The registry replaces the reference's YAML source declarations; readers always apply the
declared schema (no inference at the edge).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from premiumlake import schemas
from premiumlake.functions.exact import MONEY_IN


@dataclass(frozen=True)
class Source:
    name: str
    description: str
    format: str
    schema: StructType
    required: tuple[str, ...] = ()


SOURCES = {
    s.name: s
    for s in (
        Source(
            "raw_transactions",
            "Charges and refunds as the billing export delivers them; all columns are text, and times "
            "are written as month/day/year.",
            "csv",
            schemas.RAW_TRANSACTIONS,
            ("transaction_id",),
        ),
        Source(
            "accounting_closing",
            "Monthly premium per party reported by accounting (the reconciliation benchmark).",
            "csv",
            schemas.ACCOUNTING_CLOSING,
            ("party", "month"),
        ),
        Source(
            "policies",
            "One row per policy: acquisition, start and churn dates (NULL while open), monthly premium, product group.",
            "parquet",
            schemas.POLICIES,
        ),
    )
}


def csv_options(header: bool = True, lines: bool = False) -> dict:
    """Reader options of CSV sources: quotes are doubled inside quoted fields, and a quoted field may hold
    line breaks, unless ``lines`` says that each line is a record (then files can be split)."""
    return {"header": header, "mode": "PERMISSIVE", "quote": '"', "escape": '"', "multiLine": not lines}


def read_source(spark: SparkSession, name: str, path: str, lines: bool = False) -> DataFrame:
    """Read a declared source with its schema; CSV sources have a header row (``quarantine.load`` keeps
    their broken records). The ledger figure is narrowed to money on read."""
    src = SOURCES[name]
    reader = spark.read.schema(src.schema)
    df = reader.options(**csv_options(lines=lines)).csv(path) if src.format == "csv" else reader.format(src.format).load(path)
    if name == "accounting_closing":
        df = df.withColumn("accounting_premium", F.col("accounting_premium").cast(MONEY_IN))
    return df
