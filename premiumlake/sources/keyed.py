"""Keyed table sink: rows in hash buckets of their key, constraints in the table's metadata.

A keyed table is a Parquet table partitioned by ``_bucket``, a hash of its key columns. A row of a
key can only lie in its key's bucket, so a write reads and rewrites the buckets that the batch
touches and no others. Their number is fixed when the table is made; keys are unique, so the
buckets are even, and a bucket beyond the advisory size is written by several tasks.

The key, the columns that must not be NULL and the column DEFAULTs are stored with the table, and
every write goes by them, whoever made the table: a column that the batch lacks takes its default,
and a NULL in a required column, a key twice in the batch or, on ``insert``, a key that the table
has already, is refused before anything is written.

The overwrite mode belongs to the table, not to the session: only partitions present in a write are
replaced, when its job commits, so a failed job leaves the table as it was and the same batch can
be written again.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from premiumlake.operators.history import upsert as merge_rows
from premiumlake.session import checkpoint_dir
from premiumlake.sources.tables import dynamic_overwrite, quoted

BUCKET = "_bucket"
_KEY, _REQUIRED, _BUCKETS = "premiumlake.key", "premiumlake.not_null", "premiumlake.buckets"


class ConstraintError(ValueError):
    """A batch was refused. ``violations``: rows by constraint."""

    def __init__(self, table: str, violations: dict[str, int]):
        super().__init__(f"{table}: " + ", ".join(f"{what} ({n})" for what, n in violations.items()))
        self.violations = violations


@dataclass(frozen=True)
class Layout:
    """What a keyed table's metadata say."""

    key: tuple[str, ...]
    required: tuple[str, ...]
    buckets: int
    schema: T.StructType

    def bucket(self) -> Column:
        """Bucket of a row. The key columns must have the table's types."""
        return F.pmod(F.xxhash64(*self.key), F.lit(self.buckets)).cast("int")

    def default(self, field: T.StructField) -> Column:
        text = (field.metadata or {}).get("CURRENT_DEFAULT")
        return F.lit(None) if text is None else F.expr(text)


def create(
    spark: SparkSession, name: str, schema: T.StructType, key: Sequence[str], buckets: int = 16, defaults: Mapping[str, str] | None = None
) -> None:
    """Make the table if it does not exist. Columns of ``schema`` that are not nullable, and the key,
    are required; ``defaults`` holds SQL expressions by column."""
    defaults = dict(defaults or {})
    names = schema.fieldNames()
    if strange := sorted({*key, *defaults} - set(names)):
        raise ValueError(f"not columns of {name}: {strange}")
    if not key or buckets < 1 or BUCKET in names:
        raise ValueError("a keyed table needs a key, a bucket and no column of the bucket's name")
    required = [f.name for f in schema.fields if not f.nullable or f.name in key]
    columns = ", ".join(
        f"`{f.name}` {f.dataType.simpleString()}" + (f" DEFAULT {defaults[f.name]}" if f.name in defaults else "") for f in schema.fields
    )
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {quoted(name)} ({columns}, {BUCKET} INT) USING parquet PARTITIONED BY ({BUCKET}) "
        f"TBLPROPERTIES ('{_KEY}' = '{','.join(key)}', '{_REQUIRED}' = '{','.join(required)}', '{_BUCKETS}' = '{buckets}')"
    )
    dynamic_overwrite(spark, name)


def layout(spark: SparkSession, name: str) -> Layout:
    found = {r["key"]: r["value"] for r in spark.sql(f"SHOW TBLPROPERTIES {quoted(name)}").collect()}
    if _KEY not in found:
        raise ValueError(f"{name} is not a keyed table")
    fields = [f for f in spark.table(name).schema.fields if f.name != BUCKET]
    return Layout(tuple(found[_KEY].split(",")), tuple(found[_REQUIRED].split(",")), int(found[_BUCKETS]), T.StructType(fields))


def read(spark: SparkSession, name: str) -> DataFrame:
    return spark.table(name).drop(BUCKET)


def in_buckets(spark: SparkSession, name: str, buckets: Sequence[int]) -> DataFrame:
    """The table's rows in ``buckets``, with their bucket; other folders are not read."""
    return spark.table(name).where(F.col(BUCKET).isin([int(b) for b in buckets]))


def _checked(spark: SparkSession, name: str, table: Layout, batch: DataFrame) -> tuple[DataFrame, list[int]]:
    """(the batch with all columns of the table, the buckets that it touches). One aggregate by key,
    combined before its shuffle, finds the violations and the buckets."""
    if strange := [c for c in batch.columns if c not in table.schema.fieldNames()]:
        raise ValueError(f"{name} has no columns {strange}")
    rows = batch.select(
        *[(F.col(f"`{f.name}`") if f.name in batch.columns else table.default(f)).cast(f.dataType).alias(f.name) for f in table.schema.fields]
    ).withColumn(BUCKET, table.bucket())
    checkpoint_dir(spark)
    rows = rows.checkpoint(eager=True)  # checked and merged, produced once
    nulls = [F.count_if(F.col(f"`{c}`").isNull()).alias(f"_null_{k}") for k, c in enumerate(table.required)]
    by_key = rows.groupBy(BUCKET, *table.key).agg(F.count(F.lit(1)).alias("_rows"), *nulls)
    found = by_key.agg(
        F.coalesce(F.sum(F.col("_rows") - 1), F.lit(0)).alias("repeated"),
        F.collect_set(BUCKET).alias("buckets"),  # at most the table's number of buckets
        *[F.coalesce(F.sum(f"_null_{k}"), F.lit(0)).alias(f"_null_{k}") for k in range(len(table.required))],
    ).first()
    violations = {f"null in {c}": found[f"_null_{k}"] for k, c in enumerate(table.required) if found[f"_null_{k}"]}
    if found["repeated"]:
        violations["key repeated in the batch"] = found["repeated"]
    if violations:
        raise ConstraintError(name, violations)
    return rows, sorted(found["buckets"])


def _write(spark: SparkSession, name: str, rows: DataFrame, mode: str) -> None:
    rows.select(*spark.table(name).columns).hint("rebalance", BUCKET).write.mode(mode).insertInto(name)
    spark.catalog.refreshTable(name)


def insert(spark: SparkSession, name: str, batch: DataFrame) -> list[int]:
    """Add new rows; a key that the table has already is refused. Returns the buckets written. The
    files of a bucket become one again at its next ``upsert``."""
    table = layout(spark, name)
    rows, buckets = _checked(spark, name, table, batch)
    if present := in_buckets(spark, name, buckets).join(rows.select(*table.key), list(table.key), "left_semi").count():
        raise ConstraintError(name, {"key in the table already": present})
    if buckets:
        _write(spark, name, rows, "append")
    return buckets


def upsert(spark: SparkSession, name: str, batch: DataFrame, update: Sequence[str] | None = None) -> list[int]:
    """Insert new keys and set ``update`` (default: the columns of the batch besides the key) of keys
    that the table has. Returns the buckets rewritten."""
    table = layout(spark, name)
    update = [c for c in batch.columns if c not in table.key] if update is None else list(update)
    rows, buckets = _checked(spark, name, table, batch)
    if buckets:
        _write(spark, name, merge_rows(in_buckets(spark, name, buckets), rows, table.key, update), "overwrite")
    return buckets


def delete(spark: SparkSession, name: str, keys: DataFrame) -> list[int]:
    """Remove the rows of ``keys`` (repeats and unknown keys do no harm, a NULL is no key). Returns the buckets touched;
    of these, those left empty lose their partition."""
    table = layout(spark, name)
    kinds = {f.name: f.dataType for f in table.schema.fields}
    gone = keys.select(*[F.col(f"`{c}`").cast(kinds[c]).alias(c) for c in table.key]).dropna().distinct().withColumn(BUCKET, table.bucket())
    checkpoint_dir(spark)
    gone = gone.checkpoint(eager=True)
    touched = sorted(r[0] for r in gone.select(BUCKET).distinct().collect())
    if not touched:
        return []
    left = in_buckets(spark, name, touched).join(gone.drop(BUCKET), list(table.key), "left_anti")
    filled = {r[0] for r in left.select(BUCKET).distinct().collect()}
    if filled:
        _write(spark, name, left, "overwrite")
    if empty := [b for b in touched if b not in filled]:
        drops = ", ".join(f"PARTITION ({BUCKET} = {b})" for b in empty)
        spark.sql(f"ALTER TABLE {quoted(name)} DROP IF EXISTS {drops}")
        spark.catalog.refreshTable(name)
    return touched
