"""Full-refresh table sink: every refresh is a table of its own, and a view points to the current one.

``stage`` writes a new version next to the others, ``swap`` points the view to it. Replacing a view
is one update of the catalog, so a reader sees the old version or the new one, never a mixture or
nothing; a reader that was planned before the swap goes on reading the version that it resolved.
A write that fails leaves the view as it was. Versions keep their bucketing and partitions, which
plans over the view use. The newest ``keep`` versions stay, for readers still running and for
``rollback``.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession

_VERSION = re.compile(r"(.+)__v(\d{6})_([0-9a-f]{8})")


def _parts(name: str) -> tuple[str, str]:
    database, _, table = name.rpartition(".")
    return database or "default", table


def _quoted(name: str) -> str:
    return ".".join(f"`{part}`" for part in name.split("."))


def versions(spark: SparkSession, name: str) -> list[str]:
    """Full names of the versions of ``name``, oldest first."""
    database, table = _parts(name)
    names = [r["tableName"] for r in spark.sql(f"SHOW TABLES IN `{database}` LIKE '{table.lower()}__v*'").collect()]
    found = [(int(m[2]), n) for n in names if (m := _VERSION.fullmatch(n)) and m[1] == table.lower()]
    return [f"{database}.{n}" for _, n in sorted(found)]


def stage(
    spark: SparkSession, df: DataFrame, name: str, partition_by: Iterable[str] = (), bucket_by: tuple[int, Sequence[str]] | None = None
) -> str:
    """Write ``df`` as the next version of ``name`` without publishing it; returns the version. What
    a failed write has left is removed."""
    database, table = _parts(name)
    before = versions(spark, name)
    number = 1 + (int(_VERSION.fullmatch(before[-1].rsplit(".", 1)[-1])[2]) if before else 0)
    version = f"{database}.{table.lower()}__v{number:06d}_{uuid.uuid4().hex[:8]}"
    if bucket_by is not None:  # one task a bucket, so that each writes one file
        df = df.repartition(bucket_by[0], *bucket_by[1])
    writer = df.write.format("parquet").mode("errorifexists")
    if parts := list(partition_by):
        writer = writer.partitionBy(*parts)
    if bucket_by is not None:
        writer = writer.bucketBy(bucket_by[0], *bucket_by[1]).sortBy(*bucket_by[1])
    try:
        writer.saveAsTable(version)
    except Exception:
        discard(spark, version)
        raise
    return version


def discard(spark: SparkSession, version: str) -> None:
    """Remove a version that is not published."""
    spark.sql(f"DROP TABLE IF EXISTS {_quoted(version)}")


def current(spark: SparkSession, name: str) -> str | None:
    """The version that ``name`` points to, or None."""
    if not spark.catalog.tableExists(name):
        return None
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {_quoted(name)}").where("col_name = 'View Text'").collect()
    if not rows:
        return None
    return rows[0]["data_type"].rsplit(" ", 1)[-1].replace("`", "")


def swap(spark: SparkSession, name: str, version: str, keep: int = 2) -> None:
    """Point ``name`` to ``version`` and remove versions older than the newest ``keep``. A plain
    table of that name becomes a version of its own first."""
    if keep < 1:
        raise ValueError("the current version must stay")
    if spark.catalog.tableExists(name) and current(spark, name) is None:
        database, table = _parts(name)
        spark.sql(f"ALTER TABLE {_quoted(name)} RENAME TO `{database}`.`{table.lower()}__v000000_{uuid.uuid4().hex[:8]}`")
    spark.sql(f"CREATE OR REPLACE VIEW {_quoted(name)} AS SELECT * FROM {_quoted(version)}")
    for old in versions(spark, name)[:-keep]:
        if old != version:
            discard(spark, old)


def refresh(
    spark: SparkSession, df: DataFrame, name: str, partition_by: Iterable[str] = (), bucket_by: tuple[int, Sequence[str]] | None = None, keep: int = 2
) -> str:
    """Stage ``df`` and publish it. ``df`` may read ``name`` itself: that is the version before."""
    version = stage(spark, df, name, partition_by, bucket_by)
    swap(spark, name, version, keep)
    return version


def rollback(spark: SparkSession, name: str) -> str:
    """Point ``name`` to the version before the current one."""
    known = versions(spark, name)
    now = current(spark, name)
    at = known.index(now) if now in known else 0
    if at == 0:
        raise ValueError(f"{name} has no version before {now}")
    spark.sql(f"CREATE OR REPLACE VIEW {_quoted(name)} AS SELECT * FROM {_quoted(known[at - 1])}")
    return known[at - 1]
