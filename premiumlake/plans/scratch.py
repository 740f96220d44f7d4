"""Databases for queries that go through tables: in the shared checkpoint folder, under a name of
their own, removed when the driver's interpreter ends."""

from __future__ import annotations

import atexit
import uuid

from pyspark.sql import DataFrame, SparkSession

from premiumlake.session import checkpoint_dir

_made: list[tuple[SparkSession, str]] = []
_folders: list[tuple[SparkSession, str]] = []


def scratch_location(spark: SparkSession) -> tuple[str, str]:
    """(a new prefix of names, the folder for it)."""
    mark = f"scratch_{uuid.uuid4().hex[:12]}_"
    return mark, f"{checkpoint_dir(spark).rstrip('/')}/{mark.rstrip('_')}"


def scratch_database(spark: SparkSession) -> str:
    """A new, empty database."""
    mark, folder = scratch_location(spark)
    name = f"{mark}tables"
    spark.sql(f"CREATE DATABASE {name} LOCATION '{folder}'")
    remove_at_exit(spark, name)
    return name


def scratch_path(spark: SparkSession) -> str:
    """A new folder's path; the folder goes with the interpreter."""
    _, folder = scratch_location(spark)
    _folders.append((spark, folder))
    return folder


def staged(df: DataFrame) -> DataFrame:
    """``df`` written once as Parquet in the shared folder, for queries that read it several times; the
    files go with the interpreter."""
    spark = df.sparkSession
    folder = scratch_path(spark)
    df.write.parquet(folder)
    return spark.read.schema(df.schema).parquet(folder)


def remove_at_exit(spark: SparkSession, database: str) -> None:
    _made.append((spark, database))


def _remove() -> None:
    for spark, database in _made:
        try:
            spark.sql(f"DROP DATABASE IF EXISTS {database} CASCADE")
        except Exception:  # noqa: BLE001 - the session has already ended
            return
    for spark, folder in _folders:
        try:
            path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
        except Exception:  # noqa: BLE001 - the session has already ended
            return


atexit.register(_remove)
