"""Tables written between jobs, in the shared folder that ``spark.checkpoint.dir`` names.

A written table cuts lineage like ``checkpoint()`` does, survives the loss of executors, and
keeps Parquet's column pruning and statistics. The files of a session are removed when the
driver's interpreter ends.
"""

from __future__ import annotations

import atexit
import gc
import uuid

from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession

from premiumlake.session import checkpoint_dir

_written: list[tuple[SparkSession, str, str | None]] = []


def folder(spark: SparkSession, name: str, table: str | None = None) -> str:
    """A new path below the shared folder, for ``table`` of the catalog if given; both are removed at exit."""
    path = f"{checkpoint_dir(spark).rstrip('/')}/llm-{uuid.uuid4().hex}/{name}"
    _written.append((spark, path.rsplit("/", 1)[0], table))
    return path


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once as Parquet in the shared folder and read back."""
    spark, schema = df.sparkSession, df.schema
    path = folder(spark, name)
    df.write.parquet(path)
    del df
    release_shuffles(spark)
    return spark.read.schema(schema).parquet(path)


def release_shuffles(spark: SparkSession) -> None:
    """Let Spark remove the shuffle files of plans that nothing refers to any more; they would stay
    on the executors' disks until the driver happens to collect its garbage. Spark's scheduler keeps
    hold of the last job, shuffles included, until it gets another one: here a job of one row."""
    spark.range(0, 1, 1, 1).write.format("noop").mode("overwrite").save()
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def shared(spark: SparkSession, value):
    """A broadcast of ``value`` as bytes that carry this package's classes along, so that executors can
    read it without the package: ``pickle.loads(shared(...).value)``."""
    return spark.sparkContext.broadcast(cloudpickle.dumps(value))


def written() -> int:
    """How many folders were made so far; a mark for ``drop_written``."""
    return len(_written)


def drop_written(start: int = 0, end: int | None = None) -> None:
    """Remove the tables written between two marks; results that still read them become
    unreadable."""
    removed = _written[start:end]
    _written[start:end] = []
    for spark, path, table in removed:
        try:
            if table:
                spark.sql(f"DROP TABLE IF EXISTS {table}")
            jvm = spark.sparkContext._jvm
            target = jvm.org.apache.hadoop.fs.Path(path)
            target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)
        except Exception:  # noqa: BLE001 - the session has already ended
            return


atexit.register(drop_written)
