from __future__ import annotations

import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"
SF_ORACLE = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    from premiumlake.session import JVM_OPTIONS, REQUIRED_CONF, checkpoint_dir

    scratch = tempfile.mkdtemp(prefix="premiumlake-tests-")
    builder = (
        SparkSession.builder.master("local[*]")
        .appName("premiumlake-tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.warehouse.dir", os.path.join(scratch, "warehouse"))
        .config("spark.driver.extraJavaOptions", JVM_OPTIONS)
    )
    for k, v in REQUIRED_CONF.items():
        builder = builder.config(k, v)
    session = builder.getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    checkpoint_dir(session)
    yield session
    session.stop()


@pytest.fixture(scope="session")
def duck():
    import duckdb

    from premiumlake.sources.files import TEST_TABLES

    con = duckdb.connect()
    for t in TEST_TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con
