"""Keyed tables: scope of writes, constraints, defaults; ledger and metadata of merged batches."""

from __future__ import annotations

import os
import random
import uuid

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from premiumlake.sources import keyed, tables

SCHEMA = T.StructType(
    [
        T.StructField("k", T.IntegerType(), False),
        T.StructField("name", T.StringType(), False),
        T.StructField("tags", T.ArrayType(T.StringType())),
        T.StructField("made", T.TimestampType()),
    ]
)


@pytest.fixture
def table(spark):
    spark.sql("CREATE DATABASE IF NOT EXISTS keyed_tests")
    name = f"keyed_tests.t_{uuid.uuid4().hex[:8]}"
    keyed.create(spark, name, SCHEMA, ["k"], 8, {"tags": "array()", "made": "current_timestamp()"})
    return name


def frame(spark, rows):
    return spark.createDataFrame(rows, "k int, name string")


def content(spark, name):
    return sorted((r.k, r.name) for r in keyed.read(spark, name).collect())


def files(spark, name):
    location = spark.sql(f"DESCRIBE TABLE EXTENDED {name}").where("col_name = 'Location'").first().data_type
    root = location.replace("file:", "")
    return {int(d.split("=")[1]): sorted(f for f in os.listdir(os.path.join(root, d)) if f.endswith(".parquet"))
            for d in os.listdir(root) if d.startswith("_bucket=")}


def test_upsert_rewrites_only_the_buckets_of_its_keys(spark, table):
    keyed.insert(spark, table, frame(spark, [(k, "a") for k in range(200)]))
    before = files(spark, table)
    assert len(before) == 8
    touched = keyed.upsert(spark, table, frame(spark, [(7, "b"), (1007, "new")]))
    after = files(spark, table)
    assert 1 <= len(touched) <= 2
    assert {b for b in after if after[b] != before[b]} == set(touched)
    assert content(spark, table) == sorted([(k, "b" if k == 7 else "a") for k in range(200)] + [(1007, "new")])


def test_only_touched_buckets_are_read(spark, table):
    keyed.insert(spark, table, frame(spark, [(k, "a") for k in range(200)]))
    plan = keyed.in_buckets(spark, table, [3])._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(_bucket" in plan
    names = {f.rsplit("/", 2)[1] for f in (r[0] for r in keyed.in_buckets(spark, table, [3]).select(F.input_file_name()).distinct().collect())}
    assert names == {"_bucket=3"}


def test_delete_drops_emptied_buckets(spark, table):
    keyed.insert(spark, table, frame(spark, [(k, "a") for k in range(40)]))
    bucket = {r.k: r._bucket for r in spark.table(table).collect()}
    doomed = [k for k in bucket if bucket[k] == bucket[0]] + [next(k for k in bucket if bucket[k] != bucket[0])]
    before = files(spark, table)
    touched = keyed.delete(spark, table, spark.createDataFrame([(k,) for k in [*doomed, *doomed, 999]] + [(None,)], "k int"))
    after = files(spark, table)
    assert content(spark, table) == sorted((k, "a") for k in bucket if k not in doomed)
    assert bucket[0] not in after
    assert {b for b in before if after.get(b) != before[b]} <= set(touched)


def test_refusals_leave_the_table_as_it_was(spark, table):
    keyed.insert(spark, table, frame(spark, [(1, "a"), (2, "b")]))
    with pytest.raises(keyed.ConstraintError) as twice:
        keyed.insert(spark, table, frame(spark, [(3, "x"), (3, "y"), (3, "z")]))
    assert twice.value.violations == {"key repeated in the batch": 2}
    with pytest.raises(keyed.ConstraintError) as null:
        keyed.upsert(spark, table, frame(spark, [(None, "x"), (4, None), (5, "c")]))
    assert null.value.violations == {"null in k": 1, "null in name": 1}
    with pytest.raises(keyed.ConstraintError) as present:
        keyed.insert(spark, table, frame(spark, [(2, "x"), (9, "y")]))
    assert present.value.violations == {"key in the table already": 1}
    with pytest.raises(keyed.ConstraintError):  # a required column without a default is not in the batch
        keyed.insert(spark, table, spark.createDataFrame([(9,)], "k int"))
    with pytest.raises(ValueError, match="no columns"):
        keyed.insert(spark, table, frame(spark, [(9, "y")]).withColumn("other", F.lit(1)))
    assert content(spark, table) == [(1, "a"), (2, "b")]


def test_defaults_hold_for_every_writer(spark, table):
    keyed.insert(spark, table, frame(spark, [(1, "a")]))
    spark.sql(f"INSERT INTO {table} (k, name, _bucket) SELECT 2, 'b', CAST(pmod(xxhash64(2), 8) AS INT)")
    rows = {r.k: r for r in keyed.read(spark, table).collect()}
    assert all(r.tags == [] and r.made is not None for r in rows.values())
    made = rows[1].made
    keyed.upsert(spark, table, frame(spark, [(1, "c")]))
    row = keyed.read(spark, table).where("k = 1").first()
    assert (row.name, row.made) == ("c", made)


def test_create_keeps_an_existing_table_and_refuses_nonsense(spark, table):
    keyed.insert(spark, table, frame(spark, [(1, "a")]))
    keyed.create(spark, table, SCHEMA, ["k"], 64)
    assert keyed.layout(spark, table).buckets == 8
    assert content(spark, table) == [(1, "a")]
    for key, buckets, defaults in ((["nope"], 4, {}), ([], 4, {}), (["k"], 0, {}), (["k"], 4, {"nope": "1"})):
        with pytest.raises(ValueError):
            keyed.create(spark, f"{table}_x", SCHEMA, key, buckets, defaults)


def test_empty_batches_write_nothing(spark, table):
    for write in (keyed.insert, keyed.upsert):
        assert write(spark, table, frame(spark, [])) == []
    assert keyed.delete(spark, table, spark.createDataFrame([], "k int")) == []
    assert files(spark, table) == {}


def test_random_cycles_match_a_dictionary(spark, table):
    rng, model = random.Random(5), {}
    for step in range(4):
        batch = {rng.randrange(60): f"v{step}_{n}" for n in range(25)}
        keyed.upsert(spark, table, frame(spark, list(batch.items())))
        model.update(batch)
        gone = [rng.randrange(60) for _ in range(15)]
        keyed.delete(spark, table, spark.createDataFrame([(k,) for k in gone], "k int"))
        for k in gone:
            model.pop(k, None)
        assert content(spark, table) == sorted(model.items())


def test_merge_skips_a_batch_of_the_ledger(spark):
    name = f"ledger_{uuid.uuid4().hex[:8]}"
    rows = lambda *r: spark.createDataFrame(r, "id int, v string, month string")
    assert tables.merge_partitions(spark, name, rows((1, "a", "m1"), (2, "a", None)), ["id"], "month", batch_id="b1")
    assert tables.merge_partitions(spark, name, rows((1, "b", "m1")), ["id"], "month", batch_id="b2")
    assert not tables.merge_partitions(spark, name, rows((1, "a", "m1"), (2, "a", None)), ["id"], "month", batch_id="b1")
    assert sorted((r.id, r.v) for r in spark.table(name).collect()) == [(1, "b"), (2, "a")]
    assert sorted(r.batch_id for r in spark.table(tables.ledger(name)).collect()) == ["b1", "b2"]


def test_a_new_column_rewrites_only_touched_partitions(spark):
    name = f"widen_{uuid.uuid4().hex[:8]}"
    first = spark.createDataFrame([(1, "a", "m1"), (2, "a", "m2"), (3, "a", None)], "id int, v string, month string")
    tables.merge_partitions(spark, name, first, ["id"], "month")
    old = {r[0] for r in spark.table(name).where("month = 'm2' OR month IS NULL").select(F.input_file_name()).collect()}
    mode = spark.conf.get("spark.sql.sources.partitionOverwriteMode")
    wider = spark.createDataFrame([(1, "b", 5, "m1")], "id int, v string, score int, month string")
    tables.merge_partitions(spark, name, wider, ["id"], "month")
    assert spark.conf.get("spark.sql.sources.partitionOverwriteMode") == mode
    assert sorted(((r.id, r.v, r.score) for r in spark.table(name).collect())) == [(1, "b", 5), (2, "a", None), (3, "a", None)]
    assert old == {r[0] for r in spark.table(name).where("month = 'm2' OR month IS NULL").select(F.input_file_name()).collect()}
