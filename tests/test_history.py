"""SCD2 snapshot, delete+insert, schema sync, upsert and delete (B11, B22, B23)."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from premiumlake.operators import history as H

T1, T2, T3 = dt.datetime(2025, 1, 1), dt.datetime(2025, 2, 1), dt.datetime(2025, 3, 1)
SCHEMA = "id string, status string, amount int, party string"


def rows(df, *cols):
    return sorted((tuple(r[c] for c in cols) for r in df.collect()), key=lambda t: tuple((x is None, x) for x in t))


def test_scd2_check_strategy(spark):
    b1 = spark.createDataFrame([("1", "a", 1, "p"), ("2", "a", 1, "p"), ("3", None, 1, "p"), ("4", "a", 1, "p")], SCHEMA)
    h1 = H.scd2_snapshot(None, b1, "id", ["status", "amount"], T1)
    assert h1.where("is_current").count() == 4
    # 1 unchanged, 2 status change, 3 NULL → value, 4 deleted, 5 new, party change on 1 is ignored
    b2 = spark.createDataFrame([("1", "a", 1, "q"), ("2", "b", 1, "p"), ("3", "a", 1, "p"), ("5", "a", 9, "p")], SCHEMA)
    h2 = H.scd2_snapshot(h1, b2, "id", ["status", "amount"], T2)
    got = {(r.id, r.status, r.party, r.valid_from, r.valid_to, r.is_current) for r in h2.collect()}
    assert got == {
        ("1", "a", "p", T1, None, True),
        ("2", "a", "p", T1, T2, False),
        ("2", "b", "p", T2, None, True),
        ("3", None, "p", T1, T2, False),
        ("3", "a", "p", T2, None, True),
        ("4", "a", "p", T1, T2, False),
        ("5", "a", "p", T2, None, True),
    }
    # unchanged input adds no row; a returning key opens a new version
    h3 = H.scd2_snapshot(h2, b2, "id", ["status", "amount"], T3)
    assert h3.count() == h2.count()
    back = b2.unionByName(spark.createDataFrame([("4", "a", 1, "p")], SCHEMA))
    h4 = H.scd2_snapshot(h3, back, "id", ["status", "amount"], T3)
    assert h4.where("id = '4' AND is_current").count() == 1 and h4.where("id = '4'").count() == 2


def test_scd2_versions_are_exact(spark):
    b1 = spark.createDataFrame([("1", "a", 1, "p"), ("2", "a", 1, "p")], SCHEMA)
    b2 = spark.createDataFrame([("1", "a", 1, "CHANGED"), ("2", "b", 1, "p")], SCHEMA)
    h2 = H.scd2_snapshot(H.scd2_snapshot(None, b1, "id", ["status", "amount"], T1), b2, "id", ["status", "amount"], T2)
    got = {(r.id, r.status, r.party, r.valid_to, r.is_current) for r in h2.collect()}
    assert got == {("1", "a", "p", None, True), ("2", "a", "p", T2, False), ("2", "b", "p", None, True)}


def test_scd2_duplicate_keys_fail(spark):
    dup = spark.createDataFrame([("1", "a", 1, "p"), ("1", "b", 1, "p")], SCHEMA)
    with pytest.raises(Exception, match="duplicate key"):
        H.scd2_snapshot(None, dup, "id", ["status"], T1).collect()


def test_delete_insert_b11_idempotent(spark):
    target = spark.createDataFrame([("u", 1, 10), ("u", 2, 10), ("u", 3, 10), ("v", 1, 10)], "user_id string, d int, x int")
    batch = spark.createDataFrame([("u", 1, 20), ("u", 2, 20), ("u", 2, 21)], "user_id string, d int, x int")
    once = H.delete_insert(target, batch, ["user_id", "d"])
    assert rows(once, "user_id", "d", "x") == [("u", 1, 20), ("u", 2, 20), ("u", 2, 21), ("u", 3, 10), ("v", 1, 10)]
    twice = H.delete_insert(once, batch, ["user_id", "d"])
    assert rows(twice, "user_id", "d", "x") == rows(once, "user_id", "d", "x")


def test_schema_sync(spark):
    target = spark.createDataFrame([("a", 1, "old")], "k string, v int, gone string")
    batch = spark.createDataFrame([("b", 2, 3.5)], "k string, v long, added double")
    out = H.delete_insert(target, batch, ["k"], sync=True)
    assert out.columns == ["k", "v", "added"] and dict(out.dtypes)["v"] == "bigint"
    assert rows(out, "k", "v", "added") == [("a", 1, None), ("b", 2, 3.5)]


def test_upsert_b23_keeps_unlisted_columns(spark):
    target = spark.createDataFrame(
        [(1, "m1", "T-1", ["x"], dt.datetime(2024, 1, 1))], "pr_number int, model_name string, ticket string, label_ids array<string>, created_at timestamp"
    )
    batch = spark.createDataFrame([(1, "m2", "T-9", ["y"]), (2, "m3", "T-2", [])], "pr_number int, model_name string, ticket string, label_ids array<string>")
    out = H.upsert(target, batch, ["pr_number"], ["model_name", "label_ids"], defaults={"created_at": F.lit(dt.datetime(2025, 5, 5))})
    got = {r.pr_number: r for r in out.collect()}
    assert (got[1].model_name, got[1].ticket, got[1].label_ids, got[1].created_at) == ("m2", "T-1", ["y"], dt.datetime(2024, 1, 1))
    assert (got[2].model_name, got[2].ticket, got[2].created_at) == ("m3", "T-2", dt.datetime(2025, 5, 5))
    with pytest.raises(Exception, match="duplicate key"):
        H.upsert(target, batch.unionByName(batch), ["pr_number"], ["model_name"]).collect()


def test_delete_keys(spark):
    target = spark.createDataFrame([(1,), (2,), (3,)], "k int")
    assert rows(H.delete_keys(target, spark.createDataFrame([(2,), (2,), (9,)], "k int")), "k") == [(1,), (3,)]


def test_state_table_lifecycle(spark):
    from premiumlake.operators import state as S
    from premiumlake.sources.catalog import SOURCES

    assert set(SOURCES) == {"raw_transactions", "accounting_closing", "policies"}
    spark.sql("CREATE DATABASE IF NOT EXISTS st")
    name = "st.tracked"
    assert S.load_state(spark, name).count() == 0
    first = spark.createDataFrame([(7, "m", "T-1", "i1")], "pr_number int, model_name string, ticket_identifier string, issue_id string")
    S.upsert_state(spark, name, first, dt.datetime(2025, 1, 1))
    again = spark.createDataFrame([(7, "m2", "T-1", "i1", ["a"]), (8, "n", "T-2", "i2", None)],
                                  "pr_number int, model_name string, ticket_identifier string, issue_id string, label_ids array<string>")
    S.upsert_state(spark, name, again, dt.datetime(2025, 2, 1))
    got = {r.pr_number: r for r in S.load_state(spark, name).collect()}
    assert (got[7].model_name, got[7].label_ids, got[7].created_at) == ("m2", ["a"], dt.datetime(2025, 1, 1))
    assert (got[8].label_ids, got[8].created_at) == ([], dt.datetime(2025, 2, 1))
    S.delete_state(spark, name, spark.createDataFrame([(7,)], "pr_number int"))
    assert [r.pr_number for r in S.load_state(spark, name).collect()] == [8]


def test_delete_insert_within_a_partitioning_needs_no_shuffle_of_the_days(spark):
    from premiumlake.operators.spine import daily_activity

    day = dt.date
    columns = "user_id string, acquisition_date date, started_at date, churned_at date, monthly_premium decimal(18,2), product_group string"
    old = [("a", day(2021, 1, 5), day(2021, 1, 20), None, 31, "x"), ("b", day(2021, 2, 1), day(2021, 2, 1), day(2021, 4, 2), 5, "y"),
           ("b", day(2021, 2, 1), day(2021, 3, 1), day(2021, 3, 1), 7, "y"), (None, day(2021, 1, 1), day(2021, 1, 1), day(2021, 1, 3), 1, "x"),
           ("c", day(2021, 5, 2), day(2021, 5, 2), day(2021, 5, 1), 1, "x")]
    new = [("b", day(2021, 2, 1), day(2021, 2, 27), day(2021, 3, 4), 9, "y"), ("b", day(2021, 2, 1), day(2021, 2, 27), day(2021, 2, 28), 8, "y"),
           (None, day(2021, 1, 1), day(2021, 1, 2), day(2021, 1, 2), 2, "x"), ("n", day(2021, 6, 1), day(2021, 6, 1), day(2021, 6, 2), 3, "x")]
    old, new = (spark.createDataFrame(r, columns.replace("decimal(18,2)", "int")).withColumn("monthly_premium", F.col("monthly_premium").cast("decimal(18,2)")) for r in (old, new))
    plain = [daily_activity(p, day(2021, 7, 15)) for p in (old, new)]
    moved = [daily_activity(p, day(2021, 7, 15), by_month=True) for p in (old, new)]
    every = plain[0].columns
    assert moved[0].columns == every and moved[0].dtypes == plain[0].dtypes
    assert [rows(df, *every) for df in moved] == [rows(df, *every) for df in plain]
    out = H.delete_insert(*moved, ["user_id", "activity_date"], within=["user_id", "activity_month"])
    assert rows(out, *every) == rows(H.delete_insert(*plain, ["user_id", "activity_date"]), *every)
    text = out._jdf.queryExecution().executedPlan().toString()
    exchanges = [line for line in text.splitlines() if "Exchange" in line]
    assert exchanges and all("REPARTITION_BY_NUM" in line for line in exchanges), text
    assert "ShuffledHashJoin" in text and "SortMergeJoin" not in text


def test_delete_insert_within_keeps_rows_of_null_keys_and_compares_all_other_keys(spark):
    columns = "k string, d int, e int, part int, v int"
    target = spark.createDataFrame([("a", 1, 1, 0, 1), ("a", 1, 2, 0, 2), ("a", None, 1, 0, 3), (None, 1, 1, 0, 4), ("b", 1, 1, 0, 5)], columns)
    batch = spark.createDataFrame([("a", 1, 1, 0, 9), ("a", 1, 1, 0, 9), ("a", None, 1, 0, 8), (None, 1, 1, 0, 7)], columns)
    plain = H.delete_insert(target, batch, ["k", "d", "e"])
    assert rows(H.delete_insert(target, batch, ["k", "d", "e"], within=["k", "part"]), "v") == rows(plain, "v")
