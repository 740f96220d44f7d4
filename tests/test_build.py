"""Layered build into per-layer databases, incremental re-run, snapshot history and the streaming
load of the daily mart."""

from __future__ import annotations

import datetime as dt
import os
import tempfile

from pyspark.sql import functions as F

from premiumlake import schemas
from premiumlake.operators.history import delete_insert
from premiumlake.operators.spine import daily_activity
from premiumlake.plans import build as B
from premiumlake.plans.inputs import Inputs
from premiumlake.sources import fixtures
from premiumlake.streaming.incremental import stream_activity
from tests.conftest import SF_SMALL

AT1, AT2 = dt.datetime(2025, 1, 1), dt.datetime(2025, 2, 1)


def test_build_all_then_incremental_rerun(spark):
    i = Inputs(spark, SF_SMALL)
    ledger = fixtures.accounting_closing(i.silver)
    src = B.Sources(i.raw, ledger, i.policies)
    written = B.build_all(spark, src, AT1, fixtures.AS_OF, prefix="b1_")
    assert len(written) == len(B.MODELS)
    t = lambda m: spark.table(B.table_name(m, "b1_"))
    assert t("gold_fct_monthly_premiums").count() == 301
    assert t("gold_fct_accounting_reconciliation").count() == 289
    assert t("gold_fct_customer_activity_daily").count() == 34532
    assert t("gold_fct_cohort_retention").count() == 827
    assert t("gold_fct_customer_ltv").count() == 147
    assert t("gold_fct_gwp_waterfall").count() == 252
    assert "_created_at" in t("gold_fct_monthly_premiums").columns
    assert B.models_tagged("finance") == ["gold_fct_monthly_premiums", "gold_fct_accounting_reconciliation"]
    # the customer marts read the bucketed intermediate without re-shuffling it on (user, product)
    from premiumlake.operators import customer_marts as C

    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        for mart in (C.premium_waterfall, C.cohort_retention):
            plan = mart(t("int_customer_months"))._jdf.queryExecution().executedPlan().toString()
            assert "Exchange hashpartitioning(user_id" not in plan, mart.__name__
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert t("int_customer_months").count() == 1294  # 108 new + 1,127 renewal + 59 reactivation
    snap_rows = t("snp_silver_transactions").count()

    # second run: re-cut policies (delete+insert keeps stale later days) and an unchanged feed
    recut = fixtures.policies_recut(i.policies, i.table("customer"))
    B.build_all(spark, B.Sources(i.raw, ledger, recut), AT2, fixtures.AS_OF, prefix="b1_",
                select=["gold_fct_customer_activity_daily", "snp_silver_transactions"])
    expected = delete_insert(i.activity, daily_activity(recut, fixtures.AS_OF), ["user_id", "activity_date"]).count()
    assert t("gold_fct_customer_activity_daily").count() == expected
    assert t("snp_silver_transactions").count() == snap_rows  # nothing changed: no new versions
    assert t("snp_silver_transactions").where(~F.col("is_current")).count() == 0
    assert B.current_snapshot(spark, "b1_").count() == snap_rows
    # rebuild only the models tagged finance, on top of the tables already there
    again = B.build_all(spark, src, AT2, fixtures.AS_OF, prefix="b1_", select=B.models_tagged("finance"))
    assert again == ["b1_gold.gold_fct_monthly_premiums", "b1_gold.gold_fct_accounting_reconciliation"]
    assert t("gold_fct_accounting_reconciliation").count() == 289


def test_stream_drives_incremental_load(spark):
    i = Inputs(spark, SF_SMALL)
    land = tempfile.mkdtemp(prefix="landing-")
    ckpt = tempfile.mkdtemp(prefix="stream-ckpt-")
    spark.sql("CREATE DATABASE IF NOT EXISTS s1_gold")
    table = "s1_gold.activity"
    i.policies.write.parquet(os.path.join(land, "batch1"))
    stream = spark.readStream.schema(schemas.POLICIES).option("recursiveFileLookup", "true").parquet(land)
    q = stream_activity(spark, stream, table, fixtures.AS_OF, checkpoint_location=ckpt)
    q.awaitTermination(300)
    spark.catalog.refreshTable(table)  # the micro-batch wrote through the stream's own session
    assert spark.table(table).count() == 34532

    recut = fixtures.policies_recut(i.policies, i.table("customer"))
    recut.write.parquet(os.path.join(land, "batch2"))
    q = stream_activity(spark, stream, table, fixtures.AS_OF, checkpoint_location=ckpt)
    q.awaitTermination(300)
    spark.catalog.refreshTable(table)
    expected = delete_insert(i.activity, daily_activity(recut, fixtures.AS_OF), ["user_id", "activity_date"]).count()
    assert spark.table(table).count() == expected


def test_csv_edge_round_trip(spark):
    """The raw feed written as CSV and read back through the declared source gives the same
    silver rows as the in-memory feed (all-string schema, header row, no inference)."""
    from premiumlake.operators.ingest import clean_transactions, ingest_raw
    from premiumlake.sources.catalog import read_source

    i = Inputs(spark, SF_SMALL)
    folder = os.path.join(tempfile.mkdtemp(prefix="csv-edge-"), "raw")
    i.raw.write.option("header", True).csv(folder)
    back = read_source(spark, "raw_transactions", folder)
    assert back.schema == schemas.RAW_TRANSACTIONS
    a = clean_transactions(ingest_raw(back)).drop("created_at_ts")
    b = i.silver.drop("created_at_ts")
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0

    ledger_dir = os.path.join(tempfile.mkdtemp(prefix="csv-ledger-"), "ledger")
    fixtures.accounting_closing(i.silver).write.option("header", True).csv(ledger_dir)
    ledger = read_source(spark, "accounting_closing", ledger_dir)
    assert dict(ledger.dtypes)["accounting_premium"] == "decimal(18,2)" and ledger.count() == 289


def test_bucketed_snapshot_join_needs_no_shuffle(spark):
    """With silver and the snapshot bucketed alike, the SCD2 run's key join and duplicate-key
    window read both tables without an exchange on transaction_id."""
    import re

    from premiumlake.operators.history import scd2_snapshot

    i = Inputs(spark, SF_SMALL)
    src = B.Sources(i.raw, fixtures.accounting_closing(i.silver), i.policies)
    B.build_all(spark, src, AT1, fixtures.AS_OF, prefix="bk_", buckets=4,
                select=["accounting_closing", "bronze_raw_transactions", "silver_transactions", "snp_silver_transactions"])
    silver = spark.table("bk_silver.silver_transactions").select(*B.SNAPSHOT_COLUMNS)
    history = spark.table("bk_snapshots.snp_silver_transactions")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # as for tables of cluster size
    spark.conf.set("spark.sql.adaptive.enabled", "false")  # inspect the static plan
    try:
        out = scd2_snapshot(history, silver, "transaction_id", ["status", "premium_amount"], AT2)
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert plan.count("SortMergeJoin") == 1 and "FullOuter" in plan
        assert not re.search(r"Exchange hashpartitioning\(transaction_id", plan)
        assert out.count() == history.count()  # unchanged feed: no new versions
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10485760")
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_merge_rewrites_only_touched_partitions(spark):
    from premiumlake.operators.history import delete_insert
    from premiumlake.sources.tables import merge_partitions

    i = Inputs(spark, SF_SMALL)
    spark.sql("CREATE DATABASE IF NOT EXISTS mp")
    name = "mp.activity"
    keys = ["user_id", "activity_date"]
    first = daily_activity(i.policies, fixtures.AS_OF)
    merge_partitions(spark, name, first, keys, "activity_month")
    location = spark.sql(f"DESCRIBE TABLE EXTENDED {name}").where("col_name = 'Location'").collect()[0].data_type
    root = location.replace("file:", "")

    def files():
        return {d: sorted(os.listdir(os.path.join(root, d))) for d in os.listdir(root) if d.startswith("activity_month=")}

    before = files()
    newcomer = fixtures.policies_recut(i.policies, i.table("customer")).where(F.col("user_id").startswith("NEW"))
    batch = daily_activity(newcomer, fixtures.AS_OF)  # 2001-11-25 .. 2001-12-31
    expected = sorted(tuple(r) for r in delete_insert(first, batch, keys).select(*spark.table(name).columns).collect())
    merge_partitions(spark, name, batch, keys, "activity_month")
    after = files()
    touched = {"activity_month=2001-11", "activity_month=2001-12"}
    assert {d for d in after if after[d] != before.get(d)} == touched
    assert sorted(tuple(r) for r in spark.table(name).collect()) == expected


def test_bucketed_write_has_one_file_per_bucket(spark):
    from premiumlake.sources.tables import publish

    spark.sql("CREATE DATABASE IF NOT EXISTS bw")
    df = spark.range(20000).selectExpr("cast(id as string) AS transaction_id", "id % 7 AS v").repartition(13)
    publish(spark, df, "bw.t", bucket_by=(4, ["transaction_id"]))
    location = spark.sql("DESCRIBE TABLE EXTENDED bw.t").where("col_name = 'Location'").collect()[0].data_type
    parts = [f for f in os.listdir(location.replace("file:", "")) if f.startswith("part-")]
    assert len(parts) == 4
    assert spark.table("bw.t").count() == 20000


def test_snapshot_runs_touch_only_open_and_new_partitions(spark):
    from premiumlake.operators.history import scd2_snapshot
    from premiumlake.operators.ingest import clean_transactions, ingest_raw

    i = Inputs(spark, SF_SMALL)
    spark.sql("CREATE DATABASE IF NOT EXISTS sn")
    name = "sn.snap"
    silver1 = clean_transactions(ingest_raw(i.raw, at=AT1), at=AT1)
    rows1 = spark.createDataFrame(silver1.select(*B.SNAPSHOT_COLUMNS).collect(), silver1.select(*B.SNAPSHOT_COLUMNS).schema)
    rows2 = fixtures.scd2_second_batch(rows1)
    rows2 = spark.createDataFrame(rows2.collect(), rows2.schema)
    checks = ["status", "premium_amount"]

    B.snapshot_run(spark, name, rows1, AT1, 4)
    B.snapshot_run(spark, name, rows2, AT2, 4)
    expected = scd2_snapshot(scd2_snapshot(None, rows1, "transaction_id", checks, AT1), rows2, "transaction_id", checks, AT2)
    cols = expected.columns

    def content():
        return sorted((tuple(r) for r in spark.table(name).select(*cols).collect()), key=repr)

    assert content() == sorted((tuple(r) for r in expected.collect()), key=repr)
    location = spark.sql(f"DESCRIBE TABLE EXTENDED {name}").where("col_name = 'Location'").collect()[0].data_type.replace("file:", "")
    closed_dir = os.path.join(location, "_closed_run=20250201000000")
    closed_files = sorted(os.listdir(closed_dir))
    assert closed_files and spark.table(name).where("_closed_run = '20250201000000'").count() > 0

    before = content()
    B.snapshot_run(spark, name, rows2, AT2, 4)  # a retried run: same input, same timestamp
    assert content() == before
    closed_files = sorted(os.listdir(closed_dir))  # a repeat writes its own run's partition again
    B.snapshot_run(spark, name, rows2, dt.datetime(2025, 3, 1), 4)  # nothing changed since
    assert content() == before and sorted(os.listdir(closed_dir)) == closed_files


def test_parquet_policy_source(spark):
    from premiumlake.sources.catalog import read_source

    i = Inputs(spark, SF_SMALL)
    folder = os.path.join(tempfile.mkdtemp(prefix="policies-"), "p")
    i.policies.write.parquet(folder)
    back = read_source(spark, "policies", folder)
    assert back.schema.simpleString() == schemas.POLICIES.simpleString()
    assert back.count() == 170 and back.where(F.col("churned_at").isNull()).count() == 8  # FIXTURES: 170 policies, 8 open


def _silver_rows(spark, rows):
    from premiumlake.plans.build import SNAPSHOT_COLUMNS
    from pyspark.sql import functions as F

    df = spark.createDataFrame(rows, "transaction_id string, status string, premium_amount decimal(18,2)")
    return df.select(*[c if c in df.columns else F.lit(None).cast("string").alias(c) for c in SNAPSHOT_COLUMNS])


def test_snapshot_rerun_and_empty_source_keep_history(spark):
    import datetime as dt
    from decimal import Decimal as D

    from premiumlake.plans.build import snapshot_run

    name = "snap_rerun"
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    t1, t2, t3 = (dt.datetime(2025, m, 1) for m in (1, 2, 3))
    state = lambda: sorted((r.transaction_id, r.status, r.valid_from.month, r.valid_to and r.valid_to.month) for r in spark.table(name).collect())
    snapshot_run(spark, name, _silver_rows(spark, [("a", "x", D(1)), ("b", "x", D(1))]), t1, 4)
    snapshot_run(spark, name, _silver_rows(spark, [("a", "y", D(1)), ("b", "x", D(1))]), t2, 4)
    assert state() == [("a", "x", 1, 2), ("a", "y", 2, None), ("b", "x", 1, None)]
    snapshot_run(spark, name, _silver_rows(spark, [("a", "z", D(1)), ("b", "y", D(1))]), t2, 4)  # corrected, same run
    assert state() == [("a", "x", 1, 2), ("a", "z", 2, None), ("b", "x", 1, 2), ("b", "y", 2, None)]
    snapshot_run(spark, name, _silver_rows(spark, []), t3, 4)
    assert state() == [("a", "x", 1, 2), ("a", "z", 2, 3), ("b", "x", 1, 2), ("b", "y", 2, 3)]


def test_snapshot_keeps_a_null_key(spark):
    import datetime as dt
    from decimal import Decimal as D

    from premiumlake.operators.history import scd2_snapshot

    rows = _silver_rows(spark, [("a", "x", D(1)), (None, "x", D(1))])
    first = scd2_snapshot(None, rows, "transaction_id", ["status"], dt.datetime(2025, 1, 1))
    assert scd2_snapshot(first, rows, "transaction_id", ["status"], dt.datetime(2025, 2, 1)).count() == 2


def test_merge_keeps_rows_of_the_null_partition(spark):
    from premiumlake.sources.tables import merge_partitions

    name = "merge_nulls"
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    frame = lambda rows: spark.createDataFrame(rows, "id int, v string, month string")
    merge_partitions(spark, name, frame([(1, "a", None), (2, "a", "2025-01"), (3, "a", "2025-02")]), ["id"], "month")
    merge_partitions(spark, name, frame([(4, "b", None), (2, "b", "2025-01")]), ["id"], "month")
    assert sorted((r.id, r.v) for r in spark.table(name).collect()) == [(1, "a"), (2, "b"), (3, "a"), (4, "b")]


def test_guard_refuses_jvm_calls_and_paths(spark):
    from premiumlake.operators import guarded_sql as G

    for sql in ("SELECT java_method('java.lang.System', 'getProperty', 'user.dir')", "SELECT * FROM text.`/etc/hostname`", "SELECT reflect('java.lang.Math', 'max', 1, 2)"):
        assert not G.run_select(spark, sql).ok
    whole = G.run_select(spark, "SELECT id FROM range(250)")
    assert (whole.columns, whole.row_count, whole.truncated) == (["id"], 250, False)
    cut = G.run_select(spark, "SELECT id FROM range(250)", limit=100)
    assert (cut.row_count, cut.truncated) == (100, True)


def test_filters_on_typed_keys(spark):
    from premiumlake.operators.reports import apply_filters

    df = spark.sql("SELECT date'2025-01-01' AS activity_date, 'x' AS party")
    assert apply_filters(df, ["activity_date"], {"activity_date": "foo"}).count() == 0
    assert apply_filters(df, ["activity_date"], {"activity_date": "2025-01-01"}).count() == 1
    assert apply_filters(df, ["party"], {"party": "y\n"}).count() == 1
