"""Model graph, write-audit-publish builds and versioned refreshes."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from premiumlake.operators import quality as Q
from premiumlake.plans import build as B
from premiumlake.plans import graph as G
from premiumlake.plans.inputs import Inputs
from premiumlake.plans.scratch import remove_at_exit, scratch_database, scratch_location
from premiumlake.sources import fixtures, versions
from tests.conftest import SF_SMALL


def named(name, *inputs, tags=()):
    return G.Model(name, inputs, lambda *frames: frames[0], tags=tags)


def names(models):
    return [m.name for m in models]


def test_order_follows_inputs_and_says_what_is_wrong():
    models = [named("c", "b", "a"), named("b", "a"), named("a", "feed"), named("z", "feed")]
    assert names(G.ordered(models, ["feed"])) == ["a", "b", "c", "z"]
    with pytest.raises(ValueError, match="c reads what nothing makes: gone"):
        G.ordered([named("c", "gone")])
    with pytest.raises(ValueError, match="declared twice"):
        G.ordered([named("a", "feed"), named("a", "feed")], ["feed"])
    with pytest.raises(G.CycleError, match="a -> c -> b -> a"):
        G.ordered([named("a", "c"), named("b", "a"), named("c", "b")])


def test_selection_by_name_tag_and_direction():
    models = [named("a", "feed", tags=("x",)), named("b", "a"), named("c", "b", tags=("x",)), named("d", "a")]
    assert G.selected(None, models) == {"a", "b", "c", "d"}
    assert G.selected(["+c"], models) == {"a", "b", "c"}
    assert G.selected(["b+", "d"], models) == {"b", "c", "d"}
    assert G.selected(["tag:x"], models) == {"a", "c"}
    assert G.selected(["+d+"], models) == {"a", "d"}
    with pytest.raises(ValueError, match="nothing is selected"):
        G.selected(["tag:none"], models)


def test_a_failing_model_keeps_its_old_table_and_stops_its_dependents(spark):
    db = scratch_database(spark)
    rows = spark.range(10).withColumn("v", F.col("id") * 2)

    def models(limit):
        test = Q.expression("small", F.col("v") > limit)
        warn = Q.expression("even_smaller", F.col("v") > 1, "warn")
        return [
            G.Model("a", ("feed",), lambda feed: feed, (test, warn), table=f"{db}.a"),
            G.Model("b", ("a",), lambda a: a.groupBy().count(), table=f"{db}.b"),
            G.Model("c", ("b",), lambda b: b, table=f"{db}.c"),
            G.Model("other", ("feed",), lambda feed: feed.where("id < 3"), table=f"{db}.other"),
            G.Model("broken", ("feed",), lambda feed: feed.select("nothing"), table=f"{db}.broken"),
        ]

    def report(df):
        return [(r.model, r.step, r.status, r.failures) for r in df.where("model <> 'broken'").collect()]

    first = report(G.build(spark, models(100), {"feed": rows}))
    assert first == [
        ("a", "test", "pass", 0), ("a", "test", "warn", 9), ("a", "publish", "published", None), ("b", "publish", "published", None),
        ("c", "publish", "published", None), ("other", "publish", "published", None),
    ]
    more = rows.unionByName(rows.select((F.col("id") + 100).alias("id"), (F.col("v") + 100).alias("v")))
    second = G.build(spark, models(100), {"feed": more})
    assert report(second) == [
        ("a", "test", "fail", 9), ("a", "test", "warn", 19), ("a", "publish", "rejected", None), ("b", "publish", "skipped", None),
        ("c", "publish", "skipped", None), ("other", "publish", "published", None),
    ]
    assert [r.status for r in second.where("model = 'broken'").collect()] == ["failed"]
    assert spark.table(f"{db}.a").count() == 10 and spark.table(f"{db}.b").first()[0] == 10
    assert len(versions.versions(spark, f"{db}.a")) == 1 and len(versions.versions(spark, f"{db}.other")) == 2
    assert not spark.catalog.tableExists(f"{db}.broken")


def test_audited_build_of_the_premium_models(spark):
    i = Inputs(spark, SF_SMALL)
    clean = i.raw.where("status IN ('processed', 'refunded', 'failed') AND charged_party IS NOT NULL")
    prefix, folder = scratch_location(spark)
    for layer in B.LAYERS:
        remove_at_exit(spark, prefix + layer)
    sources = B.Sources(clean, fixtures.accounting_closing(i.silver), i.policies)
    at = dt.datetime(2025, 1, 1)
    report = B.build_audited(spark, sources, at, fixtures.AS_OF, prefix, select=["+gold_fct_gwp_waterfall", "gold_fct_cohort_retention"], location=folder)
    status = {r.model: r.status for r in report.where("step = 'publish'").collect()}
    wanted = ["gold_fct_customer_activity_daily", "int_customer_months", "gold_fct_cohort_retention", "gold_fct_gwp_waterfall"]
    assert status == dict.fromkeys(wanted, "published") | {"gold_fct_cohort_retention": "rejected"}  # its keys hold NULLs here
    assert spark.table(B.table_name("gold_fct_gwp_waterfall", prefix)).count() == 252
    assert spark.table(B.table_name("gold_fct_customer_activity_daily", prefix)).count() == 34532
    again = B.build_audited(spark, sources, at, fixtures.AS_OF, prefix, select=["gold_fct_customer_activity_daily"], location=folder)
    assert again.where("status IN ('fail', 'error')").count() == 0
    assert spark.table(B.table_name("gold_fct_customer_activity_daily", prefix)).count() == 34532


def test_refresh_swaps_versions(spark):
    name = f"{scratch_database(spark)}.t"
    versions.refresh(spark, spark.range(3), name)
    reader = spark.table(name)
    versions.refresh(spark, spark.table(name).select(F.col("id").cast("string").alias("key")), name)  # reads itself, new schema
    assert reader.count() == 3 and reader.columns == ["id"]
    assert spark.table(name).columns == ["key"] and versions.current(spark, name) == versions.versions(spark, name)[-1]
    with pytest.raises(Exception, match="broken row"):
        versions.refresh(spark, spark.range(5).select(F.when(F.col("id") == 4, F.raise_error(F.lit("broken row"))).alias("x")), name)
    assert len(versions.versions(spark, name)) == 2 and spark.table(name).columns == ["key"]
    versions.rollback(spark, name)
    assert spark.table(name).columns == ["id"]
    with pytest.raises(ValueError, match="no version before"):
        versions.rollback(spark, name)
    for _ in range(3):
        versions.refresh(spark, spark.range(2), name)
    assert len(versions.versions(spark, name)) == 2


def test_refresh_keeps_buckets_and_takes_over_a_plain_table(spark):
    db = scratch_database(spark)
    spark.range(4).write.saveAsTable(f"{db}.plain")
    versions.refresh(spark, spark.range(9), f"{db}.plain", bucket_by=(4, ["id"]))
    assert spark.table(f"{db}.plain").count() == 9 and len(versions.versions(spark, f"{db}.plain")) == 2
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        t = spark.table(f"{db}.plain")
        plan = t.groupBy("id").count()._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert "Exchange" not in plan
