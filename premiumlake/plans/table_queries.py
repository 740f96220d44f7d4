"""Registered queries that go through the table sinks: audited build, versioned refresh, keyed tables,
merged batches and CSV loads."""

from __future__ import annotations

import datetime as dt
from dataclasses import replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from premiumlake.operators import quality as Q
from premiumlake.plans import build as B
from premiumlake.plans import graph
from premiumlake.plans import oracle as O
from premiumlake.plans.inputs import Inputs
from premiumlake.plans.registry import register
from premiumlake.plans.scratch import remove_at_exit, scratch_database, scratch_location, scratch_path
from premiumlake.sources import fixtures, keyed, quarantine, tables, versions

AT = dt.datetime(2025, 1, 1)

# --- audited build ---------------------------------------------------------------------------

_GATES = {
    "silver_transactions": ("all_rows_clean", "NOT _is_clean", "warn"),
    "gold_fct_accounting_reconciliation": ("books_agree", "reconciliation_status <> 'MATCH'", "error"),
}

# model, its rows in the oracle, its tests; the feed is dirty on purpose, so silver's tests only warn
_AUDITED = [
    ("silver_transactions", "silver", [replace(check, severity="warn") for check in Q.silver_tests()]),
    ("gold_fct_monthly_premiums", "monthly", Q.monthly_tests()),
    ("gold_fct_accounting_reconciliation", "recon", Q.recon_tests()),
    ("gold_fct_monthly_churn_rate_by_party", "churn", Q.party_month_tests()),
    ("gold_fct_premium_concentration_hhi", "hhi_mart", Q.concentration_tests()),
    ("gold_fct_premium_mom_growth", "growth", Q.party_month_tests()),
]


def _report_sql() -> str:
    tests, published = [], []
    for model, cte, checks in _AUDITED:
        tests.append(f"SELECT '{model}' AS model, check_name AS test, severity, status, failures FROM ({O.suite_sql(cte, checks)})")
        if model in _GATES:
            name, failing, severity = _GATES[model]
            bad = "warn" if severity == "warn" else "fail"
            tests.append(
                f"SELECT '{model}', '{name}', '{severity}', CASE WHEN count(*) = 0 THEN 'pass' ELSE '{bad}' END, count(*) FROM {cte} WHERE {failing}"
            )
        published.append(
            f"SELECT '{model}' AS model, CASE WHEN (SELECT count(*) FROM tests WHERE model = '{model}' AND status = 'fail') > 0 "
            "THEN 'rejected' ELSE 'published' END AS status"
        )
    published += [f"SELECT '{model}', 'published'" for model in ("accounting_closing", "bronze_raw_transactions")]
    published.append(
        "SELECT 'open_items', CASE WHEN (SELECT count(*) FROM tests WHERE model = 'gold_fct_accounting_reconciliation' AND status = 'fail') > 0 "
        "THEN 'skipped' ELSE 'published' END"
    )
    union = "\nUNION ALL\n".join
    return (
        f", tests AS ({union(tests)}), models AS ({union(published)})\n"
        "SELECT model, 'test' AS step, test, severity, status, failures FROM tests\nUNION ALL\n"
        "SELECT model, 'publish', NULL, NULL, status, NULL FROM models"
    )


def _after_ctes(sql: str, *ctes: str) -> str:
    """A statement that goes on with CTEs of its own after the shared ones."""
    return O.with_ctes("", *ctes).rstrip() + sql


@register("build_report", _after_ctes(_report_sql(), *[cte for _, cte, _ in _AUDITED]))
def build_report(i: Inputs) -> DataFrame:
    """An audited build: silver warns, the reconciliation fails its gate, and what reads it is left
    out."""
    spark = i.spark
    prefix, folder = scratch_location(spark)
    B.make_databases(spark, prefix, folder)
    for layer in B.LAYERS:
        remove_at_exit(spark, prefix + layer)
    models, declared = [], {model: tuple(checks) for model, _, checks in _AUDITED}
    for model in B.premium_models(AT, i.as_of, prefix, int(spark.conf.get("spark.sql.shuffle.partitions"))):
        model = replace(model, tests=declared.get(model.name, model.tests))
        if model.name in _GATES:
            name, failing, severity = _GATES[model.name]
            model = replace(model, tests=(*model.tests, Q.expression(name, F.expr(failing), severity)))
        models.append(model)
    models.append(
        graph.Model("open_items", ("gold_fct_accounting_reconciliation",), lambda recon: recon.where("reconciliation_status <> 'MATCH'"),
                    table=f"{prefix}gold.open_items")
    )
    sources = {"raw_transactions": i.raw, "ledger": fixtures.accounting_closing(i.silver), "policies": i.policies}
    wanted = ["+open_items", *[model for model, _, _ in _AUDITED]]
    return graph.build(spark, models, sources, wanted)


# --- versioned refresh -----------------------------------------------------------------------

_BEFORE = "1996-01"


@register(
    "refresh_versions",
    O.with_ctes(
        "SELECT 'before' AS reader, party, count(*) AS months, CAST(sum(net_premium) AS DECIMAL(28,2)) AS net_premium, 2 AS kept\n"
        f"FROM monthly WHERE month < '{_BEFORE}' GROUP BY party\nUNION ALL\n"
        "SELECT 'after', party, count(*), CAST(sum(net_premium) AS DECIMAL(28,2)), 2 FROM monthly GROUP BY party",
        "monthly",
    ),
)
def refresh_versions(i: Inputs) -> DataFrame:
    """The monthly mart refreshed twice: a reader planned before the second refresh keeps its rows, a
    later one gets the new ones."""
    spark, name = i.spark, f"{scratch_database(i.spark)}.monthly"
    versions.refresh(spark, i.monthly.where(F.col("month") < _BEFORE), name)
    before = spark.table(name)
    versions.refresh(spark, i.monthly, name)
    kept = len(versions.versions(spark, name))
    sums = [F.count(F.lit(1)).alias("months"), F.sum("net_premium").cast("decimal(28,2)").alias("net_premium")]
    read = [df.groupBy("party").agg(*sums).select(F.lit(label).alias("reader"), "*") for label, df in (("before", before), ("after", spark.table(name)))]
    return read[0].unionByName(read[1]).withColumn("kept", F.lit(kept))


# --- keyed table -----------------------------------------------------------------------------

_CYCLE = O.with_ctes(
    "SELECT * FROM (SELECT coalesce(t.c_custkey, b.c_custkey) AS c_custkey, coalesce(t.c_name, b.c_name) AS c_name, "
    "coalesce(t.c_nationkey, b.c_nationkey) AS c_nationkey, "
    "CASE WHEN b.c_custkey IS NOT NULL THEN b.c_acctbal ELSE t.c_acctbal END AS c_acctbal, "
    "coalesce(t.c_mktsegment, b.c_mktsegment) AS c_mktsegment "
    "FROM customer t FULL OUTER JOIN customer_batch b ON t.c_custkey = b.c_custkey) merged "
    "WHERE NOT EXISTS (SELECT 1 FROM orders o WHERE o.o_orderstatus = 'P' AND o.o_orderpriority = '1-URGENT' AND o.o_custkey = merged.c_custkey)",
    "customer_batch",
)


@register("keyed_cycle", _CYCLE)
def keyed_cycle(i: Inputs) -> DataFrame:
    """Three batches on a keyed table: all customers inserted, some updated with new ones among them,
    those with an urgent order in progress deleted; then the full load."""
    spark, name, customer = i.spark, f"{scratch_database(i.spark)}.customers", i.table("customer")
    keyed.create(spark, name, customer.schema, ["c_custkey"])
    keyed.insert(spark, name, customer)
    keyed.upsert(spark, name, fixtures.customer_update_batch(customer), ["c_acctbal"])
    urgent = i.table("orders").where("o_orderstatus = 'P' AND o_orderpriority = '1-URGENT'")
    keyed.delete(spark, name, urgent.select(F.col("o_custkey").alias("c_custkey")))
    return keyed.read(spark, name)


_CONSTRAINTS = """
WITH finished AS (SELECT * FROM orders WHERE o_orderstatus = 'F'),
steps AS (
  SELECT 1 AS step, 'insert' AS write, 'accepted' AS outcome, NULL AS violation, 0 AS violations, (SELECT count(*) FROM finished) AS rows_after
  UNION ALL SELECT 2, 'insert', 'refused', 'key in the table already', (SELECT count(*) FROM finished), (SELECT count(*) FROM finished)
  UNION ALL SELECT 3, 'insert', 'refused', 'key repeated in the batch',
    (SELECT count(*) - count(DISTINCT o_custkey) FROM orders), (SELECT count(*) FROM finished)
  UNION ALL SELECT 4, 'upsert', 'refused', 'null in customer', (SELECT count(*) FROM orders WHERE o_orderstatus = 'P'), (SELECT count(*) FROM finished)
  UNION ALL SELECT 5, 'upsert', 'accepted', NULL, 0, (SELECT count(*) FROM orders)
)
SELECT step, write, outcome, violation, CAST(violations AS BIGINT) AS violations, CAST(rows_after AS BIGINT) AS rows_after,
  (SELECT count(*) FROM finished) AS by_default
FROM steps
"""


@register("keyed_constraints", _CONSTRAINTS)
def keyed_constraints(i: Inputs) -> DataFrame:
    """Five writes of orders to a keyed table, three of which its constraints refuse: (step, write, outcome,
    violation, violations, rows_after, by_default: rows whose state is the column's default)."""
    spark, name, orders = i.spark, f"{scratch_database(i.spark)}.orders", i.table("orders")
    schema = T.StructType(
        [T.StructField("number", T.LongType(), False), T.StructField("customer", T.LongType(), False), T.StructField("state", T.StringType())]
    )
    keyed.create(spark, name, schema, ["number"], defaults={"state": "'new'"})
    number, customer = F.col("o_orderkey").alias("number"), F.col("o_custkey").alias("customer")
    no_customer = F.when(F.col("o_orderstatus") != "P", F.col("o_custkey")).alias("customer")
    finished, state = orders.where("o_orderstatus = 'F'").select(number, customer), F.col("o_orderstatus").alias("state")
    writes = [
        ("insert", keyed.insert, finished),
        ("insert", keyed.insert, orders.select(number, customer, state)),
        ("insert", keyed.insert, orders.select(F.col("o_custkey").alias("number"), customer)),
        ("upsert", lambda *args: keyed.upsert(*args, ["state"]), orders.select(number, no_customer, state)),
        ("upsert", lambda *args: keyed.upsert(*args, ["customer"]), orders.select(number, customer, state)),
    ]
    rows = []
    for step, (label, write, batch) in enumerate(writes, 1):
        found = {None: 0}
        try:
            write(spark, name, batch)
        except keyed.ConstraintError as refused:
            found = refused.violations
        after = keyed.read(spark, name).agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("state") == "new").alias("d")).first()
        rows += [(step, label, "refused" if what else "accepted", what, n, after.n, after.d) for what, n in found.items()]
    return spark.createDataFrame(rows, "step int, write string, outcome string, violation string, violations long, rows_after long, by_default long")


# --- merged batches --------------------------------------------------------------------------

_MERGED = """
WITH first AS (
  SELECT o_orderkey, o_totalprice, NULL AS o_orderpriority, CASE WHEN o_orderstatus = 'P' THEN NULL ELSE year(o_orderdate) END AS y FROM orders
),
second AS (
  SELECT o_orderkey, o_totalprice + 1 AS o_totalprice, o_orderpriority,
    CASE WHEN o_orderstatus = 'P' THEN NULL ELSE year(o_orderdate) END AS y
  FROM orders WHERE (year(o_orderdate) = 1995 OR o_orderstatus = 'P') AND o_orderpriority = '1-URGENT'
)
SELECT o_orderkey, o_totalprice, o_orderpriority, CAST(y AS INT) AS y, CAST(2 AS BIGINT) AS batches, 1 AS skipped
FROM (SELECT * FROM first WHERE o_orderkey NOT IN (SELECT o_orderkey FROM second) UNION ALL SELECT * FROM second) merged
"""


@register("merge_partitions_table", _MERGED)
def merge_partitions_table(i: Inputs) -> DataFrame:
    """Orders by year, those in progress in the partition of NULL: a second batch brings a new column to
    two partitions, and the first batch, sent again, is skipped."""
    spark, name, orders = i.spark, f"{scratch_database(i.spark)}.orders", i.table("orders")
    year = F.when(F.col("o_orderstatus") != "P", F.year("o_orderdate")).alias("y")
    first = orders.select("o_orderkey", "o_totalprice", year)
    some = orders.where("(year(o_orderdate) = 1995 OR o_orderstatus = 'P') AND o_orderpriority = '1-URGENT'")
    second = some.select("o_orderkey", (F.col("o_totalprice") + 1).cast(orders.schema["o_totalprice"].dataType).alias("o_totalprice"), "o_orderpriority", year)
    applied = [tables.merge_partitions(spark, name, batch, ["o_orderkey"], "y", batch_id=mark) for mark, batch in (("a", first), ("b", second), ("a", first))]
    batches = spark.table(tables.ledger(name)).count()
    return spark.table(name).withColumn("batches", F.lit(batches).cast("long")).withColumn("skipped", F.lit(applied.count(False)))


# --- CSV loads -------------------------------------------------------------------------------

_QUARANTINE = O.with_ctes(
    """SELECT 'raw_transactions' AS source, CASE WHEN reason = '' THEN 'accepted' ELSE 'rejected' END AS outcome, reason,
  count(*) AS records, CASE WHEN reason = '' THEN CAST(sum(length(status) + CASE WHEN charged_party IS NULL THEN 6 ELSE 0 END) AS BIGINT) END AS status_chars,
  CAST(NULL AS DECIMAL(28,2)) AS figures
FROM (SELECT *, CASE WHEN premium_amount IS NULL THEN 'missing transaction_id' WHEN premium_amount IN ('n/a', '0.00') THEN 'fields' ELSE '' END AS reason FROM raw) r
GROUP BY reason
UNION ALL
SELECT 'accounting_closing', CASE WHEN reason = '' THEN 'accepted' ELSE 'rejected' END, reason, count(*), NULL,
  CASE WHEN reason = '' THEN CAST(sum(accounting_premium) AS DECIMAL(28,2)) END
FROM (SELECT *, CASE substring(month, 6, 2) WHEN '06' THEN 'bad accounting_premium' WHEN '07' THEN 'missing party' ELSE '' END AS reason FROM ledger) l
GROUP BY reason""",
    "raw", "ledger",
)


@register("csv_quarantine", _QUARANTINE)
def csv_quarantine(i: Inputs) -> DataFrame:
    """The raw feed and the ledger through CSV files with broken records: records by outcome and reason, the
    characters of all accepted states (quoted line breaks included) and the sum of the accepted figures."""
    spark, database = i.spark, scratch_database(i.spark)
    out = []
    for name, lines in (("raw_transactions", fixtures.raw_csv_lines(i.raw)), ("accounting_closing", fixtures.ledger_csv_lines(i.ledger))):
        folder = scratch_path(spark)
        lines.write.text(folder)
        got = quarantine.load(spark, name, folder, f"{database}.{name}", header=False)
        money = name == "accounting_closing"
        accepted = ~F.col(quarantine.VERDICT)
        out.append(
            got.counted(
                (F.lit(None).cast("long") if money else F.sum(F.when(accepted, F.length("status")))).alias("status_chars"),
                (F.sum(F.when(accepted, F.col("accounting_premium"))) if money else F.lit(None)).cast("decimal(28,2)").alias("figures"),
            ).select(F.lit(name).alias("source"), "*")
        )
    return out[0].unionByName(out[1])
