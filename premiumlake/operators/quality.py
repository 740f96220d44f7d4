"""Data-quality checks (M17–M21), the three mart audit suites (M22–M24) and table profiling (M25).

Plan shape: every row-level counter of a suite (NULL counts, row-level business rules, row
count, date range) folds into ONE global aggregate — one scan, partial aggregation on every task,
a single-row final stage — unpivoted into report rows with ``inline`` in the same projection.
Checks that need grouping (duplicate keys, distinct offending values, per-group summaries) add
one aggregate each, with map-side combining, so a hot value is collapsed on every task before
the shuffle. Nothing is collected: reports are DataFrames.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field
from decimal import Decimal

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from premiumlake import reference_values as rv
from premiumlake.functions.exact import round_money, round_ratio

REPORT_SCHEMA = "check_name string, kind string, column_names string, severity string, failures bigint, status string, message string"


@dataclass(frozen=True)
class Check:
    """A declared test. ``failures`` counts what the equivalent dbt test returns: NULL rows for
    not_null, distinct offending values for accepted_values, duplicated values (NULLs excluded)
    for unique, duplicated combinations for unique_combination, failing rows for expression."""

    name: str
    kind: str
    columns: tuple[str, ...]
    severity: str = "error"
    values: tuple = ()
    failing: Column | None = field(default=None, compare=False)


def not_null(*columns: str, severity: str = "error") -> list[Check]:
    return [Check(f"not_null_{c}", "not_null", (c,), severity) for c in columns]


def unique(column: str, severity: str = "error") -> Check:
    return Check(f"unique_{column}", "unique", (column,), severity)


def unique_combination(*columns: str, severity: str = "error") -> Check:
    return Check("unique_combination_of_" + "__".join(columns), "unique_combination", tuple(columns), severity)


def accepted_values(column: str, values, severity: str = "error") -> Check:
    return Check(f"accepted_values_{column}", "accepted_values", (column,), severity, tuple(values))


def expression(name: str, failing: Column, severity: str = "error") -> Check:
    return Check(name, "expression", (), severity, failing=failing)


def _status(failures: Column, severity: str) -> Column:
    return F.when(failures == 0, F.lit("pass")).otherwise(F.lit("warn" if severity == "warn" else "fail"))


def _row(check: Check, failures: Column, message: Column | None = None) -> Column:
    return F.struct(
        F.lit(check.name).alias("check_name"),
        F.lit(check.kind).alias("kind"),
        F.lit(",".join(check.columns)).alias("column_names"),
        F.lit(check.severity).alias("severity"),
        failures.cast("long").alias("failures"),
        _status(failures, check.severity).alias("status"),
        (message if message is not None else F.lit(None).cast("string")).alias("message"),
    )


def _bq(c: str) -> Column:
    return F.col("`" + c.replace("`", "``") + "`")


def _key(df: DataFrame, columns: tuple[str, ...]) -> Column:
    """The values of ``columns`` as strings that differ wherever the values do."""
    kinds = dict(df.dtypes)
    return F.array(*[(F.hex(_bq(c)) if kinds[c] == "binary" else _bq(c).cast("string")) for c in columns])


def _finding(df: DataFrame, check: Check) -> tuple[Column, Column]:
    """(when a row counts for a check, the key under which it counts)."""
    nothing = F.array().cast("array<string>")
    if check.kind == "not_null":
        return _bq(check.columns[0]).isNull(), nothing
    if check.kind == "expression":
        return F.coalesce(check.failing, F.lit(False)), nothing
    if check.kind == "accepted_values":
        return F.coalesce(~_bq(check.columns[0]).isin(*check.values), F.lit(False)), _key(df, check.columns)
    if check.kind == "unique":
        return _bq(check.columns[0]).isNotNull(), _key(df, check.columns)
    if check.kind == "unique_combination":
        return F.lit(True), _key(df, check.columns)
    raise ValueError(f"unknown check kind {check.kind!r}")


#: Types whose values are grouped as they are; others by their strings, as ``_key`` has them.
_PLAIN = {"string", "date", "boolean", "tinyint", "smallint", "int", "bigint"}


def _day_column(df: DataFrame, checks: list[Check]) -> str | None:
    """The date column of the one combination of a suite that otherwise counts rows only."""
    kinds = dict(df.dtypes)
    combos = [c for c in checks if c.kind == "unique_combination"]
    if len(combos) != 1 or not {c.kind for c in checks} <= {"not_null", "expression", "unique_combination"}:
        return None
    return next((c for c in combos[0].columns if kinds[c] == "date"), None)


def _month_figures(df: DataFrame, checks: list[Check], day: str) -> DataFrame:
    """One row of failures c0, c1, ... of such a suite, from one aggregate by month and the other
    columns of the combination: the rows that each check counts, and how often each day occurs.

    A month's days are 32 counters (0: NULL), two in a long of 31 bits each, so that a daily table
    sends a row a month to the shuffle and not one a day, and copies of a day are combined on every
    task. The report's one row of sums follows."""
    combo = next(c for c in checks if c.kind == "unique_combination")
    kinds = dict(df.dtypes)
    other = [c for c in combo.columns if c != day]
    keys = {f"_k{n}": _bq(c) if kinds[c] in _PLAIN else _key(df, (c,))[0] for n, c in enumerate(other)} | {"_month": F.trunc(_bq(day), "MM")}
    slot = F.coalesce(F.dayofmonth(_bq(day)), F.lit(0))
    failing = {f"_c{i}": _finding(df, c)[0] for i, c in enumerate(checks) if c is not combo}
    rows = df.select(
        *[c.alias(n) for n, c in (keys | failing).items()],
        F.shiftright(slot, 1).alias("_pair"),
        F.when(slot % 2 == 0, F.lit(1)).otherwise(F.lit(1 << 31)).cast("long").alias("_one"),
    )
    pairs = [F.sum(F.when(F.col("_pair") == n, F.col("_one")).otherwise(F.lit(0).cast("long"))).alias(f"_p{n}") for n in range(16)]
    months = rows.groupBy(*keys).agg(*[F.count_if(n).alias(n) for n in failing], *pairs)
    often = None
    for n in range(16):
        for times in (F.col(f"_p{n}").bitwiseAND(F.lit((1 << 31) - 1)), F.shiftright(f"_p{n}", 31)):
            twice = (times > 1).cast("int")
            often = twice if often is None else often + twice
    return months.agg(*[F.coalesce(F.sum(often if c is combo else F.col(f"_c{i}")), F.lit(0)).alias(f"c{i}") for i, c in enumerate(checks)])


def run_suite(df: DataFrame, checks: list[Check]) -> DataFrame:
    """Run declared checks; one report row per check, all of them over one scan of ``df``.

    Every row gives the (check, key) pairs that it counts for: nothing for a check that it passes,
    its key for uniqueness, the value for a value that is not accepted. Pairs are counted once for
    all checks, combined on every task before the shuffle, and one row of sums gives the report.
    A suite of row counts and one combination with a date is counted by month (``_month_figures``).

    Checks are isolated: one that does not fit the table (a column that it lacks, an expression that
    cannot be analysed) reports status ``error`` with a message, and the other checks still run.
    """
    spark = df.sparkSession
    present = set(df.columns)
    sound: list[Check] = []
    broken: list[tuple[Check, str]] = []
    emitted: list[Column] = []
    for chk in checks:
        missing = [c for c in chk.columns if c not in present]
        if missing:
            broken.append((chk, "missing column(s): " + ", ".join(missing)))
            continue
        try:
            counts, key = _finding(df, chk)
            df.select(counts, key).schema  # analysed, not run
        except (AnalysisException, ValueError) as why:
            broken.append((chk, str(why).split("\n")[0][:300]))
            continue
        emitted.append(F.when(counts, F.struct(F.lit(len(sound)).alias("check"), key.alias("key"))))
        sound.append(chk)
    parts: list[DataFrame] = []
    day = _day_column(df, sound)
    if day is not None:
        parts.append(_month_figures(df, sound, day).select(F.inline(F.array(*[_row(chk, F.col(f"c{i}")) for i, chk in enumerate(sound)]))))
    elif sound:
        pairs = df.select(F.explode(F.filter(F.array(*emitted), lambda x: x.isNotNull())).alias("p"))
        found = pairs.groupBy("p.check", "p.key").agg(F.count(F.lit(1)).alias("n"))
        sums = []
        for i, chk in enumerate(sound):
            own = F.col("check") == i
            if chk.kind in ("unique", "unique_combination"):
                total = F.count_if(own & (F.col("n") > 1))
            elif chk.kind == "accepted_values":
                total = F.count_if(own)
            else:
                total = F.coalesce(F.sum(F.when(own, F.col("n"))), F.lit(0))
            sums.append(total.alias(f"c{i}"))
        parts.append(found.agg(*sums).select(F.inline(F.array(*[_row(chk, F.col(f"c{i}")) for i, chk in enumerate(sound)]))))
    if broken:
        parts.append(
            spark.createDataFrame(
                [(c.name, c.kind, ",".join(c.columns), c.severity, None, "error", msg) for c, msg in broken],
                REPORT_SCHEMA,
            )
        )
    if not parts:
        return spark.createDataFrame([], REPORT_SCHEMA)
    return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])


# --- declared tests of the reference's tables -----------------------------------------------

def raw_transaction_tests() -> list[Check]:
    return [
        *not_null("transaction_id", "created_at", "premium_amount", "premium_currency", "charged_party", "status"),
        accepted_values("premium_currency", rv.CURRENCIES),
        accepted_values("charged_party", rv.PARTIES),
        accepted_values("status", rv.RAW_STATUSES),
    ]


def silver_tests() -> list[Check]:
    return [
        *not_null("transaction_id"),
        unique("transaction_id", severity="warn"),
        *not_null("created_at_ts", severity="warn"),
        *not_null("party"),
        accepted_values("party", rv.PARTIES),
        *not_null("status"),
        accepted_values("status", rv.SILVER_STATUSES),
    ]


def monthly_tests() -> list[Check]:
    return [
        *not_null("party"),
        accepted_values("party", rv.PARTIES),
        *not_null("month", "premium", "written_premium", "refunded_premium", "net_premium", "earned_premium"),
        unique_combination("party", "month"),
    ]


def recon_tests() -> list[Check]:
    return [
        *not_null("party", "month", "accounting_premium", "finance_premium"),
        accepted_values("reconciliation_status", rv.RECON_STATUSES),
        unique_combination("party", "month"),
    ]


def activity_tests() -> list[Check]:
    return [
        *not_null("activity_date", "user_id", "product_group", "daily_premium"),
        unique_combination("user_id", "activity_date"),
    ]


def cohort_tests() -> list[Check]:
    return [
        *not_null("cohort_month", "product_group", "months_since_acquisition", "cohort_size", "active_customers", "retention_rate"),
        unique_combination("cohort_month", "product_group", "months_since_acquisition"),
    ]


def ltv_tests() -> list[Check]:
    return [
        *not_null("user_id", "product_group"),
        accepted_values("ltv_bucket", rv.LTV_BUCKETS),
        unique_combination("user_id", "product_group"),
    ]


def waterfall_tests() -> list[Check]:
    return [*not_null("party", "month"), unique_combination("party", "month")]


def party_month_tests() -> list[Check]:
    """Churn and growth marts: not-null keys, unique grain."""
    return [*not_null("party", "month"), unique_combination("party", "month")]


def concentration_tests() -> list[Check]:
    return [
        *not_null("party", "month", "net_premium", "total_net_premium", "market_share_pct", "hhi_score", "concentration_level"),
        accepted_values("concentration_level", rv.CONCENTRATION_LEVELS),
    ]


# --- audit suites of the three main marts ------------------------------------------------------

def _dup_groups(df: DataFrame, keys: list[str]) -> DataFrame:
    return df.groupBy(*keys).count().where(F.col("count") > 1).agg(F.count(F.lit(1)).alias("duplicate_grain_rows"))


def _monthly_checks(df: DataFrame, parties=rv.PARTIES, tolerance: str = rv.NET_IDENTITY_TOLERANCE) -> dict[str, Callable[[], DataFrame]]:
    """The monthly mart's named audit queries (each a DataFrame)."""
    nulls = ["party", "month", "premium", "written_premium", "net_premium", "earned_premium"]
    return {
        "row_count": lambda: df.agg(F.count(F.lit(1)).alias("total_rows")),
        "null_check": lambda: df.agg(*[F.count_if(F.col(c).isNull()).alias(f"null_{c}") for c in nulls]),
        "uniqueness_check": lambda: _dup_groups(df, ["party", "month"]),
        "invalid_party_values": lambda: df.where(~F.col("party").isin(*parties)).groupBy("party").agg(
            F.count(F.lit(1)).alias("row_count")
        ),
        "net_premium_sanity": lambda: df.agg(
            F.count_if(
                F.abs(F.col("net_premium") - (F.col("written_premium") - F.col("refunded_premium"))) > F.lit(Decimal(tolerance))
            ).alias("rows_where_net_ne_written_minus_refunded")
        ),
        "summary_by_party": lambda: df.groupBy("party")
        .agg(
            F.count(F.lit(1)).alias("months"),
            F.min("month").alias("earliest_month"),
            F.max("month").alias("latest_month"),
            round_money(F.sum("written_premium")).alias("total_written_eur"),
            round_money(F.sum("refunded_premium")).alias("total_refunded_eur"),
            round_money(F.sum("net_premium")).alias("total_net_eur"),
            F.sum("transaction_count").cast("long").alias("total_transactions"),
        )
        .orderBy(F.col("total_written_eur").desc(), F.col("party")),
    }


def _recon_checks(df: DataFrame, statuses=rv.RECON_STATUSES, top_n: int = rv.TOP_DISCREPANCIES) -> dict[str, Callable[[], DataFrame]]:
    nulls = ["party", "month", "accounting_premium", "finance_premium"]
    null_cols = [F.count_if(F.col(c).isNull()).alias(f"null_{c}") for c in nulls]
    null_cols.append(F.count_if(F.col("reconciliation_status").isNull()).alias("null_status"))
    return {
        "row_count": lambda: df.agg(F.count(F.lit(1)).alias("total_rows")),
        "null_check": lambda: df.agg(*null_cols),
        "uniqueness_check": lambda: _dup_groups(df, ["party", "month"]),
        "invalid_status_values": lambda: df.where(~F.col("reconciliation_status").isin(*statuses))
        .groupBy("reconciliation_status")
        .agg(F.count(F.lit(1)).alias("row_count")),
        "status_distribution": lambda: status_distribution(df),
        "top_discrepancies": lambda: top_discrepancies(df, top_n),
    }


def status_distribution(df: DataFrame) -> DataFrame:
    """Per status: occurrences, mean and max absolute delta (2 places), mean delta % (4 places).
    Means are one exact division of the sum by the count."""
    abs_delta = F.abs(F.col("delta"))
    return (
        df.groupBy("reconciliation_status")
        .agg(
            F.count(F.lit(1)).alias("occurrences"),
            F.sum(abs_delta).alias("_sum_abs"),
            F.max(abs_delta).alias("_max_abs"),
            F.sum("delta_pct").alias("_sum_pct"),
            F.count("delta_pct").alias("_n_pct"),
        )
        .select(
            "reconciliation_status",
            "occurrences",
            round_ratio(F.col("_sum_abs"), F.col("occurrences"), 2).alias("avg_abs_delta_eur"),
            round_money(F.col("_max_abs")).alias("max_abs_delta_eur"),
            round_ratio(F.col("_sum_pct"), F.col("_n_pct"), 4).alias("avg_delta_pct"),
        )
        .orderBy(F.col("occurrences").desc(), F.col("reconciliation_status"))
    )


def top_discrepancies(df: DataFrame, n: int = rv.TOP_DISCREPANCIES) -> DataFrame:
    """The n largest absolute deltas (a top-k: Spark keeps n rows per task, then merges);
    ties broken by party and month so the result is deterministic."""
    return df.select(
        "party", "month", "finance_premium", "accounting_premium", "delta", "delta_pct", "reconciliation_status"
    ).orderBy(F.abs(F.col("delta")).desc(), F.col("party"), F.col("month")).limit(n)


def _activity_checks(df: DataFrame) -> dict[str, Callable[[], DataFrame]]:
    nulls = ["user_id", "activity_date", "product_group", "daily_premium"]
    return {
        "row_count": lambda: df.agg(F.count(F.lit(1)).alias("total_rows")),
        "null_check": lambda: df.agg(*[F.count_if(F.col(c).isNull()).alias(f"null_{c}") for c in nulls]),
        "uniqueness_check": lambda: _dup_groups(df, ["user_id", "activity_date"]),
        "date_range": lambda: date_range(df),
        "customer_summary": lambda: customer_summary(df),
        "product_group_breakdown": lambda: product_group_breakdown(df),
    }


def date_range(df: DataFrame) -> DataFrame:
    return df.agg(
        F.min("activity_date").alias("earliest"),
        F.max("activity_date").alias("latest"),
        F.count_distinct("activity_date").alias("distinct_dates"),
    )


def customer_summary(df: DataFrame) -> DataFrame:
    return (
        df.groupBy("user_id", "product_group")
        .agg(
            F.min("activity_date").alias("first_active"),
            F.max("activity_date").alias("last_active"),
            F.count(F.lit(1)).alias("active_days"),
            round_money(F.sum("daily_premium")).alias("total_earned_eur"),
            F.when(F.max("churned_at").isNotNull(), F.lit("churned")).otherwise(F.lit("active")).alias("status"),
        )
        .orderBy(F.col("total_earned_eur").desc(), "user_id", "product_group")
    )


def product_group_breakdown(df: DataFrame) -> DataFrame:
    return (
        df.groupBy("product_group")
        .agg(
            F.countDistinct("user_id").alias("customers"),
            F.sum("monthly_premium").alias("_sum_mp"),
            F.count("monthly_premium").alias("_n_mp"),
            F.count_if(F.col("churned_at").isNotNull()).alias("churned_user_days"),
        )
        .select(
            "product_group",
            "customers",
            round_ratio(F.col("_sum_mp"), F.col("_n_mp"), 2).alias("avg_monthly_premium_eur"),
            "churned_user_days",
        )
        .orderBy(F.col("customers").desc(), "product_group")
    )


_CHECKS = {
    "gold_fct_monthly_premiums": _monthly_checks,
    "gold_fct_accounting_reconciliation": _recon_checks,
    "gold_fct_customer_activity_daily": _activity_checks,
}


def _suite(table: str):
    def suite(df: DataFrame, **options) -> dict[str, DataFrame]:
        return {name: build() for name, build in _CHECKS[table](df, **options).items()}

    return suite


SUITES = {table: _suite(table) for table in _CHECKS}
suite_monthly, suite_recon, suite_activity = SUITES.values()

_INFORMATIONAL = (
    "status_distribution",
    "summary_by_party",
    "customer_summary",
    "top_discrepancies",
    "date_range",
    "product_group_breakdown",
)


def resolve_table(name: str | None) -> str:
    """Audit table from a loose name: first alias contained in the name wins; default monthly."""
    if not name:
        return rv.DEFAULT_AUDIT_TABLE
    for alias, table in rv.AUDIT_TABLE_ALIASES:
        if alias in name:
            return table
    return name


# Global counters of each suite, computed in ONE aggregate per audit (check name, metric
# expression, pass test on the metric); grouped checks come from the suite's named queries.
def _global_checks(table: str) -> list[tuple[str, Column, object]]:
    def nulls(cols):
        return sum((F.count_if(F.col(c).isNull()) for c in cols), F.lit(0))

    rows = F.count(F.lit(1))
    if table == "gold_fct_monthly_premiums":
        net_gap = F.abs(F.col("net_premium") - (F.col("written_premium") - F.col("refunded_premium")))
        return [
            ("row_count", rows, None),
            ("null_check", nulls(["party", "month", "premium", "written_premium", "net_premium", "earned_premium"]), 0),
            ("net_premium_sanity", F.count_if(net_gap > F.lit(Decimal(rv.NET_IDENTITY_TOLERANCE))), 0),
        ]
    if table == "gold_fct_accounting_reconciliation":
        return [
            ("row_count", rows, None),
            ("null_check", nulls(["party", "month", "accounting_premium", "finance_premium", "reconciliation_status"]), 0),
        ]
    return [
        ("row_count", rows, None),
        ("null_check", nulls(["user_id", "activity_date", "product_group", "daily_premium"]), 0),
        ("date_range", F.count_distinct("activity_date"), None),
    ]


def _shared_metrics(table: str, df: DataFrame) -> DataFrame | None:
    """Row counts of informational per-group summaries that one aggregate can provide."""
    if table != "gold_fct_customer_activity_daily":
        return None
    per_customer = df.groupBy("user_id", "product_group").agg(F.count(F.lit(1)).alias("_n"))
    counts = per_customer.agg(
        F.count(F.lit(1)).alias("customer_summary"),
        F.count_distinct("product_group").alias("_pg"),
        F.max(F.when(F.col("product_group").isNull(), 1).otherwise(0)).alias("_pg_null"),
    )
    rows = [
        F.struct(F.lit("customer_summary").alias("check_name"), F.lit(True).alias("passed"), F.col("customer_summary").alias("metric")),
        F.struct(
            F.lit("product_group_breakdown").alias("check_name"),
            F.lit(True).alias("passed"),
            (F.col("_pg") + F.coalesce(F.col("_pg_null"), F.lit(0))).cast("long").alias("metric"),
        ),
    ]
    return counts.select(F.inline(F.array(*rows)))


def audit(df: DataFrame, table: str) -> DataFrame:
    """Pass/fail report of a mart's suite: one row per check (check, passed, metric).

    Row count and summaries are informational and always pass; a null check fails when any
    count is above 0; a uniqueness or sanity check fails on a non-zero count; an invalid-values
    check fails when it returns any row. Unknown tables raise (the reference returned a payload
    its own parser could not read). All row-level counters share one scan; each grouped check
    (duplicates, invalid values, summaries) adds one aggregate. A check whose columns the table lacks
    fails with a NULL metric, and the others run.
    """
    resolved = resolve_table(table)
    if resolved not in SUITES:
        raise ValueError(f"no audit suite for table {table!r}")
    counters = _global_checks(resolved)
    broken = [name for name, expr, _ in counters if not _analyses(lambda expr=expr: df.agg(expr))]
    counters = [c for c in counters if c[0] not in broken]
    one_pass = df.agg(*[expr.alias(f"g{i}") for i, (_, expr, _) in enumerate(counters)])
    rows = [
        F.struct(
            F.lit(name).alias("check_name"),
            (F.lit(True) if ok is None else (F.col(f"g{i}") == ok)).alias("passed"),
            F.col(f"g{i}").cast("long").alias("metric"),
        )
        for i, (name, _, ok) in enumerate(counters)
    ]
    parts = [one_pass.select(F.inline(F.array(*rows)))]
    done = {"row_count", "null_check", *(name for name, _, _ in counters), *broken}
    shared = _analyses(lambda: _shared_metrics(resolved, df))
    if shared is not None:
        parts.append(shared)
        done |= {"customer_summary", "product_group_breakdown"}
    for name, build in _CHECKS[resolved](df).items():
        if name in done:
            continue
        res = _analyses(build)
        if res is None:
            broken.append(name)
            continue
        if name == "uniqueness_check":
            row = res.select((F.col("duplicate_grain_rows") == 0).alias("passed"), F.col("duplicate_grain_rows").alias("metric"))
        elif name.startswith("invalid"):
            n = res.agg(F.count(F.lit(1)).alias("n"))
            row = n.select((F.col("n") == 0).alias("passed"), F.col("n").alias("metric"))
        elif name in _INFORMATIONAL:
            n = res.agg(F.count(F.lit(1)).alias("n"))
            row = n.select(F.lit(True).alias("passed"), F.col("n").alias("metric"))
        else:
            continue
        parts.append(row.select(F.lit(name).alias("check_name"), "passed", F.col("metric").cast("long").alias("metric")))
    if broken:
        failed = [F.struct(F.lit(n).alias("check_name"), F.lit(False).alias("passed"), F.lit(None).cast("long").alias("metric")) for n in broken]
        parts.append(one_pass.select(F.inline(F.array(*failed))))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.select(F.lit(resolved).alias("table_name"), "*")


def _analyses(build: Callable[[], DataFrame | None]) -> DataFrame | None:
    """The DataFrame, or None if a column it needs is missing (analysis only, nothing runs)."""
    try:
        return build()
    except AnalysisException:
        return None


def audit_verdict(report: DataFrame) -> DataFrame:
    """One row per audited table of an ``audit`` report: success, and how many checks passed and
    failed."""
    return report.groupBy("table_name").agg(
        F.bool_and("passed").alias("success"),
        F.count_if(F.col("passed")).alias("passed"),
        F.count_if(~F.col("passed")).alias("failed"),
    )


# --- table profile ---------------------------------------------------------------------------

def profile(df: DataFrame) -> DataFrame:
    """Columns with type, nullability and position, the row count and each column's NULL count.

    Schema facts come from the DataFrame's schema (metadata, not data); the counts are one
    aggregate over the table. Any column name works (it is quoted, not stripped).
    """
    fields = df.schema.fields
    counts = df.agg(
        F.count(F.lit(1)).alias("_rows"),
        *[F.count_if(_bq(f.name).isNull()).alias(f"_n{i}") for i, f in enumerate(fields)],
    )
    rows = [
        F.struct(
            F.lit(i + 1).alias("position"),
            F.lit(f.name).alias("column_name"),
            F.lit(f.dataType.simpleString()).alias("data_type"),
            F.lit("YES" if f.nullable else "NO").alias("is_nullable"),
            F.col("_rows").alias("row_count"),
            F.col(f"_n{i}").alias("null_count"),
        )
        for i, f in enumerate(fields)
    ]
    return counts.select(F.inline(F.array(*rows)))
