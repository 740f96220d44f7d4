"""Independent DuckDB SQL for every registered query (the correctness oracle).

The oracle follows the reference's own SQL shape — separate CTEs, left joins, self-joins,
``NTILE`` over the whole table — rather than the Spark plans, so a rewrite in the Spark code
(fused aggregates, windows instead of joins, month-level spine) is checked against the
original formulation. Every rounding is done in integer units with ``//`` (DuckDB divides
decimals in double precision), which makes the oracle exact, too.

The supplied tables are pre-registered views: orders, customer, lineitem, …
"""

from __future__ import annotations

from premiumlake import reference_values as rv

AS_OF = "DATE '2001-12-31'"
PARTY_LIST = "[" + ", ".join(f"'{p}'" for p in rv.PARTIES) + "]"


def rr(num: str, den: str, scale: int, shift: int = 0) -> str:
    """round(num / den * 10^shift, scale) half away from zero, for integer (HUGEINT) inputs;
    NULL when den is 0 or NULL. Result DECIMAL(28, scale)."""
    e = scale + shift
    if e < 0:  # move the negative power onto the divisor
        den, e = f"({den}) * {10 ** -e}", 0
    p = 10**e
    unit = "1" if scale == 0 else "0." + "0" * (scale - 1) + "1"
    return (
        f"(CASE WHEN ({den}) = 0 THEN NULL ELSE CAST("
        f"(CASE WHEN (({num}) < 0) <> (({den}) < 0) THEN -1 ELSE 1 END) * "
        f"((2 * abs(CAST({num} AS HUGEINT)) * {p} + abs(CAST({den} AS HUGEINT))) // (2 * abs(CAST({den} AS HUGEINT))))"
        f" AS DECIMAL(38,0)) * {unit} END)::DECIMAL(28,{scale})"
    )


def units(x: str, scale: int) -> str:
    """Exact decimal → integer units at ``scale`` (e.g. cents)."""
    return f"CAST(({x}) * {10 ** scale} AS HUGEINT)"


_CTES: dict[str, tuple[str, tuple[str, ...]]] = {}


def _cte(name: str, sql: str, *deps: str) -> None:
    _CTES[name] = (sql, deps)


_cte(
    "raw",
    f"""
SELECT CAST(o_orderkey AS VARCHAR) AS transaction_id,
  CASE WHEN o_orderkey % 97 = 0 THEN CAST(year(o_orderdate) AS VARCHAR) || '-01-01'
       WHEN o_orderkey % 193 = 0 THEN '13/45/2025 1:00:00'
       ELSE CAST(month(o_orderdate) AS VARCHAR) || '/' || CAST(day(o_orderdate) AS VARCHAR) || '/'
            || CAST(year(o_orderdate) AS VARCHAR) || ' ' || CAST(o_orderkey % 24 AS VARCHAR) || ':'
            || lpad(CAST(o_orderkey % 60 AS VARCHAR), 2, '0') || ':' || lpad(CAST(o_orderkey * 7 % 60 AS VARCHAR), 2, '0')
  END AS created_at,
  CASE WHEN o_orderkey % 101 = 0 THEN 'n/a'
       WHEN o_orderkey % 107 = 0 THEN NULL
       WHEN o_orderkey % 109 = 0 THEN '0.00'
       WHEN o_orderkey % 103 = 0 THEN '-' || CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR)
       WHEN o_orderkey % 127 = 0 THEN '0.004'
       WHEN o_orderkey % 131 = 0 THEN CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR) || '4567'
       ELSE CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR) END AS premium_amount,
  'EUR' AS premium_currency,
  CASE WHEN o_orderkey % 113 = 0 THEN NULL ELSE {PARTY_LIST}[o_custkey % 4 + 1] END AS charged_party,
  CASE WHEN o_custkey % 4 = 3 AND month(o_orderdate) = 5 AND year(o_orderdate) % 2 = 1
            THEN CASE WHEN o_orderkey % 2 = 0 THEN 'refunded' ELSE 'failed' END
       WHEN o_orderstatus = 'F' THEN 'processed'
       WHEN o_orderstatus = 'O' THEN CASE WHEN o_orderkey % 2 = 0 THEN 'process' ELSE 'processed' END
       WHEN o_orderstatus = 'P' THEN CASE o_orderkey % 3 WHEN 0 THEN 'refunded' WHEN 1 THEN 'failed' ELSE 'processed' END
  END AS status
FROM orders""",
)

_cte(
    "bronze",
    """
SELECT transaction_id, created_at,
  CASE WHEN regexp_full_match(premium_amount, '\\s*[+-]?(\\d+(\\.\\d*)?|\\.\\d+)([eE][+-]?\\d+)?\\s*')
       THEN TRY_CAST(trim(premium_amount) AS DECIMAL(22,6)) END AS premium_amount,
  premium_currency, charged_party, status, 'raw_transactions.csv' AS _source_file
FROM raw""",
    "raw",
)

_cte(
    "parsed",
    """
SELECT *, CASE WHEN regexp_full_match(created_at, '\\d{1,2}/\\d{1,2}/\\d{4} \\d{1,2}:\\d{2}:\\d{2}')
               THEN try_strptime(created_at, '%-m/%-d/%Y %-H:%M:%S') END AS ts
FROM bronze""",
    "bronze",
)

_cte(
    "silver",
    """
SELECT transaction_id,
  ts AS created_at_ts,
  CAST(ts AS DATE) AS transaction_date,
  strftime(ts, '%Y-%m') AS transaction_month,
  premium_amount, premium_currency,
  charged_party AS party,
  CASE WHEN status = 'process' THEN 'processed' ELSE status END AS status,
  status AS status_raw,
  (status = 'process') AS _status_normalized,
  concat_ws(',',
    CASE WHEN ts IS NULL THEN 'unparseable_timestamp' END,
    CASE WHEN premium_amount IS NULL THEN 'unparseable_premium' END,
    CASE WHEN premium_amount < 0 THEN 'negative_premium' END,
    CASE WHEN charged_party IS NULL THEN 'missing_party' END) AS _dq_flags,
  (ts IS NOT NULL AND premium_amount IS NOT NULL AND premium_amount >= 0 AND charged_party IS NOT NULL) AS _is_clean,
  _source_file
FROM parsed""",
    "parsed",
)

_cte(
    "monthly",
    f"""
SELECT sales.party, sales.month,
  sales.written_premium AS premium,
  sales.written_premium,
  CAST(coalesce(refs.refunded, 0) AS DECIMAL(28,2)) AS refunded_premium,
  CAST(coalesce(refs.n_refunds, 0) AS BIGINT) AS refund_count,
  CAST(sales.written_premium - coalesce(refs.refunded, 0) AS DECIMAL(28,2)) AS net_premium,
  {rr("sales.prorated", "sales.month_days", 2, shift=-6)} AS earned_premium,
  sales.transaction_count, sales.first_transaction_date, sales.last_transaction_date
FROM (
  SELECT party, transaction_month AS month,
    CAST(sum(premium_amount) AS DECIMAL(28,2)) AS written_premium,
    sum({units("premium_amount", 6)} * (date_diff('day', transaction_date, last_day(transaction_date)) + 1)) AS prorated,
    max(day(last_day(transaction_date))) AS month_days,
    count(*) AS transaction_count,
    min(transaction_date) AS first_transaction_date,
    max(transaction_date) AS last_transaction_date
  FROM silver WHERE status = 'processed' AND _is_clean AND premium_amount > 0
  GROUP BY party, transaction_month) sales
LEFT JOIN (
  SELECT party, transaction_month, CAST(sum(premium_amount) AS DECIMAL(28,2)) AS refunded, count(*) AS n_refunds
  FROM silver WHERE status_raw = 'refunded' AND _is_clean AND premium_amount > 0
  GROUP BY party, transaction_month) refs
ON refs.party = sales.party AND refs.transaction_month = sales.month""",
    "silver",
)

_cte(
    "ledger",
    f"""
SELECT party, month, CAST(CASE (mi + pix) % 5
    WHEN 0 THEN w WHEN 1 THEN w * 1.005 WHEN 2 THEN w * 1.05 WHEN 3 THEN 0 ELSE -w END AS DECIMAL(18,2)) AS accounting_premium
FROM (
  SELECT party, transaction_month AS month, CAST(sum(premium_amount) AS DECIMAL(28,2)) AS w,
    CAST(substr(transaction_month, 1, 4) AS INTEGER) * 12 + CAST(substr(transaction_month, 6, 2) AS INTEGER) AS mi,
    list_position({PARTY_LIST}, party) - 1 AS pix
  FROM silver WHERE status = 'processed' AND _is_clean AND premium_amount > 0
  GROUP BY party, transaction_month) g
WHERE mi % 17 <> 0
UNION ALL
SELECT p, '2002-01', CAST(100.00 AS DECIMAL(18,2)) FROM unnest({PARTY_LIST}) t(p)""",
    "silver",
)

_cte(
    "recon",
    f"""
SELECT party, month, accounting_premium, finance_premium, net_premium, refunded_premium, net_delta,
  transaction_count, delta, delta_pct,
  CASE WHEN gap_cents = 0 THEN 'MATCH'
       WHEN ledger_cents < 0 OR (ledger_cents > 0 AND abs(gap_cents) * 100 < ledger_cents) THEN 'NEAR_MATCH'
       ELSE 'DISCREPANCY' END AS reconciliation_status,
  gap_cents = 0 AS is_reconciled
FROM (
  SELECT l.party, l.month, l.accounting_premium,
    CAST(coalesce(m.written_premium, 0) AS DECIMAL(28,2)) AS finance_premium,
    CAST(coalesce(m.net_premium, 0) AS DECIMAL(28,2)) AS net_premium,
    CAST(coalesce(m.refunded_premium, 0) AS DECIMAL(28,2)) AS refunded_premium,
    CAST(coalesce(m.transaction_count, 0) AS BIGINT) AS transaction_count,
    CAST(coalesce(m.written_premium, 0) - l.accounting_premium AS DECIMAL(28,2)) AS delta,
    CAST(coalesce(m.net_premium, 0) - l.accounting_premium AS DECIMAL(28,2)) AS net_delta,
    {units("coalesce(m.written_premium, 0) - l.accounting_premium", 2)} AS gap_cents,
    {units("l.accounting_premium", 2)} AS ledger_cents,
    {rr(units("abs(coalesce(m.written_premium, 0) - l.accounting_premium)", 2), units("l.accounting_premium", 2), 4, shift=2)} AS delta_pct
  FROM ledger l LEFT JOIN monthly m ON m.party = l.party AND m.month = l.month) cmp""",
    "ledger",
    "monthly",
)

_cte(
    "churn",
    f"""
SELECT party, month,
  {rr(units("refunded_premium", 2), units("written_premium", 2), 2)} AS churn_rate,
  written_premium, refunded_premium, net_premium, transaction_count,
  coalesce({rr(units("refunded_premium", 2), units("written_premium", 2), 2)} > 0.10, false) AS high_churn
FROM monthly""",
    "monthly",
)

_cte(
    "hhi_mart",
    f"""
WITH month_sums AS (
  SELECT month,
    CAST(sum(net_premium) AS DECIMAL(28,2)) AS tot,
    sum({units("net_premium", 2)} * {units("net_premium", 2)}) AS sq_cents,
    count(DISTINCT party) AS n_parties,
    max(net_premium) AS hi, min(net_premium) AS lo
  FROM monthly GROUP BY month),
month_index AS (
  SELECT month, tot, n_parties,
    {rr("sq_cents * 10000", units("tot", 2) + " * " + units("tot", 2), 2)} AS hhi,
    coalesce(CASE WHEN tot > 0 THEN hi > 0.40 * tot WHEN tot < 0 THEN lo < 0.40 * tot END, false) AS dom
  FROM month_sums)
SELECT mm.party, mm.month, mm.net_premium, mm.written_premium, mi.tot AS total_net_premium,
  {rr(units("mm.net_premium", 2), units("mi.tot", 2), 2, shift=2)} AS market_share_pct,
  mi.hhi AS hhi_score, mi.n_parties AS active_parties,
  CASE WHEN mi.hhi < 1500 THEN 'competitive' WHEN mi.hhi <= 2500 THEN 'moderately_concentrated'
       ELSE 'highly_concentrated' END AS concentration_level,
  mi.dom AS dominant_party_flag, mm.transaction_count
FROM monthly mm JOIN month_index mi ON mi.month = mm.month""",
    "monthly",
)

_cte(
    "growth",
    f"""
SELECT party, month, previous_written_premium, written_premium,
  {rr(units("written_premium - previous_written_premium", 2), units("previous_written_premium", 2), 2, shift=2)} AS percentage_change,
  cumulative_written_premium
FROM (
  SELECT cur.party, cur.month, cur.written_premium,
    (SELECT before.written_premium FROM monthly before
      WHERE before.party = cur.party
        AND before.month = (SELECT max(b2.month) FROM monthly b2 WHERE b2.party = cur.party AND b2.month < cur.month)
    ) AS previous_written_premium,
    (SELECT CAST(sum(upto.written_premium) AS DECIMAL(28,2)) FROM monthly upto
      WHERE upto.party = cur.party AND upto.month <= cur.month) AS cumulative_written_premium
  FROM monthly cur) series""",
    "monthly",
)

_cte(
    "policies",
    """
SELECT user_id, acquisition_date, started_at, churned_at, monthly_premium, product_group FROM (
  SELECT k, user_id, acquisition_date, started_at, churned_at, monthly_premium, product_group FROM p1
  UNION ALL
  SELECT k, user_id, acquisition_date, churned_at + 90, churned_at + 150, monthly_premium, product_group
  FROM p1 WHERE k % 7 = 0 AND k % 20 <> 0 AND k % 50 <> 1) u""",
    "p1",
)

_cte(
    "p1",
    """
SELECT k, user_id, acquisition_date, started_at,
  CASE WHEN k % 20 = 0 THEN NULL WHEN k % 50 = 1 THEN started_at - 1 ELSE started_at + CAST(k % 400 + 30 AS INTEGER) END AS churned_at,
  monthly_premium, product_group
FROM (
  SELECT c.c_custkey AS k, 'USR' || CAST(c.c_custkey AS VARCHAR) AS user_id, f.acquisition_date,
    f.acquisition_date + CAST(c.c_custkey % 20 AS INTEGER) AS started_at,
    CAST(CAST(abs(c.c_acctbal) AS DECIMAL(18,2)) * 0.01 AS DECIMAL(18,2)) AS monthly_premium,
    CASE WHEN c.c_mktsegment IN ('HOUSEHOLD', 'BUILDING') THEN 'household'
         WHEN c.c_mktsegment IN ('MACHINERY', 'AUTOMOBILE') THEN 'liability' ELSE 'legal' END AS product_group
  FROM customer c JOIN (SELECT o_custkey, CAST(min(o_orderdate) AS DATE) AS acquisition_date FROM orders GROUP BY o_custkey) f
  ON c.c_custkey = f.o_custkey) b""",
)


def _spine_sql(policies: str) -> str:
    return f"""
SELECT CAST(d AS DATE) AS activity_date, user_id, product_group, acquisition_date, started_at, churned_at,
  {rr(units("monthly_premium", 2), "day(last_day(CAST(d AS DATE)))", 6, shift=-2)}::DECIMAL(18,6) AS daily_premium,
  monthly_premium,
  CAST(date_diff('day', acquisition_date, CAST(d AS DATE)) AS INTEGER) AS days_since_acquisition,
  strftime(CAST(d AS DATE), '%Y-%m') AS activity_month
FROM {policies} p, unnest(generate_series(CAST(p.started_at AS TIMESTAMP),
                                    CAST(coalesce(p.churned_at, {AS_OF}) AS TIMESTAMP), INTERVAL 1 DAY)) t(d)"""


_cte("activity", _spine_sql("policies"), "policies")

_cte(
    "ump",
    f"""
SELECT user_id, product_group, m AS month, c AS acquisition_month,
  CAST(sum(daily_premium) AS DECIMAL(28,6)) AS premium,
  min(acquisition_date) AS acquisition_date
FROM (SELECT user_id, product_group, daily_premium, acquisition_date,
        CAST(date_trunc('month', activity_date) AS DATE) AS m,
        CAST(date_trunc('month', acquisition_date) AS DATE) AS c
      FROM activity) d
GROUP BY user_id, product_group, m, c""",
    "activity",
)

_cte(
    "kinds",
    f"""
SELECT user_id, product_group, month, premium,
  CASE WHEN month = acquisition_month THEN 'new_business'
       WHEN lag(month) OVER (PARTITION BY user_id, product_group ORDER BY month) = CAST(month - INTERVAL 1 MONTH AS DATE)
         THEN 'renewal'
       ELSE 'reactivation' END AS transaction_type
FROM ump""",
    "ump",
)

_cte(
    "gone",
    f"""
SELECT u.product_group, CAST(u.month + INTERVAL 1 MONTH AS DATE) AS month, CAST(sum(u.premium) AS DECIMAL(28,6)) AS lapsed_premium
FROM ump u
WHERE NOT EXISTS (
  SELECT 1 FROM ump nxt
  WHERE nxt.user_id = u.user_id AND nxt.product_group = u.product_group
    AND nxt.month = CAST(u.month + INTERVAL 1 MONTH AS DATE))
GROUP BY u.product_group, CAST(u.month + INTERVAL 1 MONTH AS DATE)""",
    "ump",
)

_cte(
    "cohort",
    f"""
WITH spans AS (
  SELECT DISTINCT user_id, product_group,
    CAST(date_trunc('month', acquisition_date) AS DATE) AS c,
    CAST(date_trunc('month', activity_date) AS DATE) AS m
  FROM activity),
per_month AS (
  SELECT c, product_group, m, count(DISTINCT user_id) AS n FROM spans GROUP BY c, product_group, m),
per_cohort AS (
  SELECT c, product_group, count(DISTINCT user_id) FILTER (WHERE m = c) AS n0 FROM spans GROUP BY c, product_group)
SELECT pm.c AS cohort_month, pm.product_group,
  CAST(date_diff('month', pm.c, pm.m) AS INTEGER) AS months_since_acquisition,
  CASE WHEN pc.n0 > 0 THEN pc.n0 END AS cohort_size,
  pm.n AS active_customers,
  {rr("pm.n", "CASE WHEN pc.n0 > 0 THEN pc.n0 END", 1, shift=2)} AS retention_rate
FROM per_month pm JOIN per_cohort pc ON pc.c = pm.c AND pc.product_group = pm.product_group""",
    "activity",
)

_cte(
    "ltv",
    f"""
SELECT user_id, product_group, cohort_month, last_active_month, active_months, lifetime_premium,
  {rr(units("lifetime_premium", 6), "active_months", 2, shift=-6)} AS avg_monthly_premium,
  CAST(ntile(10) OVER (ORDER BY lifetime_premium DESC NULLS FIRST, user_id, product_group) AS INTEGER) AS decile,
  CASE WHEN lifetime_premium >= 500 OR lifetime_premium IS NULL THEN '500+ EUR'
       WHEN lifetime_premium >= 200 THEN '200-500 EUR'
       WHEN lifetime_premium >= 50 THEN '50-200 EUR'
       ELSE '0-50 EUR' END AS ltv_bucket
FROM (
  SELECT user_id, product_group,
    min(CAST(date_trunc('month', acquisition_date) AS DATE)) AS cohort_month,
    max(CAST(date_trunc('month', activity_date) AS DATE)) AS last_active_month,
    count(DISTINCT CAST(date_trunc('month', activity_date) AS DATE)) AS active_months,
    CAST(sum(daily_premium) AS DECIMAL(28,6)) AS lifetime_premium
  FROM activity GROUP BY user_id, product_group) per_customer""",
    "activity",
)

_cte(
    "waterfall",
    f"""
WITH book AS (
  SELECT product_group, month,
    coalesce(sum(premium) FILTER (WHERE transaction_type = 'new_business'), 0) AS nb,
    coalesce(sum(premium) FILTER (WHERE transaction_type = 'renewal'), 0) AS rn
  FROM kinds GROUP BY product_group, month)
SELECT b.product_group AS party, b.month,
  CAST(round(b.nb, 2) AS DECIMAL(28,2)) AS new_business_premium,
  CAST(round(b.rn, 2) AS DECIMAL(28,2)) AS renewal_premium,
  CAST(round(coalesce(g.lapsed_premium, 0), 2) AS DECIMAL(28,2)) AS lapsed_premium,
  CAST(round(b.nb + b.rn - coalesce(g.lapsed_premium, 0), 2) AS DECIMAL(28,2)) AS net_written_premium,
  {rr(units("coalesce(g.lapsed_premium, 0)", 6), units("b.nb", 6), 2)} AS lapse_to_new_business_ratio
FROM book b LEFT JOIN gone g ON g.product_group = b.product_group AND g.month = b.month""",
    "kinds",
    "gone",
)


def with_ctes(final: str, *needs: str) -> str:
    """``WITH`` clause holding ``needs`` and their dependencies in order, then ``final``."""
    order: list[str] = []

    def visit(n: str) -> None:
        if n in order:
            return
        for d in _CTES[n][1]:
            visit(d)
        order.append(n)

    for n in needs:
        visit(n)
    body = ",\n".join(f"{n} AS ({_CTES[n][0]}\n)" for n in order)
    return f"WITH {body}\n{final}"


def cte_sql(name: str) -> str:
    return _CTES[name][0]


# --- data-quality checks in the form dbt compiles its generic tests to ----------------------

def _q(c: str) -> str:
    return '"' + c.replace('"', '""') + '"'


def check_sql(table: str, check) -> str:
    """One report row for a ``premiumlake.operators.quality.Check``."""
    cols = ",".join(check.columns)
    if check.kind == "not_null":
        failures = f"(SELECT count(*) FROM {table} WHERE {_q(check.columns[0])} IS NULL)"
    elif check.kind == "accepted_values":
        values = ", ".join("'" + str(v).replace("'", "''") + "'" for v in check.values)
        c = _q(check.columns[0])
        failures = f"(SELECT count(*) FROM (SELECT {c} FROM {table} WHERE {c} NOT IN ({values}) GROUP BY {c}) v)"
    elif check.kind == "unique":
        c = _q(check.columns[0])
        failures = f"(SELECT count(*) FROM (SELECT {c} FROM {table} WHERE {c} IS NOT NULL GROUP BY {c} HAVING count(*) > 1) d)"
    elif check.kind == "unique_combination":
        cs = ", ".join(_q(c) for c in check.columns)
        failures = f"(SELECT count(*) FROM (SELECT {cs} FROM {table} GROUP BY {cs} HAVING count(*) > 1) d)"
    else:
        raise ValueError(check.kind)
    bad = "'warn'" if check.severity == "warn" else "'fail'"
    return (
        f"SELECT '{check.name}' AS check_name, '{check.kind}' AS kind, '{cols}' AS column_names, "
        f"'{check.severity}' AS severity, CAST({failures} AS BIGINT) AS failures, "
        f"CASE WHEN {failures} = 0 THEN 'pass' ELSE {bad} END AS status, CAST(NULL AS VARCHAR) AS message"
    )


def suite_sql(table: str, checks) -> str:
    return "\nUNION ALL\n".join(check_sql(table, c) for c in checks)


# --- snapshot and load fixtures ---------------------------------------------------------------

SNAPSHOT_COLS = (
    "transaction_id, transaction_date, transaction_month, premium_amount, premium_currency, party, status, "
    "status_raw, _status_normalized, _dq_flags, _is_clean"
)

_cte("snap_b1", f"SELECT {SNAPSHOT_COLS} FROM silver", "silver")

_cte(
    "snap_b2",
    """
SELECT transaction_id, transaction_date, transaction_month,
  CASE WHEN CAST(transaction_id AS BIGINT) % 17 = 0 THEN CAST(premium_amount + 1.00 AS DECIMAL(22,6)) ELSE premium_amount END AS premium_amount,
  premium_currency,
  CASE WHEN CAST(transaction_id AS BIGINT) % 19 = 0 THEN party || '-moved' ELSE party END AS party,
  CASE WHEN CAST(transaction_id AS BIGINT) % 13 = 0 THEN 'refunded' ELSE status END AS status,
  status_raw, _status_normalized, _dq_flags, _is_clean
FROM snap_b1 WHERE CAST(transaction_id AS BIGINT) % 11 <> 0
UNION ALL
SELECT 'new-' || transaction_id, transaction_date, transaction_month, premium_amount, premium_currency, party, status,
  status_raw, _status_normalized, _dq_flags, _is_clean
FROM snap_b1 WHERE CAST(transaction_id AS BIGINT) % 101 = 0""",
    "snap_b1",
)

SNAP_T1 = "2025-01-01 00:00:00"
SNAP_T2 = "2025-02-01 00:00:00"

_cte(
    "snap_history",
    f"""
SELECT o.*, '{SNAP_T1}' AS valid_from,
  CASE WHEN n.transaction_id IS NULL OR n.status IS DISTINCT FROM o.status
         OR n.premium_amount IS DISTINCT FROM o.premium_amount THEN '{SNAP_T2}' END AS valid_to,
  NOT (n.transaction_id IS NULL OR n.status IS DISTINCT FROM o.status
         OR n.premium_amount IS DISTINCT FROM o.premium_amount) AS is_current
FROM snap_b1 o LEFT JOIN snap_b2 n ON o.transaction_id = n.transaction_id
UNION ALL
SELECT n.*, '{SNAP_T2}', CAST(NULL AS VARCHAR), true
FROM snap_b2 n LEFT JOIN snap_b1 o ON o.transaction_id = n.transaction_id
WHERE o.transaction_id IS NULL OR n.status IS DISTINCT FROM o.status OR n.premium_amount IS DISTINCT FROM o.premium_amount""",
    "snap_b1",
    "snap_b2",
)

_cte(
    "policies_recut",
    f"""
SELECT user_id, acquisition_date, started_at,
  least(coalesce(churned_at, {AS_OF}), started_at + 15) AS churned_at, monthly_premium, product_group
FROM policies WHERE CAST(substr(user_id, 4) AS BIGINT) % 5 = 0
UNION ALL
SELECT 'NEW' || CAST(min(c_custkey) AS VARCHAR), DATE '2001-11-20', DATE '2001-11-25', CAST(NULL AS DATE),
  CAST(10.00 AS DECIMAL(18,2)), 'legal' FROM customer""",
    "policies",
)

_cte("activity_batch", _spine_sql("policies_recut"), "policies_recut")

_cte(
    "customer_batch",
    """
SELECT c_custkey, c_name || ' (renamed)' AS c_name, c_nationkey, c_acctbal + 1.0 AS c_acctbal, c_mktsegment
FROM customer WHERE c_custkey % 9 = 0
UNION ALL
SELECT c_custkey + 10000000, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer WHERE c_custkey % 97 = 0""",
)
