"""Fixed values that must equal the reference's for identical results.

Kept together, in their natural order, as plain text. Every operator takes these as default
arguments, so a caller can pass its own lists and thresholds.
"""

from __future__ import annotations

# --- fixed values: accepted values declared on the raw feed, silver and the marts ----------
PARTIES = ("berlinre", "dronant", "getland", "liadigital")
RAW_STATUSES = ("processed", "process", "failed", "refunded")
SILVER_STATUSES = ("processed", "failed", "refunded")
CURRENCIES = ("EUR",)
RECON_STATUSES = ("MATCH", "NEAR_MATCH", "DISCREPANCY")
LTV_BUCKETS = ("0-50 EUR", "50-200 EUR", "200-500 EUR", "500+ EUR")
CONCENTRATION_LEVELS = ("competitive", "moderately_concentrated", "highly_concentrated")

# --- fixed values: silver status normalisation and data-quality flag names, in flag order ---
STATUS_VARIANT = "process"
STATUS_NORMALISED = "processed"
FLAG_TIMESTAMP = "unparseable_timestamp"
FLAG_PREMIUM = "unparseable_premium"
FLAG_NEGATIVE = "negative_premium"
FLAG_PARTY = "missing_party"

# --- fixed values: lineage literal written by the bronze layer -----------------------------
RAW_SOURCE_FILE = "raw_transactions.csv"

# --- fixed values: thresholds ---------------------------------------------------------------
RECON_ABS_TOLERANCE = "0.01"  # absolute difference below which a month MATCHes
RECON_REL_TOLERANCE = "0.01"  # relative difference below which a month is a NEAR_MATCH
HIGH_CHURN_RATE = "0.10"  # rounded refund rate above which a party-month is high churn
HHI_COMPETITIVE_BELOW = 1500
HHI_MODERATE_UP_TO = 2500
DOMINANT_SHARE = "0.40"
LTV_BUCKET_EDGES = (50, 200, 500)
LTV_TILES = 10
NET_IDENTITY_TOLERANCE = "0.01"

# --- fixed values: row caps of the SQL entry points and reports ------------------------------
DEFAULT_ROW_CAP = 100
CHECK_ROW_CAP = 200
PREVIEW_ROWS = 100
COHORT_PREVIEW_ROWS = 500
TOP_DISCREPANCIES = 5

# --- fixed values: report filter allow-list per mart, ignored placeholder values, value shape
REPORT_FILTERS = {
    "gold_fct_monthly_premiums": ("party", "month"),
    "gold_fct_accounting_reconciliation": ("party", "month", "reconciliation_status"),
    "gold_fct_customer_activity_daily": ("user_id", "product_group", "activity_date"),
}
IGNORED_FILTER_VALUES = ("none", "null", "all", "")
SAFE_FILTER_VALUE = r"^[a-zA-Z0-9_\-]{1,64}$"
YEAR_VALUE = r"^\d{4}$"

# --- fixed values: table aliases for audits, first substring match wins, in this order ------
AUDIT_TABLE_ALIASES = (
    ("monthly", "gold_fct_monthly_premiums"),
    ("premium", "gold_fct_monthly_premiums"),
    ("reconciliation", "gold_fct_accounting_reconciliation"),
    ("accounting", "gold_fct_accounting_reconciliation"),
    ("customer", "gold_fct_customer_activity_daily"),
    ("daily", "gold_fct_customer_activity_daily"),
    ("activity", "gold_fct_customer_activity_daily"),
)
DEFAULT_AUDIT_TABLE = "gold_fct_monthly_premiums"

# --- fixed values: the five inline sample policies of the daily activity mart ---------------
# (user_id, acquisition_date, started_at, churned_at, monthly_premium, product_group)
SAMPLE_POLICIES = (
    ("USR001", "2025-01-15", "2025-02-01", None, "9.99", "liability"),
    ("USR002", "2025-01-20", "2025-02-01", "2025-04-30", "14.99", "liability"),
    ("USR003", "2025-03-01", "2025-03-15", "2025-06-30", "7.50", "household"),
    ("USR004", "2025-02-10", "2025-02-15", None, "12.00", "household"),
    ("USR005", "2025-01-05", "2025-01-10", "2025-03-31", "5.99", "legal"),
)
