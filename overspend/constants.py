"""Fixed values.

Every value in this module must equal the published behaviour of the
system this engine replaces, because they appear verbatim in the output
(rule tags, severity labels and their order, action texts, display names)
or decide results (default thresholds live in ``config.py``).
"""

from __future__ import annotations

# --- Fixed values: rule tags (output column ``rule_triggered``) -------------
RULE_DUPLICATE = "duplicate"
RULE_PRICE = "price_variance"
RULE_SLA = "sla_breach"
RULE_SPIKE = "volume_spike"
RULES = (RULE_DUPLICATE, RULE_PRICE, RULE_SLA, RULE_SPIKE)

# --- Fixed values: severity labels, their rank, and the action per label ----
SEVERITY_RANK = {"Critical": 4, "High": 3, "Medium": 2, "Low": 1}
SEVERITY_LABELS_ASC = ("Low", "Medium", "High", "Critical")
SEVERITY_LABELS_DESC = ("Critical", "High", "Medium", "Low")
ACTIONS = {
    "Critical": "IMMEDIATE: Escalate to Finance Director. Freeze supplier payments pending review.",
    "High": "TODAY: Assign to senior analyst for same-day investigation.",
    "Medium": "THIS WEEK: Add to weekly ops review. Request supplier clarification.",
    "Low": "MONITOR: Log for trend analysis. Review at end of month.",
}

# --- Fixed values: rule display names ----------------------------------------
# Summary table and dashboard charts use these labels ...
RULE_LABELS = {
    "duplicate": "Duplicate Transactions",
    "price_variance": "Price Variance / Overcharge",
    "sla_breach": "SLA Breach",
    "volume_spike": "Volume Spike",
}
# ... while the rule-performance table uses a shorter price label.
RULE_LABELS_SHORT = {
    "duplicate": "Duplicate Transactions",
    "price_variance": "Price Variance",
    "sla_breach": "SLA Breach",
    "volume_spike": "Volume Spike",
}

# --- Fixed values: KPI tile labels, in display order -------------------------
KPI_LABELS = ("Total Leakage", "Transactions", "Flags Raised", "Critical", "High", "Medium", "Low")

# --- Fixed values: alert text --------------------------------------------------
ALERT_NO_ITEMS = "_No Critical items to display._"

# --- Fixed values: columns every transaction source must provide -------------
REQUIRED_COLUMNS = (
    "transaction_id",
    "date",
    "supplier_id",
    "supplier_name",
    "category",
    "baseline_rate",
    "invoice_amount",
    "expected_delivery_date",
    "actual_delivery_date",
)
# --- Fixed values: which of them are dates and which are numbers ------------------
DATE_COLUMNS = ("date", "expected_delivery_date", "actual_delivery_date")
NUMBER_COLUMNS = ("invoice_amount", "baseline_rate")
OPTIONAL_COLUMNS = ("po_number", "region", "approved_by", "is_anomaly", "anomaly_type")

# Columns the rules add; a flag table always carries all of them.
FLAG_COLUMNS = (
    "rule_triggered",
    "rule_detail",
    "leakage_amount_gbp",
    "breach_days",
    "daily_count",
    "rolling_mean",
    "rolling_std",
)
SCORE_COLUMNS = (
    "base_score",
    "financial_score",
    "composite_score",
    "severity",
    "severity_rank",
    "action_required",
)
