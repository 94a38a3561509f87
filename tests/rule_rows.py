"""Rows and values that the rule, source and streaming tests share."""

from __future__ import annotations

import datetime as dt

SF_SMALL = "/root/testdata/sf0.001"
MONDAY = dt.date(2031, 3, 3)


def base_row(**given) -> dict:
    """A transaction that no rule flags on its own: paid at the agreed rate, delivered on the agreed day."""
    row = {"transaction_id": "t", "date": MONDAY, "supplier_id": "lumen", "supplier_name": "Lumen Tools", "category": "Fixings",
           "baseline_rate": 80.0, "invoice_amount": 80.0, "po_number": None, "region": None, "approved_by": None,
           "is_anomaly": None, "anomaly_type": None}
    row.update(given)
    row.setdefault("expected_delivery_date", MONDAY)
    row.setdefault("actual_delivery_date", row["expected_delivery_date"])
    return row


def ids(df) -> list[str]:
    return sorted(r["transaction_id"] for r in df.select("transaction_id").collect())
