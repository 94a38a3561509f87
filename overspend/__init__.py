"""Spend-anomaly detection on Spark: rules, scoring and reports as DataFrame operators."""

__version__ = "0.1.0"
