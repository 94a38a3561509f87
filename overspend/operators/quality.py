"""Rule quality against ground-truth labels.

Labels are the ``|``-separated rule names in ``anomaly_type``.  Each rule
gets true positives (flagged and labelled), false positives (flagged, not
labelled) and false negatives (labelled, not flagged), with precision and
recall.  Labels and flags are stacked and aggregated per (id, rule) instead
of full-outer-joined, so partial aggregation keeps the shuffle small.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.numeric import array_round


def labels_of(tx: DataFrame) -> DataFrame:
    """(transaction_id, rule) for every label on every transaction."""
    return (
        tx.filter(F.col("anomaly_type").isNotNull() & (F.col("anomaly_type") != ""))
        .select("transaction_id", F.explode(F.split("anomaly_type", r"\|")).alias("rule_triggered"))
        .filter(F.col("rule_triggered") != "")
    )


def rule_quality(tx: DataFrame, flags: DataFrame) -> DataFrame:
    truth = labels_of(tx).select("transaction_id", "rule_triggered", F.lit(1).alias("_t"), F.lit(0).alias("_f"))
    hits = flags.select("transaction_id", "rule_triggered", F.lit(0).alias("_t"), F.lit(1).alias("_f"))
    pairs = (
        truth.unionByName(hits)
        .groupBy("transaction_id", "rule_triggered")
        .agg(F.max("_t").alias("_t"), F.max("_f").alias("_f"))
    )
    per_rule = pairs.groupBy("rule_triggered").agg(
        F.count(F.when((F.col("_t") == 1) & (F.col("_f") == 1), F.lit(1))).alias("true_positives"),
        F.count(F.when((F.col("_t") == 0) & (F.col("_f") == 1), F.lit(1))).alias("false_positives"),
        F.count(F.when((F.col("_t") == 1) & (F.col("_f") == 0), F.lit(1))).alias("false_negatives"),
    )
    tp, fp, fn = F.col("true_positives"), F.col("false_positives"), F.col("false_negatives")
    return per_rule.select(
        "rule_triggered",
        "true_positives",
        "false_positives",
        "false_negatives",
        F.when(tp + fp > 0, array_round(tp / (tp + fp), 6)).alias("precision"),
        F.when(tp + fn > 0, array_round(tp / (tp + fn), 6)).alias("recall"),
    )
