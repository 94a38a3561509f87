"""The registered queries: one per operator of the inventory.

Every query takes ``(spark, sf_dir)``, reads the whole test tables under
``sf_dir`` (through the fixture mapping to transactions) and returns a lazy
DataFrame.  Column names match the oracle SQL in ``plans/oracle.py``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import DEFAULT_DETECTION, DEFAULT_REPORT, DEFAULT_SCORING
from ..functions.numeric import array_round
from ..operators import detect as D
from ..operators import quality as Q
from ..operators import report as P
from ..operators import rules as R
from ..operators import score as S
from ..sources.fixtures import fixture_transactions, repeated_transactions
from ..sources.transactions import as_strings, coerce_transactions, load_profile

Query = Callable[[SparkSession, str], DataFrame]


def transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fixture_transactions(spark, sf_dir)


def flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    return D.all_flags(transactions(spark, sf_dir), DEFAULT_DETECTION)


def scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.score_flags(flags(spark, sf_dir), DEFAULT_SCORING)


def _summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    tx = transactions(spark, sf_dir)
    sc = S.score_flags(D.all_flags(tx, DEFAULT_DETECTION))
    return P.executive_summary(tx, sc)


def _rounded_stats(df: DataFrame) -> DataFrame:
    # rolling statistics are doubles from different summation orders: compare at 6 dp
    return df.withColumns({c: array_round(c, 6) for c in ("rolling_mean", "rolling_std", "upper_bound") if c in df.columns})


def q_load_transactions(spark, sf_dir):
    return coerce_transactions(as_strings(transactions(spark, sf_dir)))


def q_load_profile(spark, sf_dir):
    return load_profile(transactions(spark, sf_dir))


def q_price_variance(spark, sf_dir):
    return R.detect_price_variance(transactions(spark, sf_dir))


def q_sla_breach(spark, sf_dir):
    return R.detect_sla_breaches(transactions(spark, sf_dir))


def q_duplicates(spark, sf_dir):
    return R.detect_duplicates(transactions(spark, sf_dir))


def q_duplicates_pairwise(spark, sf_dir):
    return R.detect_duplicates_pairwise(transactions(spark, sf_dir))


def q_daily_counts(spark, sf_dir):
    return R.daily_counts(transactions(spark, sf_dir))


def q_volume_baseline(spark, sf_dir):
    return _rounded_stats(R.volume_baseline(transactions(spark, sf_dir)))


def q_volume_spikes(spark, sf_dir):
    return _rounded_stats(R.detect_volume_spikes(transactions(spark, sf_dir)))


def q_all_flags(spark, sf_dir):
    return _rounded_stats(flags(spark, sf_dir))


def q_rule_details(spark, sf_dir):
    return flags(spark, sf_dir).select("transaction_id", "rule_triggered", "rule_detail")


def q_run_summary(spark, sf_dir):
    _, summary = D.run_detection(transactions(spark, sf_dir), DEFAULT_DETECTION)
    return summary


def q_leakage_by_rule(spark, sf_dir):
    return D.leakage_by_rule(flags(spark, sf_dir))


def q_rule_run_stats(spark, sf_dir):
    return D.rule_run_stats(flags(spark, sf_dir))


def q_financial_score(spark, sf_dir):
    return scored(spark, sf_dir).select(
        "transaction_id", "rule_triggered", "leakage_amount_gbp", "base_score", "financial_score", "composite_score"
    )


def q_scored(spark, sf_dir):
    return _rounded_stats(scored(spark, sf_dir))


def q_scored_ranked(spark, sf_dir):
    # project first: the ranking sorts and checkpoints only the columns it returns
    cols = ["transaction_id", "rule_triggered", "severity", "severity_rank", "leakage_amount_gbp", "composite_score"]
    return S.rank_scored(scored(spark, sf_dir).select(*cols)).select("rank", *cols)


def q_critical_top3(spark, sf_dir):
    return P.top_findings(scored(spark, sf_dir), DEFAULT_REPORT.alert_items, "Critical")


def q_severity_breakdown(spark, sf_dir):
    return P.severity_breakdown(scored(spark, sf_dir))


def q_executive_summary(spark, sf_dir):
    return _summary(spark, sf_dir)


def q_leakage_by_category(spark, sf_dir):
    return P.leakage_by_category(scored(spark, sf_dir))


def q_top_suppliers(spark, sf_dir):
    return P.top_suppliers(scored(spark, sf_dir), DEFAULT_REPORT.top_suppliers)


def q_rule_share(spark, sf_dir):
    return P.rule_share(scored(spark, sf_dir))


def q_rule_performance(spark, sf_dir):
    return P.rule_performance(scored(spark, sf_dir))


def q_daily_trend(spark, sf_dir):
    return P.daily_trend(scored(spark, sf_dir))


def q_severity_heatmap(spark, sf_dir):
    return P.severity_heatmap(scored(spark, sf_dir))


def q_supplier_exposure(spark, sf_dir):
    return P.supplier_exposure(scored(spark, sf_dir), DEFAULT_REPORT.exposure_suppliers)


def q_category_rule_leakage(spark, sf_dir):
    return P.category_rule_leakage(scored(spark, sf_dir))


def q_kpi_tiles(spark, sf_dir):
    return P.kpi_tiles(_summary(spark, sf_dir))


def q_flagged_items(spark, sf_dir):
    return P.flagged_items(scored(spark, sf_dir))


def q_alert_digest(spark, sf_dir):
    tx = transactions(spark, sf_dir)
    sc = S.score_flags(D.all_flags(tx, DEFAULT_DETECTION))
    return P.alert_digest(P.executive_summary(tx, sc), sc, DEFAULT_REPORT)


def q_alert_payload(spark, sf_dir):
    return P.alert_payload(q_alert_digest(spark, sf_dir)).select("payload")


def q_dedup_flags(spark, sf_dir):
    # lines loaded twice, and ids that come again a day later
    tx = repeated_transactions(transactions(spark, sf_dir))
    return D.all_flags(tx, DEFAULT_DETECTION).select("transaction_id", "rule_triggered", "date", "rule_detail", "leakage_amount_gbp")


def q_empty_totals(spark, sf_dir):
    # every rule in every month: zero, not null or missing, where nothing was found
    tx = transactions(spark, sf_dir)
    return P.monthly_totals(tx, D.all_flags(tx, DEFAULT_DETECTION))


def q_duplicates_window30(spark, sf_dir):
    # about a month: every pair of days of a key within it
    return R.detect_duplicates_pairwise(transactions(spark, sf_dir), 30)


def q_breakdowns(spark, sf_dir):
    return P.breakdowns(scored(spark, sf_dir))


def q_rule_quality(spark, sf_dir):
    tx = transactions(spark, sf_dir)
    return Q.rule_quality(tx, D.all_flags(tx, DEFAULT_DETECTION))


QUERIES: dict[str, Query] = {
    "load_transactions": q_load_transactions,
    "load_profile": q_load_profile,
    "price_variance": q_price_variance,
    "sla_breach": q_sla_breach,
    "rule_details": q_rule_details,
    "flagged_items": q_flagged_items,
    "duplicates": q_duplicates,
    "duplicates_pairwise": q_duplicates_pairwise,
    "duplicates_window30": q_duplicates_window30,
    "daily_counts": q_daily_counts,
    "run_summary": q_run_summary,
    "leakage_by_rule": q_leakage_by_rule,
    "severity_breakdown": q_severity_breakdown,
    "executive_summary": q_executive_summary,
    "leakage_by_category": q_leakage_by_category,
    "top_suppliers": q_top_suppliers,
    "rule_share": q_rule_share,
    "rule_performance": q_rule_performance,
    "daily_trend": q_daily_trend,
    "severity_heatmap": q_severity_heatmap,
    "supplier_exposure": q_supplier_exposure,
    "category_rule_leakage": q_category_rule_leakage,
    "breakdowns": q_breakdowns,
    "kpi_tiles": q_kpi_tiles,
    "rule_run_stats": q_rule_run_stats,
    "volume_baseline": q_volume_baseline,
    "volume_spikes": q_volume_spikes,
    "scored_ranked": q_scored_ranked,
    "critical_top3": q_critical_top3,
    "all_flags": q_all_flags,
    "financial_score": q_financial_score,
    "scored": q_scored,
    "alert_digest": q_alert_digest,
    "alert_payload": q_alert_payload,
    "dedup_flags": q_dedup_flags,
    "empty_totals": q_empty_totals,
    "rule_quality": q_rule_quality,
}
