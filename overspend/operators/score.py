"""Scoring: base score by rule + financial impact score, capped at 100, then a
severity band, its rank and the recommended action.  A narrow projection —
no shuffle; ordering is a separate, explicit operator (``rank_scored``)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import DEFAULT_SCORING, ScoringParams
from ..functions import scoring as S
from ..plans.physical import global_row_number

REQUIRED = ("rule_triggered", "leakage_amount_gbp")


def score_flags(flags: DataFrame, p: ScoringParams = DEFAULT_SCORING) -> DataFrame:
    missing = set(REQUIRED) - set(flags.columns)
    if missing:
        raise ValueError(f"cannot score flags without {sorted(missing)}")
    # two projections (each transformation re-analyses the whole plan); the
    # expressions repeated in the second are cheap column arithmetic
    parts = flags.withColumns(
        {
            "base_score": S.base_score("rule_triggered", p),
            "financial_score": S.financial_score("leakage_amount_gbp", p),
        }
    )
    composite = F.least(F.col("base_score") + F.col("financial_score"), F.lit(100.0))
    severity = S.severity(composite, p)
    return parts.withColumns(
        {
            "composite_score": composite,
            "severity": severity,
            "severity_rank": S.severity_rank(severity),
            "action_required": S.action(severity),
        }
    )


def scored_order():
    """Most severe first, then largest leakage (nulls last); ties by id and rule."""
    return [
        F.col("severity_rank").desc(),
        F.col("leakage_amount_gbp").desc_nulls_last(),
        F.col("transaction_id").asc(),
        F.col("rule_triggered").asc(),
    ]


def rank_scored(scored: DataFrame, name: str = "rank") -> DataFrame:
    """Scored rows numbered 1..N in review order (distributed; see
    ``global_row_number``)."""
    return global_row_number(scored, scored_order(), name)
