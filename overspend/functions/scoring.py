"""Scoring expressions: financial impact score, severity band, rank, action."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..config import DEFAULT_SCORING, ScoringParams
from ..constants import ACTIONS, SEVERITY_RANK
from .numeric import exact_round


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def lookup(mapping: dict, key: Column, default=None) -> Column:
    """Literal dictionary lookup as a ``CASE`` over the keys."""
    expr = None
    for k, v in mapping.items():
        expr = (F.when(key == F.lit(k), F.lit(v))) if expr is None else expr.when(key == F.lit(k), F.lit(v))
    if expr is None:
        return F.lit(default)
    return expr.otherwise(F.lit(default)) if default is not None else expr


def financial_score(c: Column | str, p: ScoringParams = DEFAULT_SCORING) -> Column:
    """0–30 score rising with leakage; linear inside each band.

    x <= 0 → 0; x < low → 5..10; x < medium → 10..20; x < high → 20..28;
    otherwise (also null / NaN) → 30. Each band is rounded to 2 dp.
    """
    x = _col(c)
    low, med, high = float(p.low_threshold), float(p.medium_threshold), float(p.high_threshold)
    return (
        F.when(x <= 0, F.lit(0.0))
        .when(x < low, exact_round(F.lit(5.0) + (x / F.lit(low)) * F.lit(5.0), 2))
        .when(x < med, exact_round(F.lit(10.0) + ((x - F.lit(low)) / F.lit(med - low)) * F.lit(10.0), 2))
        .when(x < high, exact_round(F.lit(20.0) + ((x - F.lit(med)) / F.lit(high - med)) * F.lit(8.0), 2))
        .otherwise(F.lit(30.0))
    )


def base_score(rule: Column | str, p: ScoringParams = DEFAULT_SCORING) -> Column:
    scores = {k: float(v) for k, v in p.base_scores.items()}
    return F.coalesce(lookup(scores, _col(rule)), F.lit(float(p.unknown_rule_score)))


def severity(score: Column | str, p: ScoringParams = DEFAULT_SCORING) -> Column:
    s = _col(score)
    return (
        F.when(s >= F.lit(float(p.critical_band)), F.lit("Critical"))
        .when(s >= F.lit(float(p.high_band)), F.lit("High"))
        .when(s >= F.lit(float(p.medium_band)), F.lit("Medium"))
        .otherwise(F.lit("Low"))
    )


def severity_rank(sev: Column | str) -> Column:
    return lookup(SEVERITY_RANK, _col(sev)).cast("int")


def action(sev: Column | str) -> Column:
    return lookup(ACTIONS, _col(sev))
