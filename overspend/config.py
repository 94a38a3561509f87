"""Parameters of the rules, the scorer and the reports.

Plain frozen dataclasses with the documented defaults; every operator takes
them as arguments, so a run is reproducible from its parameters alone.
"""

from __future__ import annotations

from dataclasses import dataclass, field


@dataclass(frozen=True)
class DetectionParams:
    window_days: int = 1  # Rule 1: max day gap to the previous same-key invoice
    price_threshold: float = 1.15  # Rule 2: invoice / baseline must exceed this
    grace_days: int = 0  # Rule 3: days of tolerance before a late delivery counts
    penalty_per_day: float = 150.0  # Rule 3: leakage per breach day
    spike_sigma: float = 2.0  # Rule 4: sigmas above the rolling mean
    rolling_window: int = 14  # Rule 4: previous observed days in the baseline
    min_history: int = 3  # Rule 4: values needed before a day can be judged

    def __post_init__(self) -> None:
        if self.rolling_window < self.min_history:
            raise ValueError(
                f"rolling_window ({self.rolling_window}) must be >= {self.min_history}: "
                "a shorter window can never hold enough history"
            )


def _default_base_scores() -> dict[str, float]:
    return {"duplicate": 70.0, "price_variance": 60.0, "sla_breach": 45.0, "volume_spike": 40.0}


@dataclass(frozen=True)
class ScoringParams:
    base_scores: dict[str, float] = field(default_factory=_default_base_scores)
    unknown_rule_score: float = 30.0
    low_threshold: float = 500.0
    medium_threshold: float = 2000.0
    high_threshold: float = 10000.0
    critical_band: float = 80.0
    high_band: float = 60.0
    medium_band: float = 35.0
    currency: str = "GBP"


@dataclass(frozen=True)
class ReportParams:
    top_suppliers: int = 5  # executive summary list
    exposure_suppliers: int = 8  # supplier x rule exposure chart
    alert_items: int = 3  # findings listed in an alert
    alert_severity: str = "Critical"  # gate and list severity of alerts
    detail_limit: int | None = None  # optional cap on the detail table (none by default)


DEFAULT_DETECTION = DetectionParams()
DEFAULT_SCORING = ScoringParams()
DEFAULT_REPORT = ReportParams()
