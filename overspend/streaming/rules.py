"""Structured Streaming versions of the row rules and the daily counts.

* ``stream_row_flags`` (price + SLA): stateless, the batch expressions applied
  to every micro-batch row.
* ``stream_daily_counts``: watermarked tumbling one-day counts; a day is
  emitted once its window closes (append mode).

Duplicates need the earlier days of a key, and spikes whole days: see
``streaming.jobs``, which runs the batch operators on every micro-batch.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import DEFAULT_DETECTION, DetectionParams
from ..constants import RULE_PRICE, RULE_SLA
from ..operators import rules as R
from ..operators.detect import _explode_hits, _hit

DAY_S = 86_400


def event_time(stream: DataFrame, lateness: str) -> DataFrame:
    """Day-grained event time from ``date`` with a watermark: midnight UTC of
    the date, whatever the session time zone."""
    at = F.timestamp_seconds(F.unix_date("date") * DAY_S)
    return stream.withColumn("_event_ts", at).withWatermark("_event_ts", lateness)


def stream_row_flags(stream: DataFrame, p: DetectionParams = DEFAULT_DETECTION) -> DataFrame:
    """Price-variance and SLA hits of every arriving transaction (R1)."""
    cols = stream.columns
    breach = R.breach_days(p.grace_days)
    hits = [
        F.when(R.price_hit(p.price_threshold), _hit(RULE_PRICE, R.price_detail(p.price_threshold), R.price_leakage(p.price_threshold))),
        F.when(breach > 0, _hit(RULE_SLA, R.sla_detail(breach), R.sla_leakage(breach, p.penalty_per_day), breach=breach)),
    ]
    return _explode_hits(stream, cols, hits)


def stream_daily_counts(stream: DataFrame, lateness: str = "1 day") -> DataFrame:
    """Transactions per day, emitted when the day's window closes (R3).

    Windows of one day begin at midnight UTC, as the event times do, so the
    date that goes in is the date that comes out in every time zone.
    """
    day = F.date_from_unix_date((F.unix_seconds(F.col("window.start")) / DAY_S).cast("int"))
    return (
        event_time(stream, lateness)
        .groupBy(F.window("_event_ts", "1 day"))
        .agg(F.count(F.lit(1)).alias("daily_count"))
        .select(day.alias("date"), "daily_count")
    )
