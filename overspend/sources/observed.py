"""Statistics that come with a write, without a second pass over its rows.

The aggregates are observed after the last shuffle, in the tasks that write:
Spark counts each of these once, also where lost executors make it run earlier
stages again.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from ..operators.detect import run_stats, spike_date
from .transactions import profile_metrics


def write_observed(df: DataFrame, path: str, metrics: list[Column], mode: str = "error", by: str = "date") -> dict:
    """Write ``df`` as :func:`overspend.sources.sinks.write_partitioned` does; the values of ``metrics`` over its rows, by name."""
    seen = Observation()
    df.hint("rebalance", by).observe(seen, *metrics).write.mode(mode).partitionBy(by).parquet(path)
    return seen.get


def write_transactions(tx: DataFrame, path: str, mode: str = "error") -> dict:
    """Write the transactions by date and return their load profile."""
    return write_observed(tx, path, profile_metrics(), mode)


def write_flags(flags: DataFrame, path: str, mode: str = "error") -> dict:
    """Write a flag table by rule and return its run statistics.

    The distinct spike days are gathered as a set, of one entry per calendar
    day at most.
    """
    return write_observed(flags, path, run_stats(F.size(F.collect_set(spike_date())).cast("long")), mode, by="rule_triggered")
