"""Sinks: transaction CSV, date-partitioned Parquet, and the report tables.

Writers are distributed: every task writes its own part files; nothing is
collected to the driver.  Ordered outputs are range-partitioned and sorted
inside each partition, so the part files in name order are globally ordered.
"""

from __future__ import annotations

import os

from pyspark import StorageLevel
from pyspark.sql import DataFrame

from ..config import DEFAULT_REPORT, ReportParams
from ..operators import report as P
from ..operators.score import scored_order


def write_csv(df: DataFrame, path: str, mode: str = "error") -> None:
    """Table with a header row, ordered by (date, transaction_id)."""
    keys = [c for c in ("date", "transaction_id") if c in df.columns]
    out = df.repartitionByRange(*keys).sortWithinPartitions(*keys) if keys else df
    out.write.mode(mode).option("header", True).csv(path)


def write_partitioned(df: DataFrame, path: str, mode: str = "error", by: str = "date") -> None:
    """Parquet partitioned by ``by`` (date): later reads prune by date.

    The rebalance brings small days together and lets AQE split a busy day
    over several tasks and files, by the advisory partition size.
    """
    df.hint("rebalance", by).write.mode(mode).partitionBy(by).parquet(path)


def replace_days(df: DataFrame, path: str, by: str = "date") -> None:
    """Write the days of ``df`` into a table of :func:`write_partitioned`, in place of those days alone.

    A day that is delivered again replaces its own folder; the files of all
    other days stay as they are. A day without rows in ``df`` is not touched.
    """
    out = df.hint("rebalance", by).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    out.partitionBy(by).parquet(path)


def write_report(tx: DataFrame, scored: DataFrame, out_dir: str, p: ReportParams = DEFAULT_REPORT,
                 mode: str = "error") -> dict[str, str]:
    """The three report sections as one folder per table (Parquet).

    summary:    executive_summary, kpi_tiles, rule_share, top_suppliers
    flagged:    flagged_items, sorted in review order (optional row limit)
    statistics: rule_performance, daily_trend
    """
    scored = scored.persist(StorageLevel.MEMORY_AND_DISK)  # seven tables from one evaluation
    try:
        return _write_report(tx, scored, out_dir, p, mode)
    finally:
        scored.unpersist()


def _write_report(tx: DataFrame, scored: DataFrame, out_dir: str, p: ReportParams, mode: str) -> dict[str, str]:
    summary = P.executive_summary(tx, scored)
    tables = {
        "summary/executive_summary": summary,
        "summary/kpi_tiles": P.kpi_tiles(summary),
        "summary/rule_share": P.rule_share(scored),
        "summary/top_suppliers": P.top_suppliers(scored, p.top_suppliers),
        "statistics/rule_performance": P.rule_performance(scored),
        "statistics/daily_trend": P.daily_trend(scored).orderBy("date"),
    }
    written = {}
    for name, df in tables.items():
        path = os.path.join(out_dir, name)
        df.write.mode(mode).parquet(path)
        written[name] = path
    order = scored_order()
    detail = scored.repartitionByRange(*order).sortWithinPartitions(*order)
    if p.detail_limit is not None:
        detail = scored.orderBy(*order).limit(p.detail_limit)
    path = os.path.join(out_dir, "flagged/flagged_items")
    P.flagged_items(detail).write.mode(mode).parquet(path)
    written["flagged/flagged_items"] = path
    return written
