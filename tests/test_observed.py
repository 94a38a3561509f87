"""Statistics observed while a table is written equal the queries, without more jobs."""

from __future__ import annotations

import pytest
from rule_rows import SF_SMALL

from overspend.operators.detect import all_flags, rule_run_stats
from overspend.sources.fixtures import fixture_transactions
from overspend.sources.observed import write_flags, write_transactions
from overspend.sources.sinks import write_partitioned
from overspend.sources.transactions import load_profile


@pytest.fixture(scope="module")
def tx(spark):
    return fixture_transactions(spark, SF_SMALL)


def _jobs(spark, group, run):
    spark.sparkContext.setJobGroup(group, group)
    try:
        out = run()
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    return out, len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))


def test_load_profile_of_a_write(spark, tx, tmp_path):
    tx = tx.filter("date BETWEEN '1995-01-01' AND '1995-01-20'")
    rows = tx.persist()
    assert rows.count() > 0
    got, jobs = _jobs(spark, "observed", lambda: write_transactions(rows, str(tmp_path / "a")))
    _, plain = _jobs(spark, "plain", lambda: write_partitioned(rows, str(tmp_path / "b")))
    assert got == load_profile(tx).first().asDict() and jobs == plain
    assert spark.read.parquet(str(tmp_path / "a")).count() == got["total_transactions"]
    rows.unpersist()


def test_run_statistics_of_a_write(spark, tx, tmp_path):
    flags = all_flags(tx)
    got = write_flags(flags, str(tmp_path / "flags"))
    assert got == rule_run_stats(flags).first().asDict()
    assert got["spike_days"] > 0 and got["sla_flags"] > 0


def test_empty_tables(spark, make_tx, tmp_path):
    none = make_tx([])
    assert write_transactions(none, str(tmp_path / "tx")) == {"total_transactions": 0, "date_range_start": None, "date_range_end": None}
    assert write_flags(all_flags(none), str(tmp_path / "flags")) == rule_run_stats(all_flags(none)).first().asDict()
