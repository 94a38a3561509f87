"""Metamorphic checks on the fixture tables: equal plans give equal results,
breakdowns add up to the headline, the counts match the fixture notes, and
every registered query equals its DuckDB oracle at sf0.001."""

from __future__ import annotations

import os

import duckdb
import pytest
from rule_rows import SF_SMALL
from pyspark.sql import functions as F

import __spark_entry__ as E
from overspend.operators import detect as D
from overspend.operators import report as P
from overspend.operators import rules as R
from overspend.operators.score import score_flags
from overspend.sources.fixtures import fixture_transactions

TABLES = [t.split(".")[0] for t in sorted(os.listdir(SF_SMALL)) if t.endswith(".parquet")]


@pytest.fixture(scope="module")
def tx(spark):
    return fixture_transactions(spark, SF_SMALL)


def _rows(df):
    return sorted(tuple(str(v) for v in r) for r in df.select(sorted(df.columns)).collect())


def test_fixture_counts(tx):
    assert tx.count() == 6142
    assert R.detect_duplicates(tx).count() == 142
    assert R.detect_price_variance(tx).count() == 764
    assert R.detect_sla_breaches(tx).count() == 2766
    assert R.spike_days(tx).count() == 149
    assert R.detect_volume_spikes(tx).count() == 847


def test_single_scan_equals_union(tx):
    assert _rows(D.all_flags(tx)) == _rows(D.all_flags_union(tx))


def test_nothing_runs_and_nothing_stays_persisted(spark, tx):
    """Building the flag table starts no job; running it leaves no persisted frame behind."""
    tracker = spark.sparkContext.statusTracker()
    tx.count()  # the spread scan of the fixture itself is kept
    kept = spark.sparkContext._jsc.getPersistentRDDs().size()
    spark.sparkContext.setJobGroup("build", "build")
    flags = D.all_flags(tx)
    assert not tracker.getJobIdsForGroup("build")
    spark.sparkContext.setJobGroup("run", "run")
    flags.count()
    assert spark.sparkContext._jsc.getPersistentRDDs().size() == kept
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_shuffle_joins_give_the_same_flags(spark, tx):
    want = _rows(D.all_flags(tx))
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert _rows(D.all_flags(tx)) == want
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_dedupe_is_noop_on_unique_ids_and_collapses_repeats(tx):
    flags = D.all_flags(tx)
    assert _rows(D.dedupe_flags(flags)) == _rows(flags)
    doubled = flags.unionByName(flags)
    assert D.dedupe_flags(doubled).count() == flags.count()


def test_breakdowns_sum_to_headline(tx):
    scored = score_flags(D.all_flags(tx))
    head = P.executive_summary(tx, scored).first()
    by_rule = P.scored_by_rule(scored).agg(F.sum("leakage_gbp"), F.sum("count")).first()
    by_sev = P.severity_breakdown(scored).agg(F.sum("flags")).first()[0]
    assert by_rule[0] == head["headline_gbp"] and by_rule[1] == head["total_flags"] == by_sev
    assert scored.count() == D.all_flags(tx).count()


def test_severity_distribution(tx):
    scored = score_flags(D.all_flags(tx))
    got = {(r["rule_triggered"], r["severity"]) for r in scored.select("rule_triggered", "severity").distinct().collect()}
    assert ("duplicate", "Critical") in got and ("volume_spike", "Medium") in got
    assert not any(rule == "sla_breach" and sev == "Critical" for rule, sev in got)


def _norm(v):
    if isinstance(v, float):
        return repr(v)
    return "<null>" if v is None else str(v)


@pytest.mark.parametrize("key", sorted(E.oracle_sql()))
def test_oracle(spark, key):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{os.path.join(SF_SMALL, t)}.parquet')")
    df = E.queries()[key](spark, SF_SMALL)
    res = con.execute(E.oracle_sql()[key])
    d_cols = [c[0] for c in res.description]
    assert sorted(df.columns) == sorted(d_cols)
    s_rows = sorted(tuple(_norm(r[c]) for c in sorted(df.columns)) for r in df.collect())
    idx = [d_cols.index(c) for c in sorted(d_cols)]
    d_rows = sorted(tuple(_norm(r[i]) for i in idx) for r in res.fetchall())
    assert s_rows == d_rows


def test_registered_rule_joins_detection(tx):
    from overspend.operators import rules as RR

    def weekend_rule(t, p):
        return t.filter(F.dayofweek("date").isin(1, 7)).select(
            *t.columns,
            F.lit("weekend_invoice").alias("rule_triggered"),
            F.lit("Invoice dated on a weekend").alias("rule_detail"),
            F.lit(0.0).alias("leakage_amount_gbp"),
        )

    base = D.all_flags(tx).count()
    RR.register_rule("weekend_invoice", weekend_rule)
    try:
        flags = D.all_flags(tx)
        extra = tx.filter(F.dayofweek("date").isin(1, 7)).count()
        assert flags.count() == base + extra
        scored = score_flags(flags.filter("rule_triggered = 'weekend_invoice'"))
        assert {r["severity"] for r in scored.select("severity").distinct().collect()} == {"Low"}
    finally:
        RR.unregister_rule("weekend_invoice")


def test_registered_rule_keeps_its_columns_and_built_ins_stay(tx):
    from overspend.operators import rules as RR

    def first_day(t, p):
        return t.filter(F.dayofmonth("date") == 1).select(
            *t.columns,
            F.lit("first_day").alias("rule_triggered"),
            F.lit("Dated on the first").alias("rule_detail"),
            F.lit(None).cast("double").alias("leakage_amount_gbp"),
            F.month("date").alias("month"),
        )

    with pytest.raises(ValueError):
        RR.register_rule("price_variance", first_day)
    RR.register_rule("first_day", first_day)
    try:
        one, other = D.all_flags(tx), D.all_flags_union(tx)
        assert "month" in one.columns and _rows(one) == _rows(other)
        own = one.filter("rule_triggered = 'first_day'")
        assert own.filter("month IS NULL").count() == 0 and one.filter("month IS NOT NULL").count() == own.count() > 0
        assert {r["leakage_gbp"] for r in D.leakage_by_rule(own).collect()} == {0}  # only nulls: zero
    finally:
        RR.unregister_rule("first_day")


def test_run_detection(tx):
    flags, summary = D.run_detection(tx)
    s = summary.first()
    assert s["total_transactions"] == 6142 and s["total_flagged"] == flags.count()


def test_empty_input_flows_through(tx):
    empty = tx.limit(0)
    flags = D.all_flags(empty)
    scored = score_flags(flags)
    assert flags.count() == 0 and scored.count() == 0
    head = P.executive_summary(empty, scored).first()
    assert head["total_transactions_analysed"] == 0 and head["total_flags"] == 0
    assert head["headline_gbp"] == 0
    assert D.run_summary(empty, flags).first()["total_leakage_gbp"] == 0
    assert {r["severity"]: r["flags"] for r in P.severity_breakdown(scored).collect()} == {
        "Critical": 0, "High": 0, "Medium": 0, "Low": 0}
    for table in (P.leakage_by_category(scored), P.top_suppliers(scored), P.rule_share(scored),
                  P.rule_performance(scored), P.daily_trend(scored), P.severity_heatmap(scored),
                  P.supplier_exposure(scored), P.category_rule_leakage(scored), P.top_findings(scored)):
        assert table.count() == 0
    assert P.alert_digest(P.executive_summary(empty, scored), scored).count() == 0
    assert P.kpi_tiles(P.executive_summary(empty, scored)).count() == 7
