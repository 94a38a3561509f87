"""Rule 1 over bucketed tables: the same flags, and no shuffle of transactions."""

from __future__ import annotations

import datetime as dt
import re

import pytest
from rule_rows import MONDAY, SF_SMALL, base_row

from overspend.config import DEFAULT_DETECTION
from overspend.operators.detect import dedupe_flags, normalize_flags
from overspend.operators.rules import detect_duplicates
from overspend.sources.bucketed import duplicate_flags_bucketed, keys_table, write_bucketed
from overspend.sources.fixtures import fixture_transactions


def _flags(tx, window_days):
    return dedupe_flags(normalize_flags(detect_duplicates(tx, window_days), tx.columns))


def _rows(df):
    return sorted(map(str, df.collect()))


@pytest.fixture
def tables(spark, tmp_path):
    """Writes bucketed tables and drops them after the test."""
    names = []

    def write(tx, name, **options):
        write_bucketed(tx, name, str(tmp_path), **options)
        names.extend([name, keys_table(name)])

    yield write
    for name in names:
        spark.sql(f"DROP TABLE IF EXISTS {name}")


def _odd(make_tx):
    """One supplier with most rows; repeated ids, null ids, null keys, ties on a day."""
    rows = [
        base_row(transaction_id=f"t{k % 150}", date=MONDAY + dt.timedelta(days=k * 7 % 60), supplier_id="hot" if k % 3 else f"s{k % 11}",
                 invoice_amount=float(80 + k % 13))
        for k in range(200)
    ]
    rows += [base_row(transaction_id=None, invoice_amount=80.0 + k % 2) for k in range(5)]
    rows += [base_row(transaction_id="n1", supplier_id=None), base_row(transaction_id="n2", date=None), base_row(transaction_id="n3", invoice_amount=None)]
    return make_tx(rows)


@pytest.mark.parametrize("window_days", [-1, 0, 7, 40])
def test_flags_equal_those_of_the_plain_table(spark, make_tx, tables, window_days):
    tx = _odd(make_tx)
    tables(tx, "odd_tx", buckets=3)
    got = _rows(duplicate_flags_bucketed(spark, "odd_tx", window_days))
    assert got == _rows(_flags(tx, window_days)) and bool(got) == (window_days >= 0)


def test_fixture_and_empty_table(spark, make_tx, tables):
    tx = fixture_transactions(spark, SF_SMALL)
    tables(tx, "fixture_tx")
    assert _rows(duplicate_flags_bucketed(spark, "fixture_tx")) == _rows(_flags(tx, DEFAULT_DETECTION.window_days))
    tables(make_tx([]), "empty_tx")
    assert duplicate_flags_bucketed(spark, "empty_tx").count() == 0


def _below(lines, k):
    """The lines of the subtree under line ``k`` of a plan."""
    depth = [len(re.match(r"^[\s:+|*()\d-]*", x).group()) for x in lines]
    end = k + 1
    while end < len(lines) and depth[end] > depth[k]:
        end += 1
    return lines[k + 1 : end]


def test_no_transaction_row_is_shuffled(spark, make_tx, tables):
    tables(_odd(make_tx), "plan_tx")
    old = {c: spark.conf.get(c) for c in ("spark.sql.adaptive.enabled", "spark.sql.autoBroadcastJoinThreshold")}
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = duplicate_flags_bucketed(spark, "plan_tx")._jdf.queryExecution().executedPlan().toString()
    finally:
        for c, v in old.items():
            spark.conf.set(c, v)
    lines = plan.splitlines()
    shuffles = [k for k, x in enumerate(lines) if re.search(r"Exchange hashpartitioning", x) and "ReusedExchange" not in x]
    assert shuffles
    for k in shuffles:
        below = _below(lines, k)
        scans = [x for x in below if "FileScan" in x]
        if any("plan_tx[" in x for x in scans):  # whole rows: only those without an id
            assert any("isnull(transaction_id" in x and "isnotnull(transaction_id" not in x for x in below), plan
        else:  # keys: what moves was aggregated before
            assert any("Aggregate" in x or "Window" in x for x in below[: next(i for i, x in enumerate(below) if "FileScan" in x)]), plan
