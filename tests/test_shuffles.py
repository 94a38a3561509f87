"""What Rule 1 and the flag table send through shuffles: whole rows once, and only rows that can be flagged."""

from __future__ import annotations

import datetime as dt
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F
from rule_rows import MONDAY, base_row, ids

from overspend.operators import detect as D
from overspend.operators import rules as R
from overspend.sources.fixtures import fixture_transactions


def rows_of(n: int) -> list[dict]:
    """Amounts that recur for some suppliers, ids that are null, empty or there twice."""
    names = {2: None, 6: None, 10: "", 3: "t1", 7: "t1"}
    return [
        base_row(
            transaction_id=names.get(k, f"t{k}"),
            supplier_id=f"s{k % 3}",
            date=MONDAY + dt.timedelta(days=k % 5),
            invoice_amount=[0.2, -0.2, 70.0, 81.0 + k][k % 4],
            baseline_rate=50.0,
        )
        for k in range(n)
    ]


def test_only_suppliers_and_amounts_that_recur_stay(make_tx):
    rows = rows_of(40)
    key = Counter((r["supplier_id"], float(round(r["invoice_amount"]))) for r in rows)  # 0.0 and -0.0 are one amount
    want = sorted(str(r["transaction_id"]) for r in rows if key[r["supplier_id"], float(round(r["invoice_amount"]))] > 1)
    kept = R.recurring(R._keyed(make_tx(rows)).select(*R.KEY, "transaction_id"))
    assert sorted(str(r["transaction_id"]) for r in kept.collect()) == want
    assert 0 < len(want) < len(rows)


@pytest.mark.parametrize("window", [0, 1, 30])
def test_both_forms_of_the_rule_agree(make_tx, window):
    tx = make_tx(rows_of(60)).withColumn("transaction_id", F.coalesce("transaction_id", F.lit("none")))
    assert ids(R.detect_duplicates(tx, window)) == ids(R.detect_duplicates_pairwise(tx, window)) != []


@pytest.mark.parametrize("id_type", ["string", "int"])
def test_flag_table_with_null_and_repeated_ids(make_tx, id_type):
    # null is an id, and not the empty one; other types of ids work too
    tx = make_tx(rows_of(24))
    if id_type == "int":
        tx = tx.withColumn("transaction_id", F.expr("try_cast(substring(transaction_id, 2) AS int)"))
    flags = D.all_flags(tx)
    assert dict(flags.dtypes)["transaction_id"] == id_type and flags.columns == D.all_flags_union(tx).columns
    key = ["transaction_id", "rule_triggered", "date", "leakage_amount_gbp", "rule_detail"]
    got = sorted(map(str, flags.select(*key).collect()))
    per_id = Counter((r["transaction_id"], r["rule_triggered"]) for r in flags.collect())
    assert set(per_id.values()) == {1}
    union = Counter((r["transaction_id"], r["rule_triggered"]) for r in D.all_flags_union(tx).collect())
    assert per_id == union and len(got) == len(union)
    assert any(i is None for i, _ in per_id)
    if id_type == "string":
        assert any(i == "" for i, _ in per_id)


def test_the_flag_table_deals_whole_rows_once(make_tx):
    plan = D.all_flags(make_tx(rows_of(8)))._jdf.queryExecution().executedPlan().toString()
    dealt = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line]
    assert dealt and not [line for line in dealt if "rule_triggered" in line]


def test_the_pairwise_form_reads_rows_that_recur_only(make_tx):
    plan = R.detect_duplicates_pairwise(make_tx(rows_of(8)), 30)._jdf.queryExecution().optimizedPlan().toString()
    # the rows are read three times and counted before each
    assert plan.count("Filter (_rows") >= 3


@pytest.mark.parametrize("words", [1, 1 << 20])
def test_rows_without_a_finding_are_not_dealt(make_tx, monkeypatch, words):
    # 8 rows of one supplier and amount are flagged, 300 others are not; with one word of bits most others pass, and the join drops them
    monkeypatch.setattr(D, "FOLDED_WORDS", words)
    late = {"actual_delivery_date": MONDAY + dt.timedelta(days=90)}
    names = [None, None, "", *[f"t{k}" for k in range(5)]]
    rows = [base_row(transaction_id=names[k], supplier_id="s", invoice_amount=70.0, baseline_rate=70.0) for k in range(8)]
    rows += [base_row(transaction_id=f"u{k}", supplier_id=f"s{k}", invoice_amount=70.0, baseline_rate=70.0) for k in range(300)]
    rows += [base_row(transaction_id="v", supplier_id="late", invoice_amount=70.0, baseline_rate=70.0, **late)]
    tx = make_tx(rows)
    got = Counter((r["transaction_id"], r["rule_triggered"]) for r in D.all_flags(tx).collect())
    assert got == Counter((r["transaction_id"], r["rule_triggered"]) for r in D.all_flags_union(tx).collect())
    assert (None, "duplicate") in {(i, r.lower()) for i, r in got} and ("v" in {i for i, _ in got})

    def by_id(df, name):
        return df.withColumns({"_known": F.coalesce(F.col(name), F.lit("")), "_unknown": F.col(name).isNull()})

    flagged = by_id(R.duplicate_ids(tx, 30), "_flagged_id").select("_known", "_unknown")
    met = [r["transaction_id"] for r in D._may_hit(by_id(tx, "transaction_id"), flagged, R.sla_hit(2)).collect()]
    assert {None, "v", *(n for n in names[3:] if n)} - {"t0"} <= set(met)
    assert len(met) < 20 if words > 1 else len(met) <= len(rows)
    assert set(flagged.columns) == {"_known", "_unknown"}


def test_the_rows_of_rule_1_are_dealt_alike_for_all_their_uses(make_tx):
    # the flag table reads them four times; a condition that only one use has would make another shuffle of them
    plan = D.all_flags(make_tx(rows_of(8)))._jdf.queryExecution().optimizedPlan().toString()
    assert "shiftright" in plan and "isnotnull(shiftright" not in plan and "isnotnull((shiftright" not in plan


def test_count_and_rows_of_rule_1_need_the_same_columns_of_a_join(spark, tmp_path):
    # so the shuffle for the join that makes the transactions is one for both
    tables = {
        "lineitem": "1L l_orderkey, 2L l_partkey, 3L l_suppkey, 1 l_linenumber, 70d l_extendedprice, 0d l_discount, 0d l_tax, timestamp_ntz'2031-03-03' l_shipdate",
        "supplier": "3L s_suppkey, 's' s_name, 4 s_nationkey",
        "part": "2L p_partkey, 'PROMO' p_type",
        "nation": "4 n_nationkey, 5 n_regionkey",
        "region": "5 r_regionkey, 'r' r_name",
    }
    for name, row in tables.items():
        one = spark.sql(f"SELECT {row}")
        (one.union(one) if name == "lineitem" else one).write.parquet(str(tmp_path / f"{name}.parquet"))
    kept = R.recurring(R._keyed(fixture_transactions(spark, str(tmp_path))).select(*R.KEY, "transaction_id"))
    lines = kept._jdf.queryExecution().optimizedPlan().toString().splitlines()
    below = [re.sub(r"#\d+L?", "", lines[k + 1]).lstrip(" :+-") for k, line in enumerate(lines) if "Join Inner" in line and "p_partkey" in line]
    assert len(below) == 2 and len(set(below)) == 1, below
    assert [r["transaction_id"] for r in kept.collect()] == ["1-1-2-3-20310303"] * 2
