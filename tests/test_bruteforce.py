"""Rule 1 against a brute-force pairwise definition on random small frames.

The brute force is the rule as stated: within each (supplier, amount rounded
half-even to a unit) group, in (date, id) order, a row is flagged when any
earlier row lies at most ``window_days`` before it.  Compared with both Spark
formulations (aggregate + join, interval semi-join) and the single-scan flag
table, in its broadcast and its shuffle plan.
"""

from __future__ import annotations

import datetime as dt
import random

import numpy as np
import pytest
from rule_rows import base_row, ids

from overspend.operators import detect as D
from overspend.operators import rules as R


def brute_force(rows: list[dict], window_days: int) -> list[str]:
    groups: dict = {}
    for r in rows:
        if r["supplier_id"] is None or r["invoice_amount"] is None or r["date"] is None:
            continue
        key = (r["supplier_id"], float(np.rint(r["invoice_amount"])))
        groups.setdefault(key, []).append(r)
    flagged = set()
    for members in groups.values():
        members.sort(key=lambda r: (r["date"], r["transaction_id"]))
        for j in range(len(members)):
            for i in range(j):
                if abs((members[j]["date"] - members[i]["date"]).days) <= window_days:
                    flagged.add(members[j]["transaction_id"])
    return sorted(flagged)


def random_rows(seed: int, n: int) -> list[dict]:
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        rows.append(base_row(
            transaction_id=f"T{rnd.randrange(10**6):06d}-{i}",
            date=None if rnd.random() < 0.03 else dt.date(2024, 1, 1) + dt.timedelta(days=rnd.randrange(20)),
            supplier_id=None if rnd.random() < 0.03 else f"S{rnd.randrange(4)}",
            invoice_amount=None if rnd.random() < 0.03 else rnd.choice([99.5, 100.4, 100.5, 100.6, 101.5, 250.0, 250.49]),
        ))
    return rows


@pytest.mark.parametrize("seed,window_days", [(1, 1), (2, 0), (3, 2), (4, 5)])
def test_duplicates_equal_brute_force(make_tx, seed, window_days):
    rows = random_rows(seed, 120)
    want = brute_force(rows, window_days)
    tx = make_tx(rows)
    assert ids(R.detect_duplicates(tx, window_days)) == want
    assert ids(R.detect_duplicates_pairwise(tx, window_days)) == want
    from overspend.config import DetectionParams

    p = DetectionParams(window_days=window_days)
    assert ids(D.all_flags(tx, p).filter("rule_triggered = 'duplicate'")) == want


def flagged_ids(rows, window_days):
    """The ids that the rule flags: pairs of rows in (date, id) order, nulls first."""
    groups: dict = {}
    for r in rows:
        if r["supplier_id"] is not None and r["invoice_amount"] is not None and r["date"] is not None:
            groups.setdefault((r["supplier_id"], float(np.rint(r["invoice_amount"]))), []).append(r)
    flagged = set()
    for members in groups.values():
        members.sort(key=lambda r: (r["date"], r["transaction_id"] is not None, r["transaction_id"] or ""))
        for j, later in enumerate(members):
            if any(abs((later["date"] - m["date"]).days) <= window_days for m in members[:j]):
                flagged.add(later["transaction_id"])
    return flagged


@pytest.mark.parametrize("seed,window_days", [(1, 1), (2, 0), (3, 3)])
def test_repeated_ids_equal_brute_force(make_tx, seed, window_days):
    """Ids that repeat (some null): every row of a flagged id is flagged, one is kept."""
    rnd = random.Random(seed)
    rows = [dict(r, transaction_id=rnd.choice([None, *(f"R{k:02d}" for k in range(40))])) for r in random_rows(seed, 100)]
    want = flagged_ids(rows, window_days)
    tx = make_tx(rows)
    every = sorted(str(r["transaction_id"]) for r in rows if r["transaction_id"] in want)
    for rule in (R.detect_duplicates, R.detect_duplicates_pairwise):
        assert sorted(str(r["transaction_id"]) for r in rule(tx, window_days).collect()) == every
    from overspend.config import DetectionParams

    p = DetectionParams(window_days=window_days)
    for plan in (D.all_flags, D.all_flags_union):
        kept = plan(tx, p).filter("rule_triggered = 'duplicate'").collect()
        assert sorted(str(r["transaction_id"]) for r in kept) == sorted(map(str, want))
        by_id = {r["transaction_id"]: r for r in kept}
        for i in want:  # the earliest row stays
            dates = [r["date"] for r in rows if r["transaction_id"] == i and r["date"] is not None]
            assert by_id[i]["date"] == min(dates)


def test_the_same_row_twice(make_tx):
    same = base_row(transaction_id="T9")
    next_day = dict(same, date=same["date"] + dt.timedelta(days=1))
    nameless = dict(same, transaction_id=None)
    for rows, rule_rows, kept in (([same, same], 2, 1), ([same, next_day], 2, 1), ([nameless, nameless, same], 3, 2)):
        tx = make_tx(rows)
        assert R.detect_duplicates(tx).count() == R.detect_duplicates_pairwise(tx).count() == rule_rows
        assert D.all_flags(tx).filter("rule_triggered = 'duplicate'").count() == kept


@pytest.mark.parametrize("window_days", [30, 365])
def test_wide_windows_equal_brute_force(make_tx, window_days):
    """Two bins per row give the same as every pair of days, and as the window form."""
    rnd = random.Random(window_days)
    rows = [dict(r, date=dt.date(2020, 1, 1) + dt.timedelta(days=rnd.randrange(3000)), invoice_amount=rnd.choice([100.4, 250.0])) for r in random_rows(7, 90)]
    want, tx = brute_force(rows, window_days), make_tx(rows)
    assert 0 < len(want) < len(rows)
    assert ids(R.detect_duplicates_pairwise(tx, window_days)) == want == ids(R.detect_duplicates(tx, window_days))
