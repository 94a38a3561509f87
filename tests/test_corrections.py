"""Late rows of the spike monitor: set aside, counted in, verdicts corrected."""

from __future__ import annotations

import datetime as dt
import os

import pytest
from rule_rows import MONDAY, base_row

from overspend.config import DetectionParams
from overspend.operators import rules as R
from overspend.sources.transactions import TRANSACTION_SCHEMA
from overspend.streaming.corrections import VERDICTS, close_all_days, judge_batch, late_rows, standing_verdicts, start_corrected_spike_monitor

P = DetectionParams(rolling_window=5)


def _rows(day: int, n: int, mark: str = "") -> list[dict]:
    return [base_row(transaction_id=f"{mark}{day}-{k}", date=MONDAY + dt.timedelta(days=day)) for k in range(n)]


@pytest.fixture
def parts():
    """Three batches in date order; the last one also has rows of two days long closed."""
    of = [[], [], []]
    for day in range(30):
        of[day // 10] += _rows(day, 4 + day * 7 % 3 + (20 if day == 24 else 0))
    of[1] += [base_row(transaction_id="undated", date=None), *_rows(4000, 1, "future")]
    of[2] += _rows(8, 25, "late") + _rows(11, 3, "late")
    return of


def _values(df):
    return {r["date"]: (r["daily_count"], r["is_spike"], round(r["rolling_mean"] or 0, 9), round(r["rolling_std"] or 0, 9)) for r in df.collect()}


def _all(spark, out):
    return spark.read.schema(VERDICTS).parquet(os.path.join(out, "verdicts"))


def test_corrected_verdicts_equal_the_batch_rule(spark, make_tx, parts, tmp_path):
    out = str(tmp_path / "out")
    for k, rows in enumerate(parts):
        judge_batch(make_tx(rows), k, out, P, lateness_days=1)
        so_far = _values(R.volume_baseline(make_tx(sum(parts[: k + 1], [])), P))
        stands = _values(standing_verdicts(spark, out))
        assert len(stands) >= 10 * k + 3 and all(so_far[d] == v for d, v in stands.items())
    late = sorted(r["transaction_id"] for r in late_rows(spark, out, TRANSACTION_SCHEMA).collect())
    assert late == sorted(r["transaction_id"] for r in _rows(8, 25, "late") + _rows(11, 3, "late"))

    old = {r["date"]: r["is_spike"] for r in _all(spark, out).filter("change = 'retracted'").collect()}
    spike_day = MONDAY + dt.timedelta(days=8)
    assert old[spike_day] is False and _values(standing_verdicts(spark, out))[spike_day][1] is True
    # only a day that got rows, or has one in its baseline, is corrected
    assert {(d - MONDAY).days for d in old} <= set(range(8, 17))

    close_all_days(spark, out, P)
    assert _values(standing_verdicts(spark, out)) == _values(R.volume_baseline(make_tx(sum(parts, [])), P))


def test_replay_changes_nothing(spark, make_tx, parts, tmp_path):
    out = str(tmp_path / "out")
    for k, rows in enumerate(parts):
        judge_batch(make_tx(rows), k, out, P, lateness_days=1)
    before = sorted(map(str, _all(spark, out).collect()))
    for k in (1, 2):
        judge_batch(make_tx(parts[k]), k, out, P, lateness_days=1)
    assert sorted(map(str, _all(spark, out).collect())) == before
    assert late_rows(spark, out, TRANSACTION_SCHEMA).count() == 28


def test_rows_after_the_closing_run(spark, make_tx, parts, tmp_path):
    out = str(tmp_path / "out")
    judge_batch(make_tx(parts[0]), 0, out, P)
    close_all_days(spark, out, P)
    more = _rows(9, 30, "more")
    judge_batch(make_tx(more), 1, out, P)
    assert late_rows(spark, out, TRANSACTION_SCHEMA).count() == 30
    assert _values(standing_verdicts(spark, out)) == _values(R.volume_baseline(make_tx(parts[0] + more), P))


def test_empty_and_undated_batches(spark, make_tx, tmp_path):
    out = str(tmp_path / "out")
    judge_batch(make_tx([]), 0, out, P)
    judge_batch(make_tx([base_row(date=None)]), 1, out, P)
    close_all_days(spark, out, P)
    assert standing_verdicts(spark, out).count() == 0 and late_rows(spark, out, TRANSACTION_SCHEMA).count() == 0


def test_stream_with_a_late_file(spark, make_tx, parts, tmp_path):
    folder, out = str(tmp_path / "landing"), str(tmp_path / "out")
    for k, rows in enumerate(parts):
        make_tx(rows).coalesce(1).write.mode("append").parquet(folder)
        stream = spark.readStream.schema(TRANSACTION_SCHEMA).parquet(folder)
        start_corrected_spike_monitor(stream, out, str(tmp_path / "checkpoint"), P, lateness_days=1).awaitTermination()
    close_all_days(spark, out, P)
    assert late_rows(spark, out, TRANSACTION_SCHEMA).count() == 28
    assert _values(standing_verdicts(spark, out)) == _values(R.volume_baseline(make_tx(sum(parts, [])), P))
