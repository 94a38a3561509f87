"""Streaming operators against the batch rules on the same rows, fed in date
order as a sequence of files."""

from __future__ import annotations

import datetime as dt
import os
import tempfile

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from rule_rows import SF_SMALL, base_row

from overspend.operators import rules as R
from overspend.sources.fixtures import fixture_transactions
from overspend.sources.transactions import TRANSACTION_SCHEMA
from overspend.operators.detect import all_flags
from overspend.operators.score import score_flags
from overspend.streaming.jobs import close_days, flag_duplicates_batch, run_incremental, start_duplicate_monitor, start_spike_monitor
from overspend.streaming.rules import stream_daily_counts, stream_row_flags


@pytest.fixture(scope="module")
def landing(spark):
    """The sf0.001 fixture written as one file per quarter, oldest first."""
    tx = fixture_transactions(spark, SF_SMALL)
    pdf = tx.toPandas()
    folder = tempfile.mkdtemp(prefix="overspend-landing-")
    quarters = sorted({(d.year, (d.month - 1) // 3) for d in pdf["date"]})
    arrow_types = {"string": pa.string(), "date": pa.date32(), "double": pa.float64(), "boolean": pa.bool_()}
    schema = pa.schema([(f.name, arrow_types[f.dataType.simpleString()]) for f in TRANSACTION_SCHEMA.fields])
    for i, (y, q) in enumerate(quarters):
        part = pdf[[(d.year, (d.month - 1) // 3) == (y, q) for d in pdf["date"]]]
        path = os.path.join(folder, f"part-{i:04d}.parquet")
        pq.write_table(pa.Table.from_pandas(part, schema=schema, preserve_index=False), path)
        os.utime(path, (1_700_000_000 + i, 1_700_000_000 + i))
    return tx, folder


def _stream(spark, folder, files=6):
    return spark.readStream.schema(TRANSACTION_SCHEMA).option("maxFilesPerTrigger", files).parquet(folder)


def _memory(df, name):
    q = df.writeStream.format("memory").queryName(name).outputMode("append").trigger(availableNow=True).start()
    q.awaitTermination()
    return df.sparkSession.table(name)


def _pairs(df):
    return sorted((str(r[0]), r[1]) for r in df.select("transaction_id", "rule_triggered").collect())


def test_stream_row_flags_equal_batch(spark, landing):
    tx, folder = landing
    got = _memory(stream_row_flags(_stream(spark, folder)), "row_flags")
    want = all_flags(tx).filter("rule_triggered IN ('price_variance', 'sla_breach')")
    cols = ["transaction_id", "rule_triggered", "rule_detail", "leakage_amount_gbp", "breach_days"]
    assert sorted(map(str, got.select(*cols).collect())) == sorted(map(str, want.select(*cols).collect()))


@pytest.mark.parametrize("zone", ["UTC", "America/New_York", "Asia/Kolkata"])
def test_daily_counts_in_any_time_zone(spark, landing, zone):
    tx, folder = landing
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        got = {r["date"]: r["daily_count"] for r in _memory(stream_daily_counts(_stream(spark, folder)), f"days_{zone[:3]}").collect()}
        want = {r["date"]: r["daily_count"] for r in R.daily_counts(tx).collect()}
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    assert len(got) >= len(want) - 3  # the last days stay open under the watermark
    assert all(want[d] == n for d, n in got.items())


def test_spike_monitor_judges_closed_days(spark, landing):
    tx, folder = landing
    base = tempfile.mkdtemp(prefix="overspend-spikes-")
    q = start_spike_monitor(_stream(spark, folder), os.path.join(base, "history"), os.path.join(base, "verdicts"),
                            os.path.join(base, "ckpt"))
    q.awaitTermination()
    verdicts = spark.read.parquet(os.path.join(base, "verdicts"))
    batch = {r["date"]: r["is_spike"] for r in R.volume_baseline(tx).collect()}
    rows = verdicts.collect()
    assert len(rows) >= len(batch) - 3  # the last days stay open under the watermark
    assert all(batch[r["date"]] == r["is_spike"] for r in rows)


def test_incremental_run_equals_batch(spark, landing):
    """All four rules over ordered files: the union of the batches is the flag table, and so are the alerts."""
    import json

    tx, folder = landing
    base = tempfile.mkdtemp(prefix="overspend-incr-")
    out, ckpt = os.path.join(base, "out"), os.path.join(base, "ckpt")
    run_incremental(spark, folder, TRANSACTION_SCHEMA, out, ckpt, files_per_batch=10)
    close_days(spark, out, TRANSACTION_SCHEMA)
    got = spark.read.parquet(os.path.join(out, "flags"))
    assert _pairs(got) == _pairs(all_flags(tx))
    run_incremental(spark, folder, TRANSACTION_SCHEMA, out, ckpt)  # nothing new: no change
    assert _pairs(spark.read.parquet(os.path.join(out, "flags"))) == _pairs(got)
    alerts = spark.read.parquet(os.path.join(out, "alerts")).collect()
    critical = score_flags(all_flags(tx)).filter("severity = 'Critical'").count()
    assert sum(r["alert_count"] for r in alerts) == critical > 0
    assert all(json.loads(r["payload"])["top_findings"] == r["top_findings"] for r in alerts)


def _monitor(spark, folder, files=3, **options):
    base = tempfile.mkdtemp(prefix="overspend-dupmon-")
    start_duplicate_monitor(_stream(spark, folder, files), os.path.join(base, "state"), os.path.join(base, "out"),
                            os.path.join(base, "ckpt"), **options).awaitTermination()
    return sorted(r[0] for r in spark.read.parquet(os.path.join(base, "out")).select("transaction_id").collect())


def test_duplicate_monitor_equals_batch(spark, landing):
    tx, folder = landing
    got = _monitor(spark, folder)
    assert got == sorted(r[0] for r in R.detect_duplicates(tx).select("transaction_id").collect()) and len(got) == 142


def _batches(spark, make_tx, batches, window_days=1, horizon_days=3):
    state = tempfile.mkdtemp(prefix="overspend-state-")
    return [
        sorted(str(r[0]) for r in flag_duplicates_batch(make_tx(rows), k, state, window_days, horizon_days).select("transaction_id").collect())
        for k, rows in enumerate(batches)
    ]


def _row(i, day, **more):
    return base_row(transaction_id=i, date=dt.date(2023, 5, 1) + dt.timedelta(days=day), **more)


def test_monitor_keeps_its_state_beside_a_future_date(spark, make_tx):
    first = [_row("A", 0), *[_row(f"x{k}", 0, invoice_amount=10.0 + k) for k in range(4)], _row("late", 27_000, supplier_id="Z")]
    assert _batches(spark, make_tx, [first, [_row("B", 1)]]) == [[], ["B"]]


def test_monitor_with_a_wide_window(spark, make_tx, landing):
    batches = [[_row("A", 0)], [_row("q", 9, supplier_id="Z")], [_row("B", 10)]]
    assert _batches(spark, make_tx, batches, window_days=10, horizon_days=12) == [[], [], ["B"]]
    with pytest.raises(ValueError, match="window_days"):
        start_duplicate_monitor(_stream(spark, landing[1]), "s", "o", "c", window_days=10, horizon_days=7)


def test_monitor_replays_a_batch(spark, make_tx):
    state = tempfile.mkdtemp(prefix="overspend-state-")
    flag_duplicates_batch(make_tx([_row("A", 0)]), 0, state, 1, 3)
    for _ in range(2):  # the same batch again: the same flags, the same state
        got = flag_duplicates_batch(make_tx([_row("B", 1)]), 1, state, 1, 3)
        assert [r["transaction_id"] for r in got.collect()] == ["B"]
    assert spark.read.parquet(os.path.join(state, "batch_id=1")).count() == 2


def test_monitor_with_repeated_ids_and_one_key(spark, make_tx):
    assert _batches(spark, make_tx, [[_row("A", 0), _row("A", 0)], [_row("A", 0)], [_row("A", 1)]]) == [["A", "A"], ["A"], ["A"]]
    hot = [_row(f"T{k:04d}", k // 100) for k in range(600)]  # every row has one key
    got = _batches(spark, make_tx, [hot[:250], hot[250:]])
    assert sorted(got[0] + got[1]) == sorted(r["transaction_id"] for r in hot[1:])


def test_event_stream_duplicates_equal_batch(spark):
    """The events table (natural near-duplicates) streamed day by day."""
    from overspend.sources.fixtures import event_transactions

    ev = event_transactions(spark, SF_SMALL)
    pdf = ev.toPandas()
    folder = tempfile.mkdtemp(prefix="overspend-events-")
    arrow_types = {"string": pa.string(), "date": pa.date32(), "double": pa.float64(), "boolean": pa.bool_()}
    schema = pa.schema([(f.name, arrow_types[f.dataType.simpleString()]) for f in TRANSACTION_SCHEMA.fields])
    for i, day in enumerate(sorted(set(pdf["date"]))):
        path = os.path.join(folder, f"part-{i:04d}.parquet")
        pq.write_table(pa.Table.from_pandas(pdf[pdf["date"] == day], schema=schema, preserve_index=False), path)
        os.utime(path, (1_700_000_000 + i, 1_700_000_000 + i))
    want = sorted(r[0] for r in R.detect_duplicates(ev).select("transaction_id").collect())
    assert _monitor(spark, folder, files=8) == want
    assert len(want) == 32


# --- state over batches ----------------------------------------------------------------------

def _land(spark, folder, k, rows):
    """One file of rows, the ``k``-th to arrive."""
    types = {"string": pa.string(), "date": pa.date32(), "double": pa.float64(), "boolean": pa.bool_()}
    schema = pa.schema([(f.name, types[f.dataType.simpleString()]) for f in TRANSACTION_SCHEMA.fields])
    path = os.path.join(folder, f"day-{k:04d}.parquet")
    pq.write_table(pa.Table.from_pylist(rows, schema=schema), path)
    os.utime(path, (1_700_000_000 + k, 1_700_000_000 + k))


def _repeating_days():
    """Rows in date order whose ids come again, in the same batch and in later ones."""
    late = {"expected_delivery_date": dt.date(2023, 5, 1), "actual_delivery_date": dt.date(2023, 5, 9)}
    first = [_row("A", 0), _row("B", 0, supplier_id="s2", **late), _row("C", 0, supplier_id="s3", invoice_amount=500.0), _row("D", 0, supplier_id="s4")]
    second = [_row("A", 1), _row("B", 1, supplier_id="s5", invoice_amount=900.0, **late), _row("C", 1, supplier_id="s6"), _row("E", 1, supplier_id="s7")]
    third = [_row("C", 2, supplier_id="s8", invoice_amount=700.0), _row("F", 2, supplier_id="s4", **late), _row("E", 2, supplier_id="s7"), _row("E", 2, supplier_id="s7"),
             _row(None, 2, supplier_id="s9", **late)]
    fourth = [_row(None, 3, supplier_id="sA", **late), _row("G", 3, supplier_id="sB", invoice_amount=400.0), _row("D", 3, supplier_id="sC", invoice_amount=90.0)]
    return [first, second, third, fourth]


def _summary(df):
    return [tuple(r) for r in df.collect()]


def test_findings_are_given_once_over_all_batches(spark, make_tx):
    """After every batch the findings so far, and the stored summary, are those of all rows so far."""
    from overspend.operators import report as P
    from overspend.streaming.jobs import detect_batch

    out, seen = tempfile.mkdtemp(prefix="overspend-once-"), []
    flags = os.path.join(out, "flags")
    for k, rows in enumerate(_repeating_days()):
        seen += rows
        for _ in range(2 if k == 2 else 1):  # a replayed batch changes nothing
            detect_batch(make_tx(rows), k, out)
        so_far = make_tx(seen)
        want = all_flags(so_far)
        cols = ["transaction_id", "rule_triggered", "date", "rule_detail", "leakage_amount_gbp"]
        assert sorted(map(str, spark.read.parquet(flags).select(*cols).collect())) == sorted(map(str, want.select(*cols).collect()))
        stored = spark.read.parquet(os.path.join(out, "summary", f"batch_id={k}"))
        summary = P.executive_summary(so_far, score_flags(want))
        assert stored.columns == summary.columns and _summary(stored) == _summary(summary)
    assert len(want.collect()) == 8


def test_keys_expire(spark, make_tx):
    from overspend.streaming import state
    from overspend.streaming.jobs import detect_batch

    out = tempfile.mkdtemp(prefix="overspend-expiry-")
    dear = {"invoice_amount": 500.0}
    batches = [[_row("A", 0, **dear)], [_row("A", 5, **dear)], [_row("A", 40, **dear)]]
    for k, rows in enumerate(batches):
        detect_batch(make_tx(rows), k, out, repeat_days=10)
    got = spark.read.parquet(os.path.join(out, "flags"))
    assert sorted(str(r["date"]) for r in got.collect()) == ["2023-05-01", "2023-06-10"]  # the second was known, the third long after
    assert state.expire(spark, out, dt.date(2023, 5, 20)) == [0]


def test_incremental_summary_equals_batch(spark, landing):
    from overspend.operators import report as P

    tx, folder = landing
    base = tempfile.mkdtemp(prefix="overspend-sum-")
    out = os.path.join(base, "out")
    run_incremental(spark, folder, TRANSACTION_SCHEMA, out, os.path.join(base, "ckpt"), files_per_batch=14)
    close_days(spark, out, TRANSACTION_SCHEMA)
    last = spark.read.parquet(os.path.join(out, "days")).agg({"batch_id": "max"}).first()[0]
    stored = spark.read.parquet(os.path.join(out, "summary", f"batch_id={-1 - last}"))
    assert _summary(stored) == _summary(P.executive_summary(tx, score_flags(all_flags(tx))))


def test_csv_landing_rejects_bad_lines(spark, make_tx):
    names = [f.name for f in TRANSACTION_SCHEMA.fields]
    base = tempfile.mkdtemp(prefix="overspend-csv-")
    folder = os.path.join(base, "landing")
    os.mkdir(folder)
    days = _repeating_days()
    for k, rows in enumerate(days):
        lines = [",".join(names)] + [",".join("" if r[n] is None else str(r[n]) for n in names) for r in rows]
        if k == 1:
            lines.insert(2, lines[1].replace("2023-05-02", "02.05.23", 1).replace(str(rows[0]["expected_delivery_date"]), "soon", 1))
            lines.append("X,2023-05-02,short")
        if k == 2:
            lines.append(lines[1].replace("700.0", "seven", 1).replace("C", "H", 1))  # a bad number is no reject
        path = os.path.join(folder, f"day-{k}.csv")
        with open(path, "w") as f:
            f.write("\n".join(lines) + "\n")
        os.utime(path, (1_700_000_000 + k, 1_700_000_000 + k))
    out = os.path.join(base, "out")
    run_incremental(spark, folder, TRANSACTION_SCHEMA, out, os.path.join(base, "ckpt"), files_per_batch=1, fmt="csv")
    good = make_tx([r for rows in days for r in rows] + [_row("H", 2, supplier_id="s8", invoice_amount=None)])
    assert _pairs(spark.read.parquet(os.path.join(out, "flags"))) == _pairs(all_flags(good))
    rejects = spark.read.parquet(os.path.join(out, "rejects")).collect()
    assert sorted((str(r["column"]), r["reason"]) for r in rejects) == [
        ("None", "not as many values as columns"), ("date", "unparseable date: 02.05.23"), ("expected_delivery_date", "unparseable date: soon"),
    ]
    assert {r["line"] for r in rejects if r["column"] is None} == {"X,2023-05-02,short"} and all("02.05.23" in r["line"] for r in rejects if r["column"])
    from overspend.sources.transactions import read_transactions

    with pytest.raises(Exception, match="unparseable date"):  # the batch reader stays strict
        read_transactions(spark, os.path.join(folder, "day-1.csv")).select("date", "expected_delivery_date").collect()
    with pytest.raises(ValueError):
        run_incremental(spark, folder, TRANSACTION_SCHEMA, out, "c", fmt="json")
