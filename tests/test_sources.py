"""Loader and sinks: CSV round trip, column check, lenient numbers, strict
dates, pass-through of extra columns, missing paths, report tables."""

from __future__ import annotations

import datetime as dt
import os
import tempfile

import pytest
from rule_rows import SF_SMALL, base_row
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from overspend.config import ReportParams
from overspend.operators import detect as D
from overspend.operators import report as P
from overspend.operators.score import score_flags
from overspend.sources.fixtures import fixture_transactions
from overspend.sources.sinks import write_csv, write_partitioned, write_report
from overspend.sources.transactions import coerce_transactions, load_profile, read_transactions


def _csv(tmp: str, header: str, lines: list[str]) -> str:
    path = os.path.join(tmp, "tx.csv")
    with open(path, "w") as fh:
        fh.write(header + "\n" + "\n".join(lines) + "\n")
    return path


HEADER = "transaction_id,date,supplier_id,supplier_name,category,baseline_rate,invoice_amount,expected_delivery_date,actual_delivery_date,extra_col"


def test_csv_round_trip(spark, make_tx):
    tx = make_tx([base_row(transaction_id=f"T{i}", date=dt.date(2024, 1, 1 + i)) for i in range(5)])
    out = os.path.join(tempfile.mkdtemp(prefix="overspend-csv-"), "tx")
    write_csv(tx, out)
    back = read_transactions(spark, out, "csv")
    assert back.count() == 5
    assert dict(back.dtypes)["date"] == "date" and dict(back.dtypes)["invoice_amount"] == "double"
    assert dict(back.dtypes)["is_anomaly"] == "boolean"
    assert sorted(r["transaction_id"] for r in back.collect()) == [f"T{i}" for i in range(5)]


def test_missing_required_column(spark):
    df = spark.createDataFrame([("T1", "2024-01-01")], "transaction_id string, date string")
    with pytest.raises(ValueError, match="supplier_id"):
        coerce_transactions(df)


def test_bad_number_becomes_null_extra_column_passes(spark):
    path = _csv(tempfile.mkdtemp(), HEADER, [
        "T1,2024-01-01,S1,N,C,100,abc,2024-01-02,2024-01-03,x",
        "T2,2024-01-01,S1,N,C,NaN,120.5,2024-01-02,2024-01-03,y",
    ])
    rows = {r["transaction_id"]: r for r in read_transactions(spark, path).collect()}
    assert rows["T1"]["invoice_amount"] is None and rows["T1"]["baseline_rate"] == 100.0
    assert rows["T2"]["baseline_rate"] is None and rows["T2"]["invoice_amount"] == 120.5
    assert rows["T1"]["extra_col"] == "x"


def test_infinite_amounts_are_no_amounts(spark):
    path = _csv(tempfile.mkdtemp(), HEADER, ["T1,2024-01-01,S1,N,C,inf,-Infinity,2024-01-02,2024-01-03,x"])
    row = read_transactions(spark, path).first()
    assert row["invoice_amount"] is None and row["baseline_rate"] is None


def test_a_busy_day_is_split_into_files(spark):
    """One date, several tasks and files; and the CSV is ordered by (date, id)."""
    base = tempfile.mkdtemp(prefix="overspend-busy-")
    day = spark.range(300_000).select(F.lit("2023-02-03").cast("date").alias("date"), F.sha2(F.col("id").cast("string"), 256).alias("transaction_id"))
    old = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "1m")
    try:
        write_partitioned(day, os.path.join(base, "tx"))
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", old)
    files = [f for f in os.listdir(os.path.join(base, "tx", "date=2023-02-03")) if f.endswith(".parquet")]
    assert len(files) > 1
    tx = fixture_transactions(spark, SF_SMALL).select("transaction_id", "date")
    write_csv(tx, os.path.join(base, "csv"))
    lines = []
    for f in sorted(f for f in os.listdir(os.path.join(base, "csv")) if f.endswith(".csv")):
        lines += [tuple(x.strip().split(",")[::-1]) for x in open(os.path.join(base, "csv", f)).readlines()[1:]]
    assert len(lines) == tx.count() and lines == sorted(lines)


def test_report_tables_hold_their_operators(spark):
    tx = fixture_transactions(spark, SF_SMALL)
    scored = score_flags(D.all_flags(tx))
    base = tempfile.mkdtemp(prefix="overspend-report-")
    written = write_report(tx, scored, base, ReportParams(detail_limit=25))

    def rows(df):
        return sorted(str(r) for r in df.collect())

    assert rows(spark.read.parquet(written["summary/rule_share"])) == rows(P.rule_share(scored))
    assert rows(spark.read.parquet(written["statistics/daily_trend"])) == rows(P.daily_trend(scored))
    detail = spark.read.parquet(written["flagged/flagged_items"])
    assert detail.count() == 25 and rows(detail) == rows(P.flagged_items(scored, 25))
    assert not scored.is_cached


def test_bad_date_is_an_error(spark):
    path = _csv(tempfile.mkdtemp(), HEADER, ["T1,not-a-date,S1,N,C,100,100,2024-01-02,2024-01-03,x"])
    with pytest.raises(Exception, match="unparseable date"):
        read_transactions(spark, path).collect()


def test_missing_path(spark):
    with pytest.raises(AnalysisException):
        read_transactions(spark, "/nonexistent/overspend/tx.csv").count()


def test_load_profile(spark):
    p = load_profile(fixture_transactions(spark, SF_SMALL)).first()
    assert p["total_transactions"] == 6142


def test_partitioned_sink_and_report(spark):
    tx = fixture_transactions(spark, SF_SMALL)
    base = tempfile.mkdtemp(prefix="overspend-sink-")
    write_partitioned(tx.select("transaction_id", "date", "invoice_amount"), os.path.join(base, "tx"))
    assert spark.read.parquet(os.path.join(base, "tx")).count() == 6142
    scored = score_flags(D.all_flags(tx))
    written = write_report(tx, scored, os.path.join(base, "report"))
    assert set(written) >= {"summary/executive_summary", "flagged/flagged_items", "statistics/daily_trend"}
    assert spark.read.parquet(written["flagged/flagged_items"]).count() == scored.count()


def test_materialized_table_gives_same_flags(spark):
    """Production flow: write transactions partitioned by date, read back, detect."""
    tx = fixture_transactions(spark, SF_SMALL)
    path = os.path.join(tempfile.mkdtemp(prefix="overspend-mat-"), "tx")
    write_partitioned(tx, path)
    back = read_transactions(spark, path)
    assert dict(back.dtypes)["date"] == "date" and back.count() == tx.count()

    def rows(df):
        return sorted(tuple(str(v) for v in r) for r in df.select(sorted(df.columns)).collect())

    assert rows(D.all_flags(back.select(*tx.columns))) == rows(D.all_flags(tx))


def test_a_delivered_day_replaces_itself_alone(spark, make_tx, tmp_path):
    from overspend.sources.sinks import replace_days

    def files():
        return {os.path.relpath(os.path.join(d, f), path): open(os.path.join(d, f), "rb").read() for d, _, fs in os.walk(path) for f in fs if f.endswith(".parquet")}

    path = str(tmp_path / "table")
    rows = [base_row(transaction_id=f"T{i}", date=dt.date(2024, 1, 1 + i % 3)) for i in range(9)]
    write_partitioned(make_tx(rows), path)
    old = files()
    again = [base_row(transaction_id=f"N{i}", date=dt.date(2024, 1, 2)) for i in range(2)]
    replace_days(make_tx(again), path)
    kept = {k: v for k, v in old.items() if "2024-01-02" not in k}
    assert {k: v for k, v in files().items() if "2024-01-02" not in k} == kept and len(kept) >= 2
    got = spark.read.parquet(path)
    assert sorted(r[0] for r in got.select("transaction_id").collect()) == sorted(["N0", "N1", *[r["transaction_id"] for r in rows if r["date"].day != 2]])
