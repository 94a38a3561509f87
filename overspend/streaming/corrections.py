"""R3 with late rows: daily spike verdicts that are corrected.

A watermark drops rows that come after their day was closed. Here they go to a
side table, are counted in, and the verdicts that they change are given anew:
the old one is retracted, the new one issued. What stands after any batch is
what the batch rule says of all rows so far on the closed days.

A batch is counted per day with map-side partial aggregation; everything after
that works on one row per calendar day and batch. Tables under ``out_dir``, one
folder per batch in each: counts (rows per day), closing (up to which day),
late (whole rows), verdicts (date, statistics, ``change``: issued or
retracted). A batch reads only what came before it and replaces its own
folders, so a replay changes nothing.
"""

from __future__ import annotations

import datetime as dt
import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import DEFAULT_DETECTION, DetectionParams
from ..operators import rules as R
from .jobs import LATENESS_DAYS, _once, current_day
from .state import batch_dir, before, turn

COUNTS = "date date, daily_count long, batch_id int"
CLOSING = "closed_before date, batch_id int"
STATISTICS = ["daily_count", "rolling_mean", "rolling_std", "upper_bound", "is_spike"]
VERDICTS = "date date, daily_count long, rolling_mean double, rolling_std double, upper_bound double, is_spike boolean, change string, batch_id int"
ISSUED, RETRACTED = "issued", "retracted"


def _table(spark: SparkSession, out_dir: str, name: str, schema: str) -> DataFrame:
    return spark.read.schema(schema).parquet(os.path.join(out_dir, name))


def _write(df: DataFrame, out_dir: str, name: str, batch_id: int) -> None:
    df.write.mode("overwrite").parquet(batch_dir(os.path.join(out_dir, name), batch_id))


def _latest(verdicts: DataFrame) -> DataFrame:
    """The verdict of each day that was issued last."""
    stands = F.max_by(F.struct(*STATISTICS), turn(F.col("batch_id"))).alias("v")
    return verdicts.filter(F.col("change") == ISSUED).groupBy("date").agg(stands).select("date", "v.*")


def standing_verdicts(spark: SparkSession, out_dir: str) -> DataFrame:
    """One row per closed day: the verdict that stands after all batches."""
    return _latest(_table(spark, out_dir, "verdicts", VERDICTS))


def late_rows(spark: SparkSession, out_dir: str, schema) -> DataFrame:
    """Rows that came after their day was closed."""
    return spark.read.schema(schema).parquet(os.path.join(out_dir, "late"))


def _closed_before(spark: SparkSession, out_dir: str, batch_id: int) -> dt.date | None:
    """The first day that earlier batches left open (None: no day was closed)."""
    if turn(batch_id) == 0:
        return None
    return before(_table(spark, out_dir, "closing", CLOSING), batch_id).agg(F.max("closed_before")).first()[0]


def _judge(spark: SparkSession, batch_id: int, closed_before: dt.date | None, out_dir: str, p: DetectionParams) -> None:
    """Close the days before ``closed_before`` and write the verdicts that are new or changed."""
    _write(spark.createDataFrame([(closed_before,)], "closed_before date"), out_dir, "closing", batch_id)
    counts = before(_table(spark, out_dir, "counts", COUNTS), batch_id, with_itself=True)
    daily = counts.groupBy("date").agg(F.sum("daily_count").alias("daily_count"))
    now = R.volume_baseline_from(daily, p).filter(F.col("date") < F.lit(closed_before).cast("date")).select("date", F.struct(*STATISTICS).alias("now"))
    if turn(batch_id) == 0:
        changes = now.select("date", "now.*", F.lit(ISSUED).alias("change"))
    else:
        # counts only grow, so a day that has a verdict never goes
        old = _latest(before(_table(spark, out_dir, "verdicts", VERDICTS), batch_id)).select("date", F.struct(*STATISTICS).alias("old"))
        issued = F.struct(F.col("now").alias("v"), F.lit(ISSUED).alias("change"))
        retracted = F.struct(F.col("old").alias("v"), F.lit(RETRACTED).alias("change"))
        pair = F.when(F.col("old").isNull(), F.array(issued)).otherwise(F.array(retracted, issued))
        changed = now.join(old, "date", "left").filter(~F.col("now").eqNullSafe(F.col("old")))
        changes = changed.select("date", F.explode(pair).alias("x")).select("date", "x.v.*", "x.change")
    _write(changes, out_dir, "verdicts", batch_id)


def judge_batch(batch: DataFrame, batch_id: int, out_dir: str, p: DetectionParams = DEFAULT_DETECTION, lateness_days: int = LATENESS_DAYS) -> None:
    """Count one micro-batch, set its late rows aside, close days and correct verdicts.

    Days close ``lateness_days`` before the batch's median date, so a few
    wrongly dated rows close nothing; a closed day stays closed. Rows without a
    date belong to no day. An empty batch closes nothing.
    """
    spark = batch.sparkSession
    closed = _closed_before(spark, out_dir, batch_id)
    late = batch.filter(F.col("date") < F.lit(closed).cast("date"))
    _write(late, out_dir, "late", batch_id)
    _write(R.daily_counts(batch), out_dir, "counts", batch_id)
    today = current_day(batch)
    if today is not None:
        limit = today - dt.timedelta(days=lateness_days)
        closed = limit if closed is None else max(closed, limit)
    _judge(spark, batch_id, closed, out_dir, p)


def close_all_days(spark: SparkSession, out_dir: str, p: DetectionParams = DEFAULT_DETECTION) -> None:
    """Close every day that has rows, at the end of a period; rows of these days that come later are late."""
    days = _table(spark, out_dir, "counts", COUNTS).agg(F.max("date"), F.max("batch_id")).first()
    last = _table(spark, out_dir, "closing", CLOSING).agg(F.max("batch_id")).first()[0]
    batch_id = -1 - last
    closed = _closed_before(spark, out_dir, batch_id)
    if days[0] is not None:
        after = days[0] + dt.timedelta(days=1)
        closed = after if closed is None else max(closed, after)
    _judge(spark, batch_id, closed, out_dir, p)


def start_corrected_spike_monitor(stream: DataFrame, out_dir: str, checkpoint: str, p: DetectionParams = DEFAULT_DETECTION,
                                  lateness_days: int = LATENESS_DAYS, trigger: dict | None = None):
    """Spike verdicts of a transaction stream, corrected when late rows come."""
    writer = stream.writeStream.option("checkpointLocation", checkpoint).foreachBatch(
        _once(lambda df, bid: judge_batch(df, bid, out_dir, p, lateness_days))
    )
    return writer.trigger(**(trigger or {"availableNow": True})).start()
