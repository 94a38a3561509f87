"""Streaming jobs: spike verdicts per closed day, the duplicate monitor, and
the incremental run of all four rules with its alerts.

Every ``foreachBatch`` writer is idempotent: output goes to a folder keyed by
the batch id in overwrite mode, so a replayed micro-batch (after a failure)
replaces its own output instead of duplicating it. A micro-batch is persisted
while it is processed, so its source is read once. History and outputs live
under folders the caller gives (shared storage on a cluster).
"""

from __future__ import annotations

import datetime as dt
import os
from collections.abc import Callable

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..config import DEFAULT_DETECTION, DEFAULT_REPORT, DetectionParams, ReportParams
from ..constants import RULE_SPIKE
from ..operators import report as P
from ..operators import rules as R
from ..operators.detect import dedupe_flags, normalize_flags
from ..operators.score import score_flags
from ..sources.transactions import split_rejects
from . import state
from .rules import stream_daily_counts, stream_row_flags
from .state import batch_dir

LATENESS_DAYS = 2
CORRUPT = "_line"


def _once(process: Callable[[DataFrame, int], None]) -> Callable[[DataFrame, int], None]:
    """A batch function whose source and stateful operators are evaluated once."""

    def run(batch: DataFrame, batch_id: int) -> None:
        batch.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            process(batch, batch_id)
        finally:
            batch.unpersist()

    return run


def current_day(batch: DataFrame):
    """The median date of a batch: a few rows with a date in the future don't move it."""
    return batch.filter(F.col("date").isNotNull()).agg(
        F.date_from_unix_date(F.percentile_approx(F.unix_date("date"), 0.5).cast("int"))
    ).first()[0]


def judge_days(spark: SparkSession, new_days: DataFrame, batch_id: int, history_dir: str, verdict_dir: str,
               p: DetectionParams = DEFAULT_DETECTION) -> None:
    """Append closed days to the daily history and write their spike verdicts.

    The baseline of a new day uses the previous ``rolling_window`` observed
    days of the whole history (one row per day, so this stays small).
    """
    new_days.write.mode("overwrite").parquet(batch_dir(history_dir, batch_id))
    history = spark.read.parquet(history_dir)
    verdicts = R.volume_baseline_from(history.select("date", "daily_count"), p).join(
        new_days.select("date"), "date", "left_semi"
    )
    verdicts.write.mode("overwrite").parquet(batch_dir(verdict_dir, batch_id))


def start_spike_monitor(stream: DataFrame, history_dir: str, verdict_dir: str, checkpoint: str,
                        p: DetectionParams = DEFAULT_DETECTION, lateness: str = "1 day", trigger: dict | None = None):
    """R3: one-day tumbling counts → spike verdict for every closed day."""
    spark = stream.sparkSession
    writer = (
        stream_daily_counts(stream, lateness)
        .writeStream.outputMode("append")
        .option("checkpointLocation", checkpoint)
        .foreachBatch(_once(lambda df, bid: judge_days(spark, df, bid, history_dir, verdict_dir, p)))
    )
    return writer.trigger(**(trigger or {"availableNow": True})).start()


STATE_SCHEMA = "supplier_id string, _amount_key double, date date, transaction_id string, _c long"


def flag_duplicates_batch(batch: DataFrame, batch_id: int, state_dir: str, window_days: int, horizon_days: int) -> DataFrame:
    """Rule 1 on one micro-batch: all its rows with an id of :func:`duplicate_ids_of_batch`."""
    return R.duplicate_flags(R.with_ids(batch, duplicate_ids_of_batch(batch, batch_id, state_dir, window_days, horizon_days)), window_days)


def duplicate_ids_of_batch(batch: DataFrame, batch_id: int, state_dir: str, window_days: int, horizon_days: int) -> DataFrame:
    """The ids that Rule 1 flags in one micro-batch against the stored recent day groups; writes the next state.

    The state has, for each (supplier, amount key, day), the smallest id and
    its row count. The batch is counted per (key, day, id) with map-side
    partial aggregation and merged with it; a row's id is flagged if the key
    has an earlier day within ``window_days``, or if the day's first id is
    another one or is there again. On date-ordered input this is the batch rule; verdicts already
    given are not revised.

    State version ``batch_id`` keeps the days from ``horizon_days`` before the
    batch's median date on, and reads version ``batch_id - 1``, so a replayed
    batch gives the same. Wrongly dated rows can't move the median and cannot
    make the state go.
    """
    spark = batch.sparkSession
    new = R._keyed(batch).groupBy(*R.KEY, "transaction_id").agg(F.count(F.lit(1)).alias("_c"))
    known = new
    if batch_id > 0:
        known = spark.read.schema(STATE_SCHEMA).parquet(batch_dir(state_dir, batch_id - 1)).unionByName(new)
    firsts = (
        known.groupBy(*R.KEY, "transaction_id")
        .agg(F.sum("_c").alias("_c"))
        .groupBy(*R.KEY)
        .agg(F.min(F.struct("transaction_id", "_c")).alias("_first"))
    )
    w = Window.partitionBy("supplier_id", "_amount_key").orderBy("date")
    gap = F.datediff(F.col("date"), F.lag("date").over(w))
    days = firsts.withColumn("_first_hit", F.coalesce(gap <= F.lit(window_days), F.lit(False)))
    again = ~F.col("_first.transaction_id").eqNullSafe(F.col("transaction_id")) | (F.col("_first._c") > 1)
    hit = F.col("_first_hit") | (again if window_days >= 0 else F.lit(False))
    ids = new.join(days, R.KEY).filter(hit).select(F.col("transaction_id").alias("_flagged_id")).distinct()
    today = current_day(batch)
    keep = days if today is None else days.filter(F.col("date") >= F.date_sub(F.lit(today), horizon_days))
    keep.select(*R.KEY, F.col("_first.transaction_id").alias("transaction_id"), F.col("_first._c").alias("_c")).write.mode(
        "overwrite"
    ).parquet(batch_dir(state_dir, batch_id))
    return ids


def _checked_horizon(window_days: int, horizon_days: int | None, lateness_days: int) -> int:
    least = max(0, window_days) + lateness_days
    if horizon_days is None:
        return least
    if horizon_days < least:
        raise ValueError(f"horizon_days must be at least window_days + lateness_days = {least}")
    return horizon_days


def start_duplicate_monitor(stream: DataFrame, state_dir: str, out_dir: str, checkpoint: str,
                            window_days: int = DEFAULT_DETECTION.window_days, horizon_days: int | None = None,
                            lateness_days: int = LATENESS_DAYS, trigger: dict | None = None):
    """R2: the duplicate rule with batch operators per micro-batch, so no key meets whole in one task.

    ``horizon_days`` (at least window + lateness, which is the default) is how
    far behind a batch's median date rows may come and still be compared.
    """
    horizon = _checked_horizon(window_days, horizon_days, lateness_days)

    def process(batch: DataFrame, batch_id: int) -> None:
        flags = flag_duplicates_batch(batch, batch_id, state_dir, window_days, horizon)
        flags.write.mode("overwrite").parquet(batch_dir(out_dir, batch_id))

    writer = stream.writeStream.option("checkpointLocation", checkpoint).foreachBatch(_once(process))
    return writer.trigger(**(trigger or {"availableNow": True})).start()


def spike_flags_of_closed_days(spark: SparkSession, out_dir: str, batch_id: int, before, p: DetectionParams, schema) -> DataFrame:
    """Rule 4 for the days that closed with this batch: flags of all their stored rows.

    A day closes when it lies before ``before`` (None: all days close). Each
    day is judged once, against the stored daily counts of all batches.
    """
    def table(name: str) -> str:
        return os.path.join(out_dir, name)

    counts = spark.read.parquet(table("days")).groupBy("date").agg(F.sum("daily_count").alias("daily_count"))
    verdicts = R.volume_baseline_from(counts, p)
    closed = verdicts if before is None else verdicts.filter(F.col("date") < F.lit(before))
    if batch_id != 0:
        old = spark.read.schema("date date, is_spike boolean, batch_id int").parquet(table("judged"))
        closed = closed.join(old.filter(F.col("batch_id") != batch_id).select("date"), "date", "left_anti")
    closed.select("date", "is_spike").write.mode("overwrite").parquet(batch_dir(table("judged"), batch_id))
    judged = spark.read.parquet(batch_dir(table("judged"), batch_id)).filter("is_spike").select("date")
    spikes = verdicts.join(judged, "date", "left_semi").select("date", "daily_count", "rolling_mean", "rolling_std")
    # stored by date: only the folders of spike days are read; at most one row per calendar day
    rows = stored_transactions(spark, out_dir, schema, batch_id)
    return rows.join(F.broadcast(spikes), "date").select(
        *rows.columns,
        "daily_count",
        "rolling_mean",
        "rolling_std",
        F.lit(RULE_SPIKE).alias("rule_triggered"),
        R.spike_detail(p.spike_sigma).alias("rule_detail"),
        F.lit(0.0).alias("leakage_amount_gbp"),
    )


def stored_transactions(spark: SparkSession, out_dir: str, schema, batch_id: int, with_itself: bool = True) -> DataFrame:
    """Transactions of all batches up to this one; a filter or broadcast join on the date reads only its folders."""
    rows = spark.read.schema(schema).parquet(os.path.join(out_dir, "transactions"))
    return state.before(rows, batch_id, with_itself).select(*[f.name for f in schema.fields])


def _rows_of_repeated_ids(batch: DataFrame, ids: DataFrame, batch_id: int, out_dir: str, since) -> DataFrame:
    """Rows of the batch and of earlier ones whose id Rule 1 flags: the earliest of an id is the one that is reported.

    Earlier rows are found by their ids and dates alone; whole rows are read
    only on the days where a flagged id was seen before.
    """
    mine = R.with_ids(batch, ids)
    if state.turn(batch_id) == 0:
        return mine
    old = stored_transactions(batch.sparkSession, out_dir, batch.schema, batch_id, with_itself=False)
    if since is not None:
        old = old.filter(F.col("date") >= F.lit(since))
    days = R.with_ids(old.select("transaction_id", "date"), ids).select(F.col("date").alias("_day")).distinct()
    # at most one row per calendar day
    return mine.unionByName(R.with_ids(old.join(F.broadcast(days), F.col("date") == F.col("_day"), "left_semi"), ids))


def detect_batch(batch: DataFrame, batch_id: int, out_dir: str, p: DetectionParams = DEFAULT_DETECTION,
                 rp: ReportParams = DEFAULT_REPORT, lateness_days: int = LATENESS_DAYS, repeat_days: int | None = None) -> None:
    """All four rules on one micro-batch: its flags, its alert digest and the summary so far.

    Tables under ``out_dir``, one folder per batch in each: transactions (what
    came, by date), days (counts), duplicates (state), judged (closed days),
    flags (new findings), found and partials (see :mod:`.state`), alerts (digest
    of the batch) and summary (of all batches so far).

    A finding is given once per (id, rule) over all batches. ``repeat_days``:
    how long an id may come again; older keys expire (None: never).
    """
    spark = batch.sparkSession
    cols = batch.columns
    batch.write.mode("overwrite").partitionBy("date").parquet(batch_dir(os.path.join(out_dir, "transactions"), batch_id))
    R.daily_counts(batch).write.mode("overwrite").parquet(batch_dir(os.path.join(out_dir, "days"), batch_id))
    horizon = _checked_horizon(p.window_days, None, lateness_days)
    today = current_day(batch)
    since = None if repeat_days is None or today is None else today - dt.timedelta(days=repeat_days)
    ids = duplicate_ids_of_batch(batch, batch_id, os.path.join(out_dir, "duplicates"), p.window_days, horizon)
    repeated = R.duplicate_flags(_rows_of_repeated_ids(batch, ids, batch_id, out_dir, since), p.window_days)
    flags = [stream_row_flags(batch, p), repeated]
    if today is not None:
        flags.append(spike_flags_of_closed_days(spark, out_dir, batch_id, today - dt.timedelta(days=lateness_days), p, batch.schema))
    _write_flags(batch, flags, cols, out_dir, batch_id, rp, since)


def _write_flags(tx: DataFrame, flags: list[DataFrame], cols: list[str], out_dir: str, batch_id: int, rp: ReportParams, since=None) -> None:
    every = normalize_flags(flags[0], cols)
    for f in flags[1:]:
        every = every.unionByName(normalize_flags(f, cols), allowMissingColumns=True)
    path = batch_dir(os.path.join(out_dir, "flags"), batch_id)
    new = state.not_found_before(dedupe_flags(every), batch_id, out_dir, since)
    new.write.mode("overwrite").parquet(path)
    spark = tx.sparkSession
    scored = score_flags(spark.read.schema(new.schema).parquet(path))
    state.remember(scored, batch_id, out_dir)
    state.write_partials(tx, scored, batch_id, out_dir)
    state.summary_so_far(spark, out_dir, batch_id).write.mode("overwrite").parquet(batch_dir(os.path.join(out_dir, "summary"), batch_id))
    digest = P.alert_payload(P.alert_digest(P.executive_summary(tx, scored), scored, rp))
    digest.write.mode("overwrite").parquet(batch_dir(os.path.join(out_dir, "alerts"), batch_id))


def start_detection(stream: DataFrame, out_dir: str, checkpoint: str, p: DetectionParams = DEFAULT_DETECTION,
                    rp: ReportParams = DEFAULT_REPORT, lateness_days: int = LATENESS_DAYS, trigger: dict | None = None,
                    repeat_days: int | None = None):
    """R4, R5: all four rules and the alert digest on every micro-batch."""
    writer = stream.writeStream.option("checkpointLocation", checkpoint).foreachBatch(
        _once(lambda df, bid: detect_batch(df, bid, out_dir, p, rp, lateness_days, repeat_days))
    )
    return writer.trigger(**(trigger or {"availableNow": True})).start()


def run_incremental(spark: SparkSession, landing_dir: str, schema, out_dir: str, checkpoint: str,
                    p: DetectionParams = DEFAULT_DETECTION, rp: ReportParams = DEFAULT_REPORT,
                    lateness_days: int = LATENESS_DAYS, files_per_batch: int | None = None,
                    fmt: str = "parquet", repeat_days: int | None = None) -> None:
    """R4: one exactly-once pass of all four rules over files not yet processed.

    The checkpoint remembers which files were processed, so calling this daily
    processes each file once. Days that may still get rows stay open;
    :func:`close_days` judges them at the end of a period.

    ``fmt`` "csv": files with a header; their lines are read as strings and
    coerced as in the batch reader, but a line with a bad date, or with more
    or fewer values than the header, goes to the table ``rejects`` (line,
    column, reason; one row per bad column) and the others go on.
    """
    if fmt not in ("parquet", "csv"):
        raise ValueError("the landing folder holds parquet or csv")
    reader = spark.readStream
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    if fmt == "parquet":
        start_detection(reader.schema(schema).parquet(landing_dir), out_dir, checkpoint, p, rp, lateness_days, repeat_days=repeat_days).awaitTermination()
        return
    strings = T.StructType([T.StructField(f.name, T.StringType()) for f in schema.fields] + [T.StructField(CORRUPT, T.StringType())])
    lines = reader.schema(strings).option("header", True).option("enforceSchema", False).option("columnNameOfCorruptRecord", CORRUPT).csv(landing_dir)

    def process(batch: DataFrame, batch_id: int) -> None:
        good, rejects = split_rejects(batch, CORRUPT)
        rejects.write.mode("overwrite").parquet(batch_dir(os.path.join(out_dir, "rejects"), batch_id))
        typed = good.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])
        detect_batch(typed, batch_id, out_dir, p, rp, lateness_days, repeat_days)

    lines.writeStream.option("checkpointLocation", checkpoint).foreachBatch(_once(process)).trigger(availableNow=True).start().awaitTermination()


def close_days(spark: SparkSession, out_dir: str, schema, p: DetectionParams = DEFAULT_DETECTION, rp: ReportParams = DEFAULT_REPORT) -> None:
    """Judge the days that are still open; its flags and alerts have a batch id of their own, below zero."""
    last = spark.read.parquet(os.path.join(out_dir, "days")).agg(F.max("batch_id")).first()[0]
    batch_id = -1 - last
    spikes = spike_flags_of_closed_days(spark, out_dir, batch_id, None, p, schema)
    tx = stored_transactions(spark, out_dir, schema, batch_id).limit(0)
    _write_flags(tx, [spikes], [f.name for f in schema.fields], out_dir, batch_id, rp)
