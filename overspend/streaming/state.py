"""State that the incremental run keeps from batch to batch.

* ``found``: the keys (id, rule) of all findings given so far, by id hash.
  A finding whose key is there is not given again. Keys expire with the date
  of their finding, if a horizon is set.
* ``partials``: per batch and day, counts and exact sums that add up, and the
  ids found for the first time. Their totals are the summary of everything so
  far; no earlier row is read again for it.

Both are written per batch, and a batch reads only those before it: a replayed
batch gives the same and replaces its own part.
"""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import DEFAULT_SCORING, ScoringParams
from ..constants import SEVERITY_LABELS_DESC
from ..functions.numeric import MONEY, exact_sum

#: Folders of ``found`` in a batch; a batch with few ids reads only theirs.
BUCKETS = 32
FOUND = "transaction_id string, rule_triggered string, date date, batch_id int, bucket int"
COUNTS = ["transactions", "flags", *[s.lower() for s in SEVERITY_LABELS_DESC], "new_ids"]
PARTIALS = "date date, " + ", ".join(f"{c} long" for c in COUNTS) + ", leakage decimal(38,18), batch_id int"


def batch_dir(folder: str, batch_id: int) -> str:
    return os.path.join(folder, f"batch_id={batch_id}")


def turn(batch_id: Column | int) -> Column | int:
    """Place of a batch in time. Ids below zero are closing runs: -1 - n comes right after batch n."""
    if isinstance(batch_id, int):
        return 2 * batch_id if batch_id >= 0 else 2 * (-1 - batch_id) + 1
    return F.when(batch_id >= 0, 2 * batch_id).otherwise(2 * (-1 - batch_id) + 1)


def before(table: DataFrame, batch_id: int, with_itself: bool = False) -> DataFrame:
    """Rows of earlier batches (whole folders are left out)."""
    here = turn(F.col("batch_id"))
    return table.filter(here <= turn(batch_id) if with_itself else here < turn(batch_id))


def _bucket(c: str = "transaction_id") -> Column:
    return F.pmod(F.xxhash64(c), F.lit(BUCKETS)).cast("int")


def not_found_before(flags: DataFrame, batch_id: int, out_dir: str, since=None) -> DataFrame:
    """Findings of a batch (one per id and rule) that no earlier one gave, with ``_known_id``: the id was found before.

    ``since``: keys of findings dated earlier have expired. The ids of the
    batch select from the state first, so that only what they meet is joined
    to the wide rows.
    """
    if turn(batch_id) == 0:
        return flags.withColumn("_known_id", F.lit(False))
    spark = flags.sparkSession
    state = before(spark.read.schema(FOUND).parquet(os.path.join(out_dir, "found")), batch_id)
    if since is not None:
        state = state.filter(F.col("date").isNull() | (F.col("date") >= F.lit(since)))
    ids = flags.select(F.col("transaction_id").alias("_id"), _bucket().alias("_in")).distinct()
    met = state.join(ids, (state["bucket"] == ids["_in"]) & state["transaction_id"].eqNullSafe(ids["_id"]), "left_semi")
    rules = met.groupBy(F.col("transaction_id").alias("_id")).agg(F.collect_set("rule_triggered").alias("_rules"))  # one entry per rule
    known = flags.join(rules, flags["transaction_id"].eqNullSafe(rules["_id"]), "left")
    again = F.coalesce(F.array_contains("_rules", F.col("rule_triggered")), F.lit(False))
    return known.filter(~again).withColumn("_known_id", F.col("_rules").isNotNull()).drop("_id", "_rules")


def remember(flags: DataFrame, batch_id: int, out_dir: str) -> None:
    """Write the keys of the batch's findings."""
    keys = flags.select("transaction_id", "rule_triggered", "date", _bucket().alias("bucket"))
    keys.write.mode("overwrite").partitionBy("bucket").parquet(batch_dir(os.path.join(out_dir, "found"), batch_id))


def expire(spark: SparkSession, out_dir: str, since) -> list[int]:
    """Batches of ``found`` whose keys are all dated before ``since``: their folders are no longer read and may be removed."""
    state = spark.read.schema(FOUND).parquet(os.path.join(out_dir, "found"))
    latest = state.groupBy("batch_id").agg(F.max("date").alias("latest"), F.max(F.col("date").isNull()).alias("undated"))
    return sorted(r["batch_id"] for r in latest.filter(~F.col("undated") & (F.col("latest") < F.lit(since))).collect())  # one row per batch


def write_partials(tx: DataFrame, scored: DataFrame, batch_id: int, out_dir: str) -> None:
    """Per day: rows of ``tx``, and of the batch's new findings ``scored`` (with ``_known_id``) the flags, severities, leakage and new ids."""
    zero = F.lit(0).cast("long")

    def row(frame: DataFrame, **given: Column) -> DataFrame:
        counts = frame.groupBy("date").agg(*[(given.get(c) if c in given else F.max(zero)).alias(c) for c in COUNTS],
                                           given.get("leakage", F.max(F.lit(0).cast("decimal(38,18)"))).cast("decimal(38,18)").alias("leakage"))
        return counts

    severities = {s.lower(): F.count(F.when(F.col("severity") == s, F.lit(1))) for s in SEVERITY_LABELS_DESC}
    ids = scored.filter(~F.col("_known_id") & F.col("transaction_id").isNotNull()).groupBy("transaction_id").agg(F.min("date").alias("date"))
    parts = (
        row(tx, transactions=F.count(F.lit(1)))
        .unionByName(row(scored, flags=F.count(F.lit(1)), leakage=exact_sum("leakage_amount_gbp"), **severities))
        .unionByName(row(ids, new_ids=F.count(F.lit(1))))
    )
    total = parts.groupBy("date").agg(*[F.sum(c).alias(c) for c in COUNTS], F.sum("leakage").alias("leakage"))
    total.write.mode("overwrite").parquet(batch_dir(os.path.join(out_dir, "partials"), batch_id))


def summary_so_far(spark: SparkSession, out_dir: str, batch_id: int, p: ScoringParams = DEFAULT_SCORING) -> DataFrame:
    """The executive summary of all batches up to this one, from their partials (one row per batch and day)."""
    parts = before(spark.read.schema(PARTIALS).parquet(os.path.join(out_dir, "partials")), batch_id, with_itself=True)
    seen = F.when(F.col("transactions") > 0, F.col("date"))
    sums = parts.agg(
        *[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in COUNTS],
        F.sum("leakage").alias("leakage"),
        F.min(seen).alias("lo"),
        F.max(seen).alias("hi"),
    )
    return sums.select(
        F.bround(F.coalesce("leakage", F.lit(0).cast("decimal(38,18)")), 2).cast(MONEY).alias("headline_gbp"),
        F.col("new_ids").alias("headline_transactions"),
        F.col("flags").alias("total_flags"),
        *[F.col(s.lower()).alias(f"{s.lower()}_count") for s in SEVERITY_LABELS_DESC],
        F.col("transactions").alias("total_transactions_analysed"),
        F.date_format("lo", "yyyy-MM-dd").alias("date_range_start"),
        F.date_format("hi", "yyyy-MM-dd").alias("date_range_end"),
        F.lit(p.currency).alias("currency"),
    )
