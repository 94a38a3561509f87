"""Transactions as bucketed tables, for runs that come back to them.

Two tables: ``<name>`` has the whole rows, bucketed by transaction id;
``<name>_keys`` has (supplier, amount key, date, id), bucketed by the first
three. Rule 1 then counts its day groups, selects the flagged rows and keeps
one row per id without a shuffle of transactions: only day groups and flagged
ids move. The date is part of the buckets so that a supplier with a third of
all rows is spread over all of them; the step from day to day runs over the
day groups, which are one row per key and day.

Null ids have one bucket in the whole rows; they are few or none in a sound
table, and are selected by a broadcast of at most one row.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import DEFAULT_DETECTION
from ..operators import rules as R
from ..operators.detect import dedupe_flags, normalize_flags


def keys_table(name: str) -> str:
    return f"{name}_keys"


def write_bucketed(tx: DataFrame, name: str, path: str, buckets: int | None = None, mode: str = "error") -> None:
    """Write both tables under ``path`` and register them as ``name`` and ``name_keys``.

    ``buckets`` (default: the session's shuffle partitions) should not be below
    the shuffle partitions of the sessions that read: Spark shuffles a side
    that has fewer. The rows are dealt by the bucket columns first, so that a
    bucket is one file and not one for each task.
    """
    spark = tx.sparkSession
    n = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))

    def write(df: DataFrame, table: str, by: list[str]) -> None:
        out = df.repartition(n, *by).write.mode(mode).format("parquet").option("path", f"{path}/{table}")
        out.bucketBy(n, *by).sortBy(*by).saveAsTable(table)

    write(tx, name, ["transaction_id"])
    # as text: Spark normalizes doubles before it compares them, and then doesn't see that the buckets fit
    keys = R._keyed(tx).withColumn("_amount_key", (F.col("_amount_key") + F.lit(0.0)).cast("string"))
    write(keys.select(*R.KEY, "transaction_id"), keys_table(name), R.KEY)


def duplicate_flags_bucketed(spark: SparkSession, name: str, window_days: int = DEFAULT_DETECTION.window_days) -> DataFrame:
    """Rule 1 over the tables of :func:`write_bucketed`, one row per id, as in the flag table."""
    tx = spark.table(name)
    ids = R.duplicate_ids_of(spark.table(keys_table(name)), window_days)
    known, unknown = ids.filter("_flagged_id IS NOT NULL"), ids.filter("_flagged_id IS NULL")

    def one_row(rows: DataFrame) -> DataFrame:
        return dedupe_flags(normalize_flags(R.duplicate_flags(rows, window_days), tx.columns))

    # plain equality: a null-safe one would not be that of the buckets
    named = tx.filter(F.col("transaction_id").isNotNull()).join(known, F.col("transaction_id") == F.col("_flagged_id"), "left_semi")
    nameless = R.with_ids(tx.filter(F.col("transaction_id").isNull()), F.broadcast(unknown))
    return one_row(named).unionByName(one_row(nameless))
