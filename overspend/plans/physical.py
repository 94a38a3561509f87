"""Physical-plan helpers: spreading coarse scans and a distributed global row
number, computed per partition with a small offsets table whose size is the
number of partitions. Nothing is collected to the driver.
"""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import checkpoint_dir

def is_coarse(df: DataFrame) -> bool:
    """True when a scan has fewer splits than the cluster has cores.

    Only plans the scan (no job).  Large inputs have far more splits than
    cores; a coarse source is small or stored as a few unsplittable files.
    """
    try:
        return df.rdd.getNumPartitions() < df.sparkSession.sparkContext.defaultParallelism
    except (PySparkException, AttributeError):  # no RDD access (a Spark Connect client): never spread
        return False


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """Spread a coarse scan over the cluster's cores (else return it as is).

    A source stored as a few unsplittable files (e.g. one parquet row group)
    yields fewer scan tasks than cores, and every row-local rule would then
    run in those few tasks.  Such a source is hash-spread on a near-unique
    key (``keys``; round-robin without) and kept (memory, spilling to disk):
    the passes of a query then read it in parallel instead of re-reading the
    single split.  Callers pass the narrow projection they need, so what is
    kept is compact.  Large inputs are returned unchanged: no shuffle,
    nothing kept.
    """
    if not is_coarse(df):
        return df
    target = df.sparkSession.sparkContext.defaultParallelism
    spread_df = df.repartition(target, *keys) if keys else df.repartition(target)
    return spread_df.persist(StorageLevel.MEMORY_AND_DISK)


def persisted(df: DataFrame) -> DataFrame:
    """Keep a small, reused intermediate in memory (spilling to disk).

    Lost blocks are recomputed from lineage, so executor loss is survivable.
    """
    return df.persist(StorageLevel.MEMORY_AND_DISK)


def global_row_number(df: DataFrame, order: list[Column], name: str = "row_number") -> DataFrame:
    """Number all rows 1..N in ``order`` without a single-partition window.

    1. range-partition on the order and sort inside each partition (the sort
       is distributed; ``order`` must be a total order for a stable number);
    2. cut lineage with a reliable checkpoint in the session's shared
       checkpoint folder, fixing partition contents and row order;
    3. count rows per partition (one row per partition) and turn the counts
       into start offsets with a window over that tiny table;
    4. number = offset of the partition + position inside it.
    """
    checkpoint_dir(df.sparkSession)
    n_parts = max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), 1)
    # kept while range bounds are sampled and rows shuffled: one evaluation
    source = persisted(df)
    ranged = source.repartitionByRange(n_parts, *order).sortWithinPartitions(*order).checkpoint(eager=True)
    source.unpersist()
    pid, mid = "__pid", "__mid"
    tagged = ranged.withColumn(pid, F.spark_partition_id()).withColumn(mid, F.monotonically_increasing_id())
    # monotonically_increasing_id = (partition index << 33) + position in partition
    tagged = tagged.withColumn(mid, F.col(mid) - F.shiftleft(F.col(pid).cast("long"), 33))
    counts = tagged.groupBy(pid).agg(F.count(F.lit(1)).alias("__n"))
    offsets = counts.withColumn(
        "__start", F.coalesce(F.sum("__n").over(Window.orderBy(pid).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    ).select(pid, "__start")
    # offsets has one row per partition: a fixed, small size
    return (
        tagged.join(F.broadcast(offsets), pid)
        .withColumn(name, (F.col("__start") + F.col(mid) + 1).cast("long"))
        .drop(pid, mid, "__start")
    )
