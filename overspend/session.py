"""Session helpers: a local session for tests and benches, and the shared
checkpoint folder used to cut lineage.

On a cluster the checkpoint folder must be the shared one named by
``spark.checkpoint.dir``; only a local-mode session (tests, bench) gets a
fresh scratch folder of its own when nothing is configured.
"""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession


_SCRATCH: tempfile.TemporaryDirectory | None = None


def _scratch() -> str:
    """A folder of this process, removed when it ends: for local sessions only."""
    global _SCRATCH
    if _SCRATCH is None:
        _SCRATCH = tempfile.TemporaryDirectory(prefix="overspend-ckpt-")
    return _SCRATCH.name


def local_session(
    cores: int | str = "*", shuffle_partitions: int = 8, app: str = "overspend", checkpoint_dir: str | None = None
) -> SparkSession:
    """A local session configured like the tests and the bench; ``checkpoint_dir`` becomes ``spark.checkpoint.dir``."""
    builder = SparkSession.builder
    if checkpoint_dir:
        builder = builder.config("spark.checkpoint.dir", checkpoint_dir)
    return (
        builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        # call sites of every column expression cost more than the expressions (set before the session starts)
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        # remove checkpoint files once their data is no longer referenced
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .getOrCreate()
    )


def checkpoint_dir(spark: SparkSession) -> str:
    """Return the session's checkpoint folder, setting one only in local mode.

    Order: the SparkContext's current folder, then ``spark.checkpoint.dir``
    from the session config; a local-mode session without either gets a
    scratch folder that goes with the process. A cluster session without a configured folder is an error:
    a machine-local folder would not survive the loss of an executor.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001 — a Spark Connect client: the server's spark.checkpoint.dir applies
        return spark.conf.get("spark.checkpoint.dir", None) or ""
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir() or configured
    if sc.master.startswith("local"):
        sc.setCheckpointDir(_scratch())
        return sc.getCheckpointDir()
    raise RuntimeError(
        "spark.checkpoint.dir is not set; configure a shared folder (HDFS/S3/ABFS) "
        "for lineage cuts before running ranked outputs on a cluster"
    )
