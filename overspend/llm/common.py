"""Helpers shared by the training-data operators: reading tables, the shared
folder for written intermediates, and the word and character rules.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = "abcdefghijklmnopqrstuvwxyz"
# Word rule of the phrase operators: ASCII letters, digits and every non-ASCII character.
NOT_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"

_LOCAL_FOLDER: tempfile.TemporaryDirectory | None = None


def importable(spark: SparkSession) -> None:
    """Let Python workers import this package from where the driver has it; no change where it is installed there too."""
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    env = spark.sparkContext.environment
    known = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in known:
        env["PYTHONPATH"] = os.pathsep.join([root, *known])


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    importable(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder that the session names in ``spark.checkpoint.dir``.

    Only a local-mode session without that setting gets a folder of its own,
    which goes when the process ends. On a cluster the setting is required.
    """
    global _LOCAL_FOLDER
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.conf.get("spark.master", "").startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    if _LOCAL_FOLDER is None:
        _LOCAL_FOLDER = tempfile.TemporaryDirectory(prefix="overspend-shared-")
    return _LOCAL_FOLDER.name


def saved(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` into the shared folder and read it back.

    Cuts the lineage: a lost executor costs a re-read, not a re-computation.
    Folders are named by application, so they can be removed after it ends.
    """
    spark = df.sparkSession
    app = spark.conf.get("spark.app.id", "app")
    path = f"{shared_folder(spark)}/{app}/{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def ascii_lower(c: Column) -> Column:
    """Lower-case A-Z only, whatever the locale."""
    return F.translate(c, UPPER, LOWER)


def phrase_words(c: Column) -> Column:
    """Array of the words of a text; null and texts without words give an empty array."""
    spaced = F.trim(F.regexp_replace(ascii_lower(F.coalesce(c, F.lit(""))), NOT_WORD, " "))
    return F.when(spaced == "", F.array().cast("array<string>")).otherwise(F.split(spaced, " "))


def free_name(df: DataFrame, name: str) -> str:
    """``name``, or the first variant of it that no column of ``df`` has."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


#: A side is broadcast only if its strings and rows take at most this.
SMALL_BYTES = 32_000_000


def small(df: DataFrame, most: int = SMALL_BYTES) -> DataFrame:
    """``df`` marked for broadcast if a count shows that it is small; else as it is, for a shuffle join.

    ``df`` should be a written table, since it is read for the check.
    """
    width = sum(
        (F.coalesce(F.length(F.to_json(F.struct(name))), F.lit(0)) if kind.startswith(("string", "array", "struct")) else F.lit(8) for name, kind in df.dtypes),
        F.lit(16),
    )
    total = df.agg(F.sum(width)).first()[0] or 0
    return F.broadcast(df) if total <= most else df
