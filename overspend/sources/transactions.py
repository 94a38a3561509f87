"""Transaction sources: CSV / Parquet readers, the column check and coercion,
and the load profile.

Reading never infers a schema (inference is a full extra pass over the
data): CSV columns arrive as strings and are coerced by name; Parquet
columns keep their stored types and are coerced the same way.  Columns
beyond the required set pass through untouched.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..constants import DATE_COLUMNS, NUMBER_COLUMNS, REQUIRED_COLUMNS
from ..functions.numeric import nan_to_null
from ..plans.physical import spread

TRANSACTION_SCHEMA = T.StructType(
    [
        T.StructField("transaction_id", T.StringType()),
        T.StructField("date", T.DateType()),
        T.StructField("supplier_id", T.StringType()),
        T.StructField("supplier_name", T.StringType()),
        T.StructField("category", T.StringType()),
        T.StructField("baseline_rate", T.DoubleType()),
        T.StructField("invoice_amount", T.DoubleType()),
        T.StructField("expected_delivery_date", T.DateType()),
        T.StructField("actual_delivery_date", T.DateType()),
        T.StructField("po_number", T.StringType()),
        T.StructField("region", T.StringType()),
        T.StructField("approved_by", T.StringType()),
        T.StructField("is_anomaly", T.BooleanType()),
        T.StructField("anomaly_type", T.StringType()),
    ]
)


def check_columns(df: DataFrame, required=REQUIRED_COLUMNS) -> None:
    """Raise ``ValueError`` naming every missing required column (no job)."""
    missing = sorted(set(required) - set(df.columns))
    if missing:
        raise ValueError(f"the transactions lack {missing}")


def _strict_date(name: str, dtype: T.DataType) -> Column:
    c = F.col(name)
    if isinstance(dtype, T.DateType):
        return c
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
        return F.to_date(c)
    parsed = c.cast("string").try_cast("date")
    # a value that is present but not a date is an error, whatever the ANSI setting
    return F.when(
        c.isNotNull() & parsed.isNull(),
        F.raise_error(F.concat(F.lit(f"unparseable date in column {name}: "), c.cast("string"))),
    ).otherwise(parsed)


def _lenient_number(name: str, dtype: T.DataType) -> Column:
    c = F.col(name)
    if isinstance(dtype, T.DoubleType):
        return nan_to_null(c)
    if isinstance(dtype, T.NumericType):
        return c.cast("double")
    # anything that is not a number becomes null
    return nan_to_null(c.cast("string").try_cast("double"))


def coerce_transactions(df: DataFrame) -> DataFrame:
    """Check required columns, then type dates strictly and numbers leniently.

    Bad dates raise at execution; bad, NaN and infinite numbers become null. Other
    columns, including unknown extra ones, are passed through as they are.
    """
    check_columns(df)
    types = {f.name: f.dataType for f in df.schema.fields}
    replacements = {c: _strict_date(c, types[c]) for c in DATE_COLUMNS}
    replacements.update({c: _lenient_number(c, types[c]) for c in NUMBER_COLUMNS})
    if "is_anomaly" in types and not isinstance(types["is_anomaly"], T.BooleanType):
        replacements["is_anomaly"] = F.col("is_anomaly").cast("string").try_cast("boolean")
    return df.withColumns(replacements)


def split_rejects(lines: DataFrame, corrupt: str | None = None) -> tuple[DataFrame, DataFrame]:
    """(good, rejects) of raw string rows, for sources that must go on after a bad line.

    ``good`` is coerced as by :func:`coerce_transactions`. A row with a
    present but unreadable date is rejected, once for each such column, as
    (line, column, reason); so is a row that the CSV reader could not cut,
    if ``corrupt`` names the column where it put the line.
    """
    check_columns(lines)
    names = [c for c in lines.columns if c != corrupt]
    types = {f.name: f.dataType for f in lines.schema.fields}
    bad = [
        F.when(
            F.col(c).isNotNull() & F.col(c).cast("string").try_cast("date").isNull(),
            F.struct(F.lit(c).alias("column"), F.concat(F.lit("unparseable date: "), F.col(c).cast("string")).alias("reason")),
        )
        for c in DATE_COLUMNS
        if not isinstance(types[c], (T.DateType, T.TimestampType, T.TimestampNTZType))
    ]
    none = F.lit(None).cast("struct<column:string,reason:string>")
    line = F.to_csv(F.struct(*[F.col(c).cast("string").alias(c) for c in names]))
    found = F.array_compact(F.array(none, *bad))
    if corrupt:
        cut = F.array(F.struct(F.lit(None).cast("string").alias("column"), F.lit("not as many values as columns").alias("reason")))
        found = F.when(F.col(corrupt).isNotNull(), cut).otherwise(found)
        line = F.coalesce(F.col(corrupt), line)
    judged = lines.withColumn("_bad", found)
    rejects = judged.select(line.alias("line"), F.explode("_bad").alias("b")).select("line", "b.column", "b.reason")
    # dates of good rows are cast before the strict check: Spark may evaluate it ahead of the filter
    dates = {c: F.col(c).cast("string").try_cast("date") for c in DATE_COLUMNS if isinstance(types[c], T.StringType)}
    return coerce_transactions(judged.filter(F.size("_bad") == 0).select(*names).withColumns(dates)), rejects


def read_transactions(spark: SparkSession, path: str, fmt: str | None = None) -> DataFrame:
    """Read a transaction table (CSV with header, or Parquet) and coerce it.

    A missing path raises Spark's PATH_NOT_FOUND ``AnalysisException``.
    """
    fmt = fmt or ("csv" if path.rstrip("/").lower().endswith(".csv") else "parquet")
    if fmt == "csv":
        raw = spark.read.option("header", True).option("inferSchema", False).csv(path)
    else:
        raw = spark.read.format(fmt).load(path)
    return coerce_transactions(spread(raw))


def profile_metrics() -> list[Column]:
    """Aggregates of :func:`load_profile`."""
    return [
        F.count(F.lit(1)).alias("total_transactions"),
        F.min("date").alias("date_range_start"),
        F.max("date").alias("date_range_end"),
    ]


def load_profile(tx: DataFrame) -> DataFrame:
    """Row count and date range of a transaction table (one row)."""
    return tx.agg(*profile_metrics())


def as_strings(df: DataFrame) -> DataFrame:
    """Every column cast to string (what a CSV reader without inference yields)."""
    return df.select([F.col(c).cast("string").alias(c) for c in df.columns])
