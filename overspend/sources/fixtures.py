"""Transactions derived from the TPC-H-style test tables.

transactions = lineitem ⋈ supplier ⋈ part, with the supplier's region through
nation, plus a re-billed copy (id prefixed ``DUP-``, dated one day later,
everything else equal) of every line whose order key is a multiple of 40.

Plan notes (100 TB view):
* lineitem is scanned once; copies come from one ``explode`` on the joined
  row instead of a second scan and a union.
* supplier and part grow with the data, so no broadcast is forced: Spark's
  size check (``autoBroadcastJoinThreshold`` on file statistics, then AQE on
  runtime sizes) picks broadcast or sort-merge.  nation (25 rows) and region
  (5 rows) are fixed-size and broadcast explicitly.
* the transaction id joins order, line, part, supplier and ship date.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..plans.physical import spread

# Expected delivery days by part type, and the copy rate.
EXPECTED_DAYS = {"ECONOMY": 3, "STANDARD": 5, "PROMO": 2, "LARGE": 7, "MEDIUM": 4, "SMALL": 3}
COPY_EVERY = 40
SUPPLIER_ID_WIDTH = 6


# Columns read from each test table, with their stored types.  Declaring them
# skips footer-based schema inference and fixes the ship date as a zone-less
# timestamp, so derived dates never depend on the session time zone.
TABLE_SCHEMAS = {
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
    "l_extendedprice double, l_discount double, l_tax double, l_shipdate timestamp_ntz",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int",
    "part": "p_partkey bigint, p_type string",
    "nation": "n_nationkey int, n_regionkey int",
    "region": "r_regionkey int, r_name string",
}


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    schema = TABLE_SCHEMAS.get(name)
    return spark.read.schema(schema).parquet(path) if schema else spark.read.parquet(path)


def _expected_days(p_type):
    expr = None
    for k, v in EXPECTED_DAYS.items():
        expr = F.when(p_type == k, F.lit(v)) if expr is None else expr.when(p_type == k, F.lit(v))
    return expr


def padded_supplier_id(key) -> F.Column:
    s = key.cast("string")
    return F.concat(
        F.lit("SUP"),
        F.when(F.length(s) >= SUPPLIER_ID_WIDTH, s).otherwise(F.lpad(s, SUPPLIER_ID_WIDTH, "0")),
    )


def fixture_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = read_table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber",
        "l_extendedprice", "l_discount", "l_tax", "l_shipdate",
    )
    li = spread(li, "l_orderkey", "l_linenumber")
    supplier = read_table(spark, sf_dir, "supplier").select("s_suppkey", "s_name", "s_nationkey")
    part = read_table(spark, sf_dir, "part").select("p_partkey", "p_type")
    nation = read_table(spark, sf_dir, "nation").select("n_nationkey", "n_regionkey")
    region = read_table(spark, sf_dir, "region").select("r_regionkey", "r_name")

    # dimension joins first (each side keeps an honest size estimate), then
    # the fixed-size nation/region lookups on the joined rows
    joined = (
        li.join(supplier, li.l_suppkey == supplier.s_suppkey)
        .join(part, li.l_partkey == part.p_partkey)
        .join(F.broadcast(nation), F.col("s_nationkey") == nation.n_nationkey, "left")
        .join(F.broadcast(region), nation.n_regionkey == region.r_regionkey, "left")
        .withColumnRenamed("r_name", "region")
    )

    ship = F.to_date("l_shipdate")
    is_copy = F.col("_copy")
    base_id = F.concat_ws(
        "-",
        F.col("l_orderkey").cast("string"),
        F.col("l_linenumber").cast("string"),
        F.col("l_partkey").cast("string"),
        F.col("l_suppkey").cast("string"),
        (F.year(ship) * 10000 + F.month(ship) * 100 + F.day(ship)).cast("string"),  # yyyyMMdd, cheaper than date_format
    )
    # every line is kept; lines whose order key is a multiple of COPY_EVERY
    # additionally get a re-billed copy (the duplicate share of the data)
    copies = F.when(F.col("l_orderkey") % COPY_EVERY == 0, F.array(F.lit(False), F.lit(True))).otherwise(
        F.array(F.lit(False))
    )
    tx = joined.withColumn("_copy", F.explode(copies)).select(
        F.when(is_copy, F.concat(F.lit("DUP-"), base_id)).otherwise(base_id).alias("transaction_id"),
        F.when(is_copy, F.date_add(ship, 1)).otherwise(ship).alias("date"),
        padded_supplier_id(F.col("l_suppkey")).alias("supplier_id"),
        F.col("s_name").alias("supplier_name"),
        F.col("p_type").alias("category"),
        (F.col("l_extendedprice") * (F.lit(1) - F.col("l_discount"))).alias("baseline_rate"),
        (F.col("l_extendedprice") * (F.lit(1) + F.col("l_tax"))).alias("invoice_amount"),
        F.date_add(ship, _expected_days(F.col("p_type"))).alias("expected_delivery_date"),
        F.date_add(ship, F.col("l_linenumber")).alias("actual_delivery_date"),
        F.concat(F.lit("PO-"), F.col("l_orderkey").cast("string")).alias("po_number"),
        F.col("region"),
        F.lit(None).cast("string").alias("approved_by"),
        is_copy.alias("is_anomaly"),
        F.when(is_copy, F.lit("duplicate")).otherwise(F.lit("")).alias("anomaly_type"),
    )
    # The derived rows are not cached: re-deriving from the kept numeric scan
    # (broadcast joins, projection) measured cheaper than a columnar cache of
    # these string-heavy rows.  For a large source, materialize the table once
    # (``sinks.write_partitioned``) and read it back instead.
    return tx


def repeated_transactions(tx: DataFrame, twice_every: int = 7, later_every: int = 11) -> DataFrame:
    """``tx`` with repeated ids: orders whose number divides by ``twice_every``
    are there twice, those by ``later_every`` once more a day later."""
    order = F.substring("po_number", 4, 20).cast("long")
    twice = F.when(order % twice_every == 0, F.array(F.lit(0), F.lit(0))).otherwise(F.array(F.lit(0)))
    later = F.when(order % later_every == 0, F.array(F.lit(1))).otherwise(F.array().cast("array<int>"))
    return tx.withColumn("_shift", F.explode(F.concat(twice, later))).withColumn("date", F.date_add("date", F.col("_shift"))).drop("_shift")


def event_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ``events`` table as transactions: the user is the supplier, the
    value the amount (and baseline), the event day the date; delivery dates
    equal the date.  A second, naturally duplicated stream source."""
    ev = spark.read.parquet(f"{sf_dir.rstrip('/')}/events.parquet").select("event_id", "ts", "user_id", "event_type", "value")
    day = F.to_date("ts")
    return ev.select(
        F.col("event_id").cast("string").alias("transaction_id"),
        day.alias("date"),
        F.col("user_id").cast("string").alias("supplier_id"),
        F.col("user_id").cast("string").alias("supplier_name"),
        F.col("event_type").alias("category"),
        F.col("value").alias("baseline_rate"),
        F.col("value").alias("invoice_amount"),
        day.alias("expected_delivery_date"),
        day.alias("actual_delivery_date"),
        F.lit(None).cast("string").alias("po_number"),
        F.lit(None).cast("string").alias("region"),
        F.lit(None).cast("string").alias("approved_by"),
        F.lit(False).alias("is_anomaly"),
        F.lit("").alias("anomaly_type"),
    )
