"""The four detection rules as DataFrame operators.

Each rule takes a coerced transaction frame and returns the flagged rows
with ``rule_triggered``, ``rule_detail`` and ``leakage_amount_gbp`` added
(plus ``breach_days`` for SLA and the daily statistics for spikes), one row
per flagged input row.  All logic is native Column expressions.

Rule 1 flags ids: with the rows of one supplier and one amount (rounded
half-even to a whole unit) in (date, transaction_id) order, nulls first, the id
of every row that has an earlier row at most ``window_days`` before it is
flagged, and all rows with a flagged id are returned. A row loaded twice is
therefore found, as is an id that repeats on other days. It is planned as
aggregates and joins instead of a window over raw rows:

* rows whose supplier and amount are there once leave first, by a count that
  a hot key enters as one row per task;
* ``day_groups``: one row per (supplier, rounded amount, date) with its row
  count and first id: the map-side partial aggregation collapses a hot key
  before the shuffle;
* a window over those day rows finds the previous day of the same key; a
  key has at most one row per calendar day, so its window partition is
  bounded by the date span, never by the data volume;
* the narrow (key, id) rows of the groups that flag anything give the flagged
  ids: all of a group but the first, or all;
* the flagged ids select the rows by a semi-join, in which AQE splits a hot id.

Nothing runs while a query is built, and nothing stays persisted.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..config import DEFAULT_DETECTION, DetectionParams
from ..constants import RULE_DUPLICATE, RULE_PRICE, RULE_SLA, RULE_SPIKE
from ..functions.numeric import array_round, safe_ratio
from ..functions.text import fixed, fmt_param, grouped, iso_date

KEY = ["supplier_id", "_amount_key", "date"]


# ---------------------------------------------------------------------------
# Rule 1: duplicates
# ---------------------------------------------------------------------------

def amount_key(tx: DataFrame) -> DataFrame:
    return tx.withColumn("_amount_key", array_round("invoice_amount", 0))


def _keyed(tx: DataFrame) -> DataFrame:
    """Rows that can match: supplier, amount and date all present."""
    return amount_key(tx).filter(
        F.col("supplier_id").isNotNull() & F.col("_amount_key").isNotNull() & F.col("date").isNotNull()
    )


def day_groups(tx: DataFrame) -> DataFrame:
    """One row per (supplier, amount key, date) without nulls: its row count and its first id (a struct, so null comes first).

    The map-side partial aggregation collapses a hot key before the shuffle.
    """
    return day_groups_of(_keyed(tx))


def day_groups_of(rows: DataFrame) -> DataFrame:
    """:func:`day_groups` of rows that have their amount key."""
    return rows.groupBy(*KEY).agg(F.count(F.lit(1)).alias("_n"), F.min(F.struct("transaction_id")).alias("_first"))


def duplicate_groups(days: DataFrame, window_days: int) -> DataFrame:
    """Day groups that flag at least one row.

    ``_first_hit``: the group's first row is flagged because the previous day
    of the same key is at most ``window_days`` earlier; then every row of the
    group is flagged. Otherwise, with ``window_days >= 0``, every row but the
    group's first is flagged when the group has several rows.
    """
    w = Window.partitionBy("supplier_id", "_amount_key").orderBy("date")
    gap = F.datediff(F.col("date"), F.lag("date").over(w))
    flagged = days.withColumn("_first_hit", F.coalesce(gap <= F.lit(window_days), F.lit(False)))
    same_day = (F.col("_n") > 1) if window_days >= 0 else F.lit(False)
    return flagged.filter(F.col("_first_hit") | same_day).select(*KEY, "_first_hit", "_first")


def recurring(keyed: DataFrame) -> DataFrame:
    """Rows (key, transaction_id) whose supplier and amount are there more than once: Rule 1 can flag no others.

    One counted row per supplier and amount meets the rows, hashed, so that
    they need no sort; they are dealt once, whatever reads them afterwards.
    The count reads the id too: where ids are made of the columns of a join, as
    in the fixture, both then need the same columns of it, and its shuffle is
    made once.
    """
    by = ["_amount_key", "supplier_id"]
    any_id = F.coalesce(F.length(F.col("transaction_id").cast("string")), F.lit(0)) >= 0  # true for every row
    several = keyed.filter(any_id).groupBy(*by).agg(F.count(F.lit(1)).alias("_rows")).filter(F.col("_rows") > 1).select(*by)
    return keyed.join(several.hint("shuffle_hash"), by, "left_semi").select(*KEY, "transaction_id")


def duplicate_ids(tx: DataFrame, window_days: int) -> DataFrame:
    """Distinct ids that Rule 1 flags (a null id counts as an id).

    Narrow passes: the suppliers and amounts that recur, their day groups, and
    the ids of those that flag. The first row of a group without an earlier
    day is legitimate, unless its id is there again.
    """
    return duplicate_ids_of(recurring(_keyed(tx).select(*KEY, "transaction_id")), window_days)


def duplicate_ids_of(keyed: DataFrame, window_days: int) -> DataFrame:
    """:func:`duplicate_ids` of rows (key, transaction_id) that have their amount key."""
    rows = keyed.join(duplicate_groups(day_groups_of(keyed), window_days), KEY)
    later = F.col("_first_hit") | ~F.col("_first.transaction_id").eqNullSafe(F.col("transaction_id"))
    ids = rows.groupBy(*KEY, "transaction_id").agg(F.count(F.lit(1)).alias("_c"), F.max(later).alias("_later"))
    return ids.filter(F.col("_later") | (F.col("_c") > 1)).select(F.col("transaction_id").alias("_flagged_id")).distinct()


def with_ids(tx: DataFrame, ids: DataFrame) -> DataFrame:
    """All rows of ``tx`` whose id is flagged, whatever else they hold."""
    return tx.join(ids, tx["transaction_id"].eqNullSafe(ids["_flagged_id"]), "left_semi")


# The texts of the four rule details below appear in the output.

def duplicate_detail(window_days: int) -> Column:
    return F.concat(
        F.lit("Duplicate of supplier "),
        F.coalesce(F.col("supplier_id"), F.lit("nan")),
        F.lit(" invoice £"),
        F.coalesce(grouped("invoice_amount", 2), F.lit("nan")),
        F.lit(f" within {window_days}d window"),
    )


def duplicate_flags(rows: DataFrame, window_days: int) -> DataFrame:
    return rows.select(
        *rows.columns,
        F.lit(RULE_DUPLICATE).alias("rule_triggered"),
        duplicate_detail(window_days).alias("rule_detail"),
        F.col("invoice_amount").alias("leakage_amount_gbp"),
    )


def detect_duplicates(tx: DataFrame, window_days: int = DEFAULT_DETECTION.window_days) -> DataFrame:
    return duplicate_flags(with_ids(tx, duplicate_ids(tx, window_days)), window_days)


def detect_duplicates_pairwise(tx: DataFrame, window_days: int = DEFAULT_DETECTION.window_days) -> DataFrame:
    """Rule 1 written as an interval self-join, for windows of any length.

    Days are cut into bins as wide as the window. A row has an earlier day of
    its key within the window if its own bin has an earlier day, or if the
    last day of the bin before is close enough; so a row meets two bins at
    most, whatever the window, and a bin is one row per key, pre-aggregated.
    Rows of one day are compared with the day's first id. An independent
    cross-check of ``detect_duplicates``.
    """
    if window_days < 0:
        return duplicate_flags(tx.filter(F.lit(False)), window_days)
    rows = recurring(_keyed(tx).select(*KEY, "transaction_id"))
    first = (
        rows.groupBy(*KEY, "transaction_id")
        .agg(F.count(F.lit(1)).alias("_c"))
        .groupBy(*KEY)
        .agg(F.min(F.struct("transaction_id", "_c")).alias("_first"))
    )
    again = ~F.col("_first.transaction_id").eqNullSafe(F.col("transaction_id")) | (F.col("_first._c") > 1)
    found = rows.join(first, KEY).filter(again).select("transaction_id")
    if window_days > 0:
        # never null, as the date is not: a condition on it would make the shuffle of the rows another one
        bin_of = F.coalesce(F.floor(F.unix_date("date") / F.lit(int(window_days))), F.lit(0))
        binned = rows.withColumn("_bin", bin_of)
        bins = first.withColumn("_bin", bin_of).groupBy("supplier_id", "_amount_key", "_bin").agg(F.min("date").alias("_from"), F.max("date").alias("_to"))
        offered = bins.withColumn("_next", F.explode(F.array(F.lit(0), F.lit(1)))).withColumn("_bin", F.col("_bin") + F.col("_next"))
        near = F.when(F.col("_next") == 0, F.col("_from") < F.col("date")).otherwise(F.datediff("date", "_to") <= window_days)
        found = found.unionByName(binned.join(offered, ["supplier_id", "_amount_key", "_bin"]).filter(near).select("transaction_id"))
    ids = found.select(F.col("transaction_id").alias("_flagged_id")).distinct()
    return duplicate_flags(with_ids(tx, ids), window_days)


# ---------------------------------------------------------------------------
# Rule 2: price variance
# ---------------------------------------------------------------------------

def price_ratio() -> Column:
    return safe_ratio("invoice_amount", "baseline_rate")


def price_hit(threshold: float) -> Column:
    return F.coalesce(price_ratio() > F.lit(float(threshold)), F.lit(False))


def price_detail(threshold: float) -> Column:
    pct = (price_ratio() - F.lit(1.0)) * F.lit(100.0)
    return F.concat(
        F.lit("Invoice £"), grouped("invoice_amount", 2),
        F.lit(" is "), fixed(pct, 1),
        F.lit("% above baseline £"), grouped("baseline_rate", 2),
        F.lit(f" (threshold: {fmt_param((threshold - 1) * 100, 0)}%)"),
    )


def price_leakage(threshold: float) -> Column:
    # what was paid beyond the tolerated price
    return array_round(F.col("invoice_amount") - F.col("baseline_rate") * F.lit(float(threshold)), 2)


def detect_price_variance(tx: DataFrame, threshold: float = DEFAULT_DETECTION.price_threshold) -> DataFrame:
    return tx.filter(price_hit(threshold)).select(
        *tx.columns,
        F.lit(RULE_PRICE).alias("rule_triggered"),
        price_detail(threshold).alias("rule_detail"),
        price_leakage(threshold).alias("leakage_amount_gbp"),
    )


# ---------------------------------------------------------------------------
# Rule 3: SLA breach
# ---------------------------------------------------------------------------

def breach_days(grace_days: int) -> Column:
    return F.datediff("actual_delivery_date", "expected_delivery_date") - F.lit(int(grace_days))


def sla_hit(grace_days: int) -> Column:
    return F.coalesce(breach_days(grace_days) > 0, F.lit(False))


def sla_detail(days: Column) -> Column:
    return F.concat(
        F.lit("Delivery "), days.cast("string"), F.lit(" days late: expected "),
        iso_date("expected_delivery_date"), F.lit(", actual "), iso_date("actual_delivery_date"),
    )


def sla_leakage(days: Column, penalty_per_day: float) -> Column:
    return array_round(days * F.lit(float(penalty_per_day)), 2)


def detect_sla_breaches(
    tx: DataFrame,
    grace_days: int = DEFAULT_DETECTION.grace_days,
    penalty_per_day: float = DEFAULT_DETECTION.penalty_per_day,
) -> DataFrame:
    days = F.col("breach_days")
    return (
        tx.withColumn("breach_days", breach_days(grace_days))
        .filter(days > 0)
        .select(
            *tx.columns,
            days,
            F.lit(RULE_SLA).alias("rule_triggered"),
            sla_detail(days).alias("rule_detail"),
            sla_leakage(days, penalty_per_day).alias("leakage_amount_gbp"),
        )
    )


# ---------------------------------------------------------------------------
# Rule 4: volume spikes
# ---------------------------------------------------------------------------

def daily_counts(tx: DataFrame) -> DataFrame:
    """Transactions per observed day (days without rows are absent)."""
    return tx.filter(F.col("date").isNotNull()).groupBy("date").agg(F.count(F.lit(1)).alias("daily_count"))


def volume_baseline_from(daily: DataFrame, p: DetectionParams = DEFAULT_DETECTION) -> DataFrame:
    """Rolling baseline over the previous ``rolling_window`` observed days.

    The current day is excluded; fewer than ``min_history`` values give a
    null baseline (never a spike).  The window has no partition key, but it
    runs over one row per calendar day, so its size is bounded by the date
    span, not by the data.
    """
    w = Window.orderBy("date").rowsBetween(-p.rolling_window, -1)
    n = F.count("daily_count").over(w)
    enough = n >= F.lit(p.min_history)
    mean = F.when(enough, F.avg("daily_count").over(w))
    std = F.when(enough, F.stddev_samp("daily_count").over(w))
    out = daily.select("date", "daily_count", mean.alias("rolling_mean"), std.alias("rolling_std"))
    upper = F.col("rolling_mean") + F.lit(float(p.spike_sigma)) * F.col("rolling_std")
    return out.withColumn("upper_bound", upper).withColumn(
        "is_spike", F.coalesce(F.col("daily_count") > F.col("upper_bound"), F.lit(False))
    )


def volume_baseline(tx: DataFrame, p: DetectionParams = DEFAULT_DETECTION) -> DataFrame:
    return volume_baseline_from(daily_counts(tx), p)


def spike_days_of(daily: DataFrame, p: DetectionParams = DEFAULT_DETECTION) -> DataFrame:
    """Spike days with their statistics: at most one row per calendar day, so small enough to broadcast."""
    return volume_baseline_from(daily, p).filter("is_spike").select("date", "daily_count", "rolling_mean", "rolling_std")


def spike_days(tx: DataFrame, p: DetectionParams = DEFAULT_DETECTION) -> DataFrame:
    return spike_days_of(daily_counts(tx), p)


def spike_detail(sigma: float) -> Column:
    threshold = F.col("rolling_mean") + F.lit(float(sigma)) * F.col("rolling_std")
    return F.concat(
        F.lit("Date "), iso_date("date"), F.lit(": "), F.col("daily_count").cast("string"),
        F.lit(" transactions (baseline mean="), fixed("rolling_mean", 1),
        F.lit(", std="), fixed("rolling_std", 1),
        F.lit(", threshold="), fixed(threshold, 1), F.lit(")"),
    )


def detect_volume_spikes(
    tx: DataFrame,
    sigma_threshold: float = DEFAULT_DETECTION.spike_sigma,
    rolling_window: int = DEFAULT_DETECTION.rolling_window,
) -> DataFrame:
    p = DetectionParams(spike_sigma=sigma_threshold, rolling_window=rolling_window)
    spikes = spike_days(tx, p)
    return tx.join(F.broadcast(spikes), "date").select(
        *tx.columns,
        "daily_count",
        "rolling_mean",
        "rolling_std",
        F.lit(RULE_SPIKE).alias("rule_triggered"),
        spike_detail(p.spike_sigma).alias("rule_detail"),
        F.lit(0.0).alias("leakage_amount_gbp"),
    )


# ---------------------------------------------------------------------------
# Rule registry (extension point: add a function frame -> flags and a base score)
# ---------------------------------------------------------------------------

RULE_REGISTRY = {
    RULE_DUPLICATE: lambda tx, p: detect_duplicates(tx, p.window_days),
    RULE_PRICE: lambda tx, p: detect_price_variance(tx, p.price_threshold),
    RULE_SLA: lambda tx, p: detect_sla_breaches(tx, p.grace_days, p.penalty_per_day),
    RULE_SPIKE: lambda tx, p: detect_volume_spikes(tx, p.spike_sigma, p.rolling_window),
}
BUILT_IN_RULES = frozenset(RULE_REGISTRY)


def register_rule(name: str, fn) -> None:
    """Add a rule: ``fn(transactions, DetectionParams) -> flagged rows`` with
    ``rule_triggered``, ``rule_detail`` and ``leakage_amount_gbp`` added.  Give
    it a base score through ``ScoringParams.base_scores`` (unknown rules score
    30).  Registered rules join every detection run, and their own columns stay
    in the flag table. The built-in rules cannot be replaced."""
    if name in BUILT_IN_RULES:
        raise ValueError(f"{name} is a built-in rule")
    RULE_REGISTRY[name] = fn


def unregister_rule(name: str) -> None:
    if name in BUILT_IN_RULES:
        raise ValueError(f"{name} is a built-in rule")
    RULE_REGISTRY.pop(name, None)
