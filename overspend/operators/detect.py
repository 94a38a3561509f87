"""All rules together: the flag table (one row per transaction and rule) and
the run summary.

Two equivalent plans are offered:

* ``all_flags`` (default): all four rules are evaluated on one pass over the
  whole rows, to which spike days and flagged ids are joined; those come from
  narrow passes. One row per (id, rule) is chosen before the texts of the
  findings are built. One plan at every size: nothing runs while it is built,
  no frame stays persisted, no row count switches it.
* ``all_flags_union``: the four rule operators unioned by name, the plain
  composition; used as the cross-check.

Both keep one row per (transaction, rule) and return the superset schema:
transaction columns, ``FLAG_COLUMNS``, and what registered rules add.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..config import DEFAULT_DETECTION, DetectionParams
from ..constants import RULE_DUPLICATE, RULE_PRICE, RULE_SLA, RULE_SPIKE
from ..functions.numeric import money_total
from . import rules as R

FLAG_TYPES = {
    "rule_triggered": T.StringType(),
    "rule_detail": T.StringType(),
    "leakage_amount_gbp": T.DoubleType(),
    "breach_days": T.IntegerType(),
    "daily_count": T.LongType(),
    "rolling_mean": T.DoubleType(),
    "rolling_std": T.DoubleType(),
}


def normalize_flags(flags: DataFrame, tx_columns: list[str]) -> DataFrame:
    """Project a flag frame onto transaction columns, every flag column, and its own further columns."""
    present = set(flags.columns)
    extra = [
        (F.col(c) if c in present else F.lit(None)).cast(t).alias(c) for c, t in FLAG_TYPES.items()
    ]
    own = [F.col(c) for c in flags.columns if c not in FLAG_TYPES and c not in tx_columns]
    return flags.select(*[F.col(c) for c in tx_columns], *extra, *own)


def dedupe_flags(flags: DataFrame) -> DataFrame:
    """Keep one row per (transaction_id, rule_triggered): the earliest, then the one of smallest hash.

    Spark keeps only the first row of each group in every task before the
    shuffle (a window group limit), so a hot id never meets in one task, and
    the kept row does not depend on the partitioning. Columns without a hash
    (maps) don't take part in the order.
    """
    hashed = [f.name for f in flags.schema.fields if "map<" not in f.dataType.simpleString()]
    order = [F.col(c).asc_nulls_last() for c in ("date",) if c in flags.columns]
    w = Window.partitionBy("transaction_id", "rule_triggered").orderBy(*order, F.xxhash64(*hashed))
    return flags.withColumn("_nth", F.row_number().over(w)).filter(F.col("_nth") == 1).drop("_nth")


def _union(frames: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def all_flags_union(tx: DataFrame, p: DetectionParams = DEFAULT_DETECTION) -> DataFrame:
    return dedupe_flags(_union([normalize_flags(fn(tx, p), tx.columns) for fn in R.RULE_REGISTRY.values()]))


def _null(t: T.DataType) -> Column:
    return F.lit(None).cast(t)


def _hit(rule: str, detail: Column, leakage: Column, breach=None, daily=None, mean=None, std=None) -> Column:
    return F.struct(
        F.lit(rule).alias("rule_triggered"),
        detail.alias("rule_detail"),
        leakage.cast("double").alias("leakage_amount_gbp"),
        (breach if breach is not None else _null(T.IntegerType())).cast("int").alias("breach_days"),
        (daily if daily is not None else _null(T.LongType())).cast("long").alias("daily_count"),
        (mean if mean is not None else _null(T.DoubleType())).alias("rolling_mean"),
        (std if std is not None else _null(T.DoubleType())).alias("rolling_std"),
    )


def _explode_hits(frame: DataFrame, tx_columns: list[str], hits: list[Column]) -> DataFrame:
    # explode + filter (both code-generated) rather than a higher-order
    # array filter, which would fall back to interpreted evaluation
    return (
        frame.select(*tx_columns, F.explode(F.array(*hits)).alias("_hit"))
        .filter(F.col("_hit").isNotNull())
        .select(*tx_columns, *[F.col(f"_hit.{c}").alias(c) for c in FLAG_TYPES])
    )


#: Words of 64 bits, a power of two, that the hashes of flagged ids are folded into. Fixed, so that what is broadcast is bounded: the more
#: ids are flagged, the more rows without a finding pass the filter, and the join drops those.
FOLDED_WORDS = 1 << 20


def _may_hit(marked: DataFrame, flagged: DataFrame, local: Column) -> DataFrame:
    """Rows of ``marked`` that a rule finds by themselves (``local``), or whose id may be in ``flagged``.

    Both have ``_known`` and ``_unknown``. A set of hash bits stands for the
    flagged ids: no flagged id is missed, and other rows that pass are left to
    the join on the id.
    """
    h = F.xxhash64("_known", "_unknown")
    # none of these can be null: a condition on it would make the shuffle of Rule 1's rows another one for this use
    word, bit = F.shiftright(h, 6).bitwiseAND(F.lit(FOLDED_WORDS - 1)), h.bitwiseAND(F.lit(63)).cast("int")
    one = F.call_function("shiftleft", F.lit(1).cast("long"), bit)
    folded = flagged.groupBy(word.alias("_word")).agg(F.bit_or(one).alias("_bits"))
    met = marked.withColumn("_word", word).join(F.broadcast(folded), "_word", "left")
    return met.filter(local | (F.getbit(F.coalesce(F.col("_bits"), F.lit(0).cast("long")), bit) == 1)).drop("_word", "_bits")


def _built_in_hits(tx: DataFrame, p: DetectionParams) -> DataFrame:
    """``tx`` with one row per rule that it hits, ``rule_triggered``, and what the findings are built from.

    One pass over the whole rows: spike days come by a broadcast (at most one
    row per calendar day), flagged ids by a join on the id, for which only rows
    are dealt that some rule may find. Texts and amounts
    of the findings come later, in :func:`_finished`. ``_tie`` is a hash of
    the whole transaction, taken before the rules, so that later steps need
    only the columns they return.
    """
    hashed = [f"`{f.name}`" for f in tx.schema.fields if "map<" not in f.dataType.simpleString()]
    spikes = R.spike_days(tx, p)
    flagged = R.duplicate_ids(tx, p.window_days)

    def by_id(df: DataFrame, name: str) -> DataFrame:
        return df.withColumns({"_known": F.coalesce(F.col(name).cast("string"), F.lit("")), "_unknown": F.col(name).isNull()})

    # the id goes by two columns without nulls: the join deals the rows by them, and the choice of one row per id then needs
    # no second shuffle of whole rows. Flagged ids are distinct and narrow: hashed, so that the rows need no sort for the join
    marked = by_id(tx.withColumn("_tie", F.xxhash64(*hashed)), "transaction_id").join(F.broadcast(spikes), "date", "left")
    if tx.schema["transaction_id"].dataType == T.StringType():
        marked = marked.drop("transaction_id")  # made again from the two
    flagged = by_id(flagged, "_flagged_id").select("_known", "_unknown")
    price, sla, spike = R.price_hit(p.price_threshold), R.sla_hit(p.grace_days), F.col("daily_count").isNotNull()
    marked = _may_hit(marked, flagged, price | sla | spike)
    marked = marked.join(flagged.withColumn("_duplicate", F.lit(True)).hint("shuffle_hash"), ["_known", "_unknown"], "left")
    hits = [
        F.when(F.col("_duplicate"), F.lit(RULE_DUPLICATE)),
        F.when(price, F.lit(RULE_PRICE)),
        F.when(sla, F.lit(RULE_SLA)),
        F.when(spike, F.lit(RULE_SPIKE)),
    ]
    # explode + filter (both code-generated) rather than a higher-order array filter
    return marked.withColumn("rule_triggered", F.explode(F.array(*hits))).filter(F.col("rule_triggered").isNotNull()).drop("_duplicate")


def _finished(hits: DataFrame, cols: list[str], p: DetectionParams) -> DataFrame:
    """Texts, amounts and statistics of the findings that are kept."""
    rule, breach = F.col("rule_triggered"), R.breach_days(p.grace_days)

    def by_rule(duplicate: Column, price: Column, sla: Column, spike: Column) -> Column:
        return F.when(rule == RULE_DUPLICATE, duplicate).when(rule == RULE_PRICE, price).when(rule == RULE_SLA, sla).otherwise(spike)

    made = {
        "rule_detail": by_rule(
            R.duplicate_detail(p.window_days), R.price_detail(p.price_threshold), R.sla_detail(breach), R.spike_detail(p.spike_sigma)
        ),
        "leakage_amount_gbp": by_rule(
            F.col("invoice_amount"), R.price_leakage(p.price_threshold), R.sla_leakage(breach, p.penalty_per_day), F.lit(0.0)
        ),
        "breach_days": F.when(rule == RULE_SLA, breach),
        **{c: F.when(rule == RULE_SPIKE, F.col(c)) for c in ("daily_count", "rolling_mean", "rolling_std")},
    }
    return hits.select(*[F.col(f"`{c}`") for c in cols], *[made.get(c, F.col(c)).cast(t).alias(c) for c, t in FLAG_TYPES.items()])


def all_flags(tx: DataFrame, p: DetectionParams = DEFAULT_DETECTION) -> DataFrame:
    """One row per (transaction_id, rule_triggered) that a rule finds.

    Of several rows with one id, a rule keeps the earliest by date (no date:
    last), then the one of smallest hash.
    """
    order = [F.col("date").asc_nulls_last(), F.col("_tie")]
    w = Window.partitionBy("_known", "_unknown", "rule_triggered").orderBy(*order)
    hits = _built_in_hits(tx, p).withColumn("_nth", F.row_number().over(w)).filter(F.col("_nth") == 1)
    if "transaction_id" not in hits.columns:
        hits = hits.withColumn("transaction_id", F.when(~F.col("_unknown"), F.col("_known")))
    flags = _finished(hits, tx.columns, p)
    # rules registered on top of the built-in four
    more = [normalize_flags(fn(tx, p), tx.columns) for name, fn in R.RULE_REGISTRY.items() if name not in R.BUILT_IN_RULES]
    return dedupe_flags(_union([flags, *more])) if more else flags


def run_detection(tx: DataFrame, p: DetectionParams = DEFAULT_DETECTION) -> tuple[DataFrame, DataFrame]:
    """The whole detection run: (flag table, one-row run summary)."""
    flags = all_flags(tx, p)
    return flags, run_summary(tx, flags)


def run_summary(tx: DataFrame, flags: DataFrame) -> DataFrame:
    """Transactions analysed, flags raised, total leakage and date range (one row).

    Both inputs are stacked into one aggregation rather than joined.
    """
    stacked = tx.select(
        F.lit(1).alias("_is_tx"), F.col("date").alias("_date"), F.lit(None).cast("double").alias("_leak")
    ).unionByName(
        flags.select(F.lit(0).alias("_is_tx"), F.lit(None).cast("date").alias("_date"), F.col("leakage_amount_gbp").alias("_leak"))
    )
    return stacked.agg(
        F.count(F.when(F.col("_is_tx") == 1, F.lit(1))).alias("total_transactions"),
        F.count(F.when(F.col("_is_tx") == 0, F.lit(1))).alias("total_flagged"),
        money_total("_leak").alias("total_leakage_gbp"),
        F.date_format(F.min("_date"), "yyyy-MM-dd").alias("date_range_start"),
        F.date_format(F.max("_date"), "yyyy-MM-dd").alias("date_range_end"),
    )


def leakage_by_rule(flags: DataFrame) -> DataFrame:
    """Flags (non-null leakage) and total leakage per rule."""
    return (
        flags.filter(F.col("rule_triggered").isNotNull())
        .groupBy("rule_triggered")
        .agg(
            F.count("leakage_amount_gbp").alias("count"),
            money_total("leakage_amount_gbp").alias("leakage_gbp"),
        )
    )


def run_stats(spike_days: Column) -> list[Column]:
    """Aggregates of :func:`rule_run_stats`, with the count of distinct spike days that is given."""
    rule = F.col("rule_triggered")
    return [
        F.count(F.when(rule == RULE_DUPLICATE, F.lit(1))).alias("duplicate_flags"),
        F.count(F.when(rule == RULE_PRICE, F.lit(1))).alias("price_flags"),
        money_total(F.when(rule == RULE_PRICE, F.col("leakage_amount_gbp"))).alias("price_leakage_gbp"),
        F.count(F.when(rule == RULE_SLA, F.lit(1))).alias("sla_flags"),
        F.coalesce(F.max(F.when(rule == RULE_SLA, F.col("breach_days"))), F.lit(0)).alias("sla_max_breach_days"),
        F.count(F.when(rule == RULE_SPIKE, F.lit(1))).alias("spike_flags"),
        spike_days.alias("spike_days"),
    ]


def spike_date() -> Column:
    return F.when(F.col("rule_triggered") == RULE_SPIKE, F.col("date"))


def rule_run_stats(flags: DataFrame) -> DataFrame:
    """Per-rule run statistics: duplicate hits, price leakage, worst SLA breach,
    distinct spike days (one row)."""
    return flags.agg(*run_stats(F.countDistinct(spike_date())))
