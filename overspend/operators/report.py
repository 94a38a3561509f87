"""Report tables over the scored flags: executive summary, breakdowns, trends,
chart frames, KPI tiles, top findings and the alert digest.

Every table is a DataFrame (nothing is collected to the driver).  Money is
summed exactly (``money_total``).  Windows without a partition key appear only
over already-aggregated frames whose size is bounded by a small domain (the
rules, the severities, the top-N list, the categories), never over flags.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..config import DEFAULT_REPORT, DEFAULT_SCORING, ReportParams, ScoringParams
from ..constants import (
    ALERT_NO_ITEMS,
    KPI_LABELS,
    RULE_LABELS,
    RULE_LABELS_SHORT,
    SEVERITY_LABELS_ASC,
    SEVERITY_LABELS_DESC,
    SEVERITY_RANK,
)
from ..functions.numeric import MONEY, array_round, exact_sum, money_total
from ..functions.scoring import lookup
from ..functions.text import fixed, grouped

def _sev() -> Column:
    return F.col("severity")


def _sev_count(label: str) -> Column:
    return F.count(F.when(_sev() == label, F.lit(1)))


def rule_label(rule: Column, labels: dict = RULE_LABELS) -> Column:
    return F.coalesce(lookup(labels, rule), rule)


# ---------------------------------------------------------------------------
# Executive summary and its breakdowns
# ---------------------------------------------------------------------------

def executive_summary(tx: DataFrame, scored: DataFrame, p: ScoringParams = DEFAULT_SCORING) -> DataFrame:
    """Headline figures (one row): leakage, distinct flagged transactions,
    flags, the four severity counts, transactions analysed, date range,
    currency.

    Two one-row aggregates (transactions; flags, with the distinct id count
    over the narrow flag projection) are stacked and folded with one more
    aggregation: no raw transaction row is expanded and nothing is joined.
    """
    tx_part = tx.agg(
        F.count(F.lit(1)).alias("total_transactions_analysed"),
        F.min("date").alias("_min_date"),
        F.max("date").alias("_max_date"),
    )
    flag_part = scored.select("transaction_id", "leakage_amount_gbp", "severity").agg(
        money_total("leakage_amount_gbp").alias("headline_gbp"),
        F.countDistinct("transaction_id").alias("headline_transactions"),
        F.count(F.lit(1)).alias("total_flags"),
        *[_sev_count(s).alias(f"{s.lower()}_count") for s in SEVERITY_LABELS_DESC],
    )
    stacked = tx_part.unionByName(flag_part, allowMissingColumns=True)
    folded = stacked.agg(*[F.max(c).alias(c) for c in stacked.columns])
    return folded.select(
        "headline_gbp",
        F.coalesce("headline_transactions", F.lit(0)).alias("headline_transactions"),
        F.coalesce("total_flags", F.lit(0)).alias("total_flags"),
        *[F.coalesce(f"{s.lower()}_count", F.lit(0)).alias(f"{s.lower()}_count") for s in SEVERITY_LABELS_DESC],
        F.coalesce("total_transactions_analysed", F.lit(0)).alias("total_transactions_analysed"),
        F.date_format("_min_date", "yyyy-MM-dd").alias("date_range_start"),
        F.date_format("_max_date", "yyyy-MM-dd").alias("date_range_end"),
        F.lit(p.currency).alias("currency"),
    )


def severity_breakdown(scored: DataFrame) -> DataFrame:
    """Flags per severity; all four labels present, zero when absent."""
    counts = scored.agg(*[_sev_count(s).alias(s) for s in SEVERITY_LABELS_DESC])
    pairs = ", ".join(f"'{s}', `{s}`" for s in SEVERITY_LABELS_DESC)
    return counts.select(F.expr(f"stack({len(SEVERITY_LABELS_DESC)}, {pairs}) as (severity, flags)")).withColumn(
        "severity_rank", lookup(SEVERITY_RANK, _sev()).cast("int")
    )


def leakage_by_category(scored: DataFrame) -> DataFrame:
    """Leakage per category, ranked descending (ties by name)."""
    agg = scored.filter(F.col("category").isNotNull()).groupBy("category").agg(
        money_total("leakage_amount_gbp").alias("leakage_gbp")
    )
    # one row per category: a small domain
    w = Window.orderBy(F.col("leakage_gbp").desc(), F.col("category"))
    return agg.withColumn("rank", F.row_number().over(w))


def top_suppliers(scored: DataFrame, n: int = DEFAULT_REPORT.top_suppliers) -> DataFrame:
    """Top-n suppliers by leakage (ties by name), ranked 1..n."""
    agg = scored.filter(F.col("supplier_name").isNotNull()).groupBy("supplier_name").agg(
        money_total("leakage_amount_gbp").alias("leakage_gbp")
    )
    top = agg.orderBy(F.col("leakage_gbp").desc(), F.col("supplier_name")).limit(n)
    return top.withColumn("rank", F.row_number().over(Window.orderBy(F.col("leakage_gbp").desc(), F.col("supplier_name"))))


def scored_by_rule(scored: DataFrame) -> DataFrame:
    """Flags (counting ids) and leakage per rule."""
    return scored.filter(F.col("rule_triggered").isNotNull()).groupBy("rule_triggered").agg(
        F.count("transaction_id").alias("count"),
        money_total("leakage_amount_gbp").alias("leakage_gbp"),
    )


def rule_share(scored: DataFrame) -> DataFrame:
    """Rule table of the summary sheet: display name, flags, leakage and the
    share of the headline total as text ``x.x%`` (a zero total counts as 1)."""
    by_rule = scored_by_rule(scored)
    total = F.sum("leakage_gbp").over(Window.partitionBy())  # over <= #rules rows
    denom = F.when(total == 0, F.lit(1.0)).otherwise(total.cast("double"))
    pct = F.col("leakage_gbp").cast("double") / denom * F.lit(100.0)
    return by_rule.select(
        "rule_triggered",
        rule_label(F.col("rule_triggered")).alias("rule"),
        F.col("count").alias("flags"),
        "leakage_gbp",
        F.concat(fixed(pct, 1), F.lit("%")).alias("share_of_total"),
    )


def rule_performance(scored: DataFrame) -> DataFrame:
    """Rule statistics: flags, severity counts, total / average / max leakage."""
    agg = scored.filter(F.col("rule_triggered").isNotNull()).groupBy("rule_triggered").agg(
        F.count(F.lit(1)).alias("total_flags"),
        *[_sev_count(s).alias(s.lower()) for s in SEVERITY_LABELS_DESC],
        exact_sum("leakage_amount_gbp").alias("_sum"),
        F.max("leakage_amount_gbp").alias("_max"),
    )
    return agg.select(
        "rule_triggered",
        rule_label(F.col("rule_triggered"), RULE_LABELS_SHORT).alias("rule"),
        "total_flags",
        *[s.lower() for s in SEVERITY_LABELS_DESC],
        F.bround(F.col("_sum"), 2).cast(MONEY).alias("total_leakage_gbp"),
        F.bround(F.col("_sum") / F.col("total_flags"), 2).cast(MONEY).alias("avg_leakage_gbp"),
        array_round(F.col("_max"), 2).alias("max_leakage_gbp"),
    )


def daily_trend(scored: DataFrame) -> DataFrame:
    """Per flag date: flags, leakage and Critical flags; ``day_order`` is the display order."""
    daily = scored.filter(F.col("date").isNotNull()).groupBy("date").agg(
        F.count("transaction_id").alias("flags"),
        money_total("leakage_amount_gbp").alias("leakage_gbp"),
        _sev_count("Critical").alias("critical"),
    )
    # one row per calendar day: a small domain
    return daily.withColumn("day_order", F.row_number().over(Window.orderBy("date")))


def severity_heatmap(scored: DataFrame) -> DataFrame:
    """Rule × severity flag counts, zero-filled, columns Low … Critical."""
    counts = (
        scored.filter(F.col("rule_triggered").isNotNull())
        .groupBy("rule_triggered")
        .pivot("severity", list(SEVERITY_LABELS_ASC))
        .count()
        .fillna(0, subset=list(SEVERITY_LABELS_ASC))
    )
    return counts.select(
        "rule_triggered",
        rule_label(F.col("rule_triggered")).alias("rule"),
        *[F.col(s).cast("long").alias(s) for s in SEVERITY_LABELS_ASC],
    )


def category_rule_leakage(scored: DataFrame) -> DataFrame:
    """Leakage per (category, rule); ``bar_order`` is the display order within a rule, smallest first."""
    totals = (
        scored.filter(F.col("category").isNotNull() & F.col("rule_triggered").isNotNull())
        .groupBy("category", "rule_triggered")
        .agg(money_total("leakage_amount_gbp").alias("leakage_gbp"))
    )
    w = Window.partitionBy("rule_triggered").orderBy("leakage_gbp", "category")  # one row per category
    return totals.withColumn("bar_order", F.row_number().over(w))


#: Grouping sets of ``breakdowns`` and their names.
BREAKDOWNS = {
    "rule": ("rule_triggered",),
    "severity": ("severity",),
    "category": ("category",),
    "rule_severity": ("rule_triggered", "severity"),
    "category_rule": ("category", "rule_triggered"),
}


def breakdowns(scored: DataFrame) -> DataFrame:
    """All breakdowns of the report from one evaluation of the flags.

    The flags are aggregated once, to (category, rule, severity), with partial
    aggregation before the shuffle; the grouping sets then work on these few
    rows. ``breakdown`` names the set; a column that is not in it is null, and
    groups without a key are left out. ``with_amount`` counts flags with a
    leakage. Totals are exact.
    """
    keys = ["category", "rule_triggered", "severity"]
    labels = [x.lower() for x in SEVERITY_LABELS_DESC]
    fine = scored.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("flags"),
        F.count("leakage_amount_gbp").alias("with_amount"),
        exact_sum("leakage_amount_gbp").alias("_sum"),
        F.max("leakage_amount_gbp").alias("_max"),
    )
    sets = fine.groupingSets([list(x) for x in BREAKDOWNS.values()], *keys).agg(
        F.grouping_id().alias("_set"),
        F.sum("flags").alias("flags"),
        F.sum("with_amount").alias("with_amount"),
        *[F.coalesce(F.sum(F.when(F.col("severity") == x, F.col("flags"))), F.lit(0)).alias(x.lower()) for x in SEVERITY_LABELS_DESC],
        F.sum("_sum").alias("_sum"),
        F.max("_max").alias("_max"),
    )
    # a bit of the grouping id is set for each key that the set leaves out
    name, nameless = F.lit(None).cast("string"), F.lit(False)
    for label, of in BREAKDOWNS.items():
        bits = sum((c not in of) << (len(keys) - 1 - k) for k, c in enumerate(keys))
        here = F.col("_set") == bits
        name = F.when(here, F.lit(label)).otherwise(name)
        for c in of:
            nameless = nameless | (here & F.col(c).isNull())
    return sets.where(~nameless).select(
        name.alias("breakdown"),
        *keys,
        "flags",
        "with_amount",
        *labels,
        F.bround(F.col("_sum"), 2).cast(MONEY).alias("leakage_gbp"),
        F.bround(F.col("_sum") / F.col("flags"), 2).cast(MONEY).alias("avg_leakage_gbp"),
        array_round(F.col("_max"), 2).alias("max_leakage_gbp"),
    )


def monthly_totals(tx: DataFrame, flags: DataFrame) -> DataFrame:
    """Flags and leakage of every rule in every month from the first to the last transaction; zero where nothing was found."""
    span = tx.agg(F.min("date").alias("lo"), F.max("date").alias("hi"))
    months = span.select(F.explode(F.sequence(F.trunc("lo", "month"), F.trunc("hi", "month"), F.expr("interval 1 month"))).alias("month"))
    calendar = months.withColumn("rule_triggered", F.explode(F.array(*[F.lit(r) for r in RULE_LABELS])))
    found = flags.groupBy(F.trunc("date", "month").alias("month"), "rule_triggered").agg(
        F.count(F.lit(1)).alias("flags"), money_total("leakage_amount_gbp").alias("leakage_gbp")
    )
    return calendar.join(found, ["month", "rule_triggered"], "left").select(
        "month",
        "rule_triggered",
        F.coalesce("flags", F.lit(0).cast("long")).alias("flags"),
        F.coalesce("leakage_gbp", F.lit(0).cast(MONEY)).alias("leakage_gbp"),
    )


def supplier_exposure(scored: DataFrame, n: int = DEFAULT_REPORT.exposure_suppliers) -> DataFrame:
    """Top-n suppliers × every rule seen among them, zero-filled.

    ``supplier_order`` ranks suppliers by their total ascending (chart order).
    Densification explodes the (small) set of rules per supplier instead of a
    cross join; all frames here are bounded by n × number of rules.
    """
    # one evaluation of the flags: per supplier its totals by rule (as many as rules), then the n largest
    per_supplier = (
        scored.filter(F.col("supplier_name").isNotNull())
        .groupBy("supplier_name", "rule_triggered")
        .agg(money_total("leakage_amount_gbp").alias("leakage_gbp"), exact_sum("leakage_amount_gbp").alias("_exact"))
        .groupBy("supplier_name")
        .agg(
            F.map_from_entries(F.collect_list(F.struct("rule_triggered", "leakage_gbp"))).alias("_by_rule"),
            F.sum("leakage_gbp").alias("_total"),
            F.coalesce(F.bround(F.sum("_exact"), 2), F.lit(0)).alias("_rank"),
        )
    )
    top = per_supplier.orderBy(F.col("_rank").desc(), F.col("supplier_name")).limit(n)
    rules = F.array_sort(F.array_distinct(F.flatten(F.collect_list(F.map_keys("_by_rule")).over(Window.partitionBy()))))
    dense = top.withColumn("_rules", rules).select(
        "supplier_name", "_total", F.explode("_rules").alias("rule_triggered"), "_by_rule"
    ).select(
        "supplier_name",
        "_total",
        "rule_triggered",
        F.coalesce(F.element_at("_by_rule", F.col("rule_triggered")), F.lit(0).cast(MONEY)).cast(MONEY).alias("leakage_gbp"),
    )
    order = F.dense_rank().over(Window.orderBy(F.col("_total").asc(), F.col("supplier_name").asc()))
    return dense.select(
        order.alias("supplier_order"),
        "supplier_name",
        "rule_triggered",
        rule_label(F.col("rule_triggered")).alias("rule"),
        "leakage_gbp",
    )


def kpi_tiles(summary: DataFrame) -> DataFrame:
    """The seven KPI tiles (position, label, value text) from the executive summary."""
    values = [
        F.concat(F.lit("£"), grouped(F.col("headline_gbp"), 2)),
        F.format_number(F.col("total_transactions_analysed"), 0),
        F.format_number(F.col("total_flags"), 0),
        F.col("critical_count").cast("string"),
        F.col("high_count").cast("string"),
        F.col("medium_count").cast("string"),
        F.col("low_count").cast("string"),
    ]
    tiles = F.array(
        *[
            F.struct(F.lit(i + 1).alias("position"), F.lit(label).alias("label"), v.alias("value"))
            for i, (label, v) in enumerate(zip(KPI_LABELS, values))
        ]
    )
    return summary.select(F.inline(tiles))


# ---------------------------------------------------------------------------
# Findings and alerts
# ---------------------------------------------------------------------------

def top_findings(scored: DataFrame, n: int = DEFAULT_REPORT.alert_items, severity: str = "Critical") -> DataFrame:
    """The n findings of a severity with the largest leakage (distributed top-k)."""
    order = [F.col("leakage_amount_gbp").desc_nulls_last(), F.col("transaction_id"), F.col("rule_triggered")]
    top = scored.filter(_sev() == severity).orderBy(*order).limit(n)
    return top.select(
        F.row_number().over(Window.orderBy(*order)).alias("rank"),
        "transaction_id",
        "supplier_name",
        "rule_triggered",
        "leakage_amount_gbp",
        "severity",
    )


def alert_digest(summary: DataFrame, scored: DataFrame, p: ReportParams = DEFAULT_REPORT) -> DataFrame:
    """Alert content (one row), or no row when nothing reaches the alert severity.

    Fields: the gate severity and its count, headline leakage, Critical and
    High counts, transactions analysed, period, and the top findings as
    text lines (or a fixed note when there are none).
    """
    items = top_findings(scored, p.alert_items, p.alert_severity)
    # The alert line, as it appears in the output.
    line = F.concat(
        F.lit("• *"), F.coalesce(F.col("transaction_id"), F.lit("N/A")), F.lit("* | "),
        F.coalesce(F.col("supplier_name"), F.lit("Unknown")), F.lit(" | Rule: `"),
        F.coalesce(F.col("rule_triggered"), F.lit("N/A")), F.lit("` | Est. leakage: *£"),
        grouped(F.coalesce(F.col("leakage_amount_gbp"), F.lit(0.0)), 2), F.lit("*"),
    )
    lines = items.agg(
        F.array_sort(F.collect_list(F.struct(F.col("rank"), line.alias("line")))).alias("_items")
    ).select(F.concat_ws("\n", F.transform("_items", lambda x: x["line"])).alias("_text"))
    gate_col = f"{p.alert_severity.lower()}_count"
    head = summary.select(
        F.col(gate_col).alias("alert_count"),
        "headline_gbp",
        "critical_count",
        "high_count",
        "total_transactions_analysed",
        F.concat(F.col("date_range_start"), F.lit(" → "), F.col("date_range_end")).alias("period"),
    )
    # two one-row frames combined by stacking and one aggregation (no join)
    stacked = head.withColumn("_text", F.lit(None).cast("string")).unionByName(lines, allowMissingColumns=True)
    combined = stacked.agg(*[F.max(c).alias(c) for c in head.columns], F.max("_text").alias("_text"))
    digest = combined.select(
        F.lit(p.alert_severity).alias("alert_severity"),
        *head.columns,
        F.when(F.coalesce(F.col("_text"), F.lit("")) == "", F.lit(ALERT_NO_ITEMS)).otherwise(F.col("_text")).alias(
            "top_findings"
        ),
    )
    return digest.filter(F.col("alert_count") > 0)


def alert_payload(digest: DataFrame) -> DataFrame:
    """The digest with its fields also as one JSON document (``payload``)."""
    return digest.withColumn("payload", F.to_json(F.struct(*digest.columns)))


# ---------------------------------------------------------------------------
# Detail table
# ---------------------------------------------------------------------------

# Detail-table columns and their display headers, in order.
DETAIL_HEADERS = {
    "transaction_id": "Transaction ID",
    "date": "Date",
    "supplier_name": "Supplier",
    "category": "Category",
    "region": "Region",
    "invoice_amount": "Invoice Amt (£)",
    "baseline_rate": "Baseline Rate (£)",
    "leakage_amount_gbp": "Leakage Est. (£)",
    "rule_triggered": "Rule",
    "severity": "Severity",
    "composite_score": "Score",
    "rule_detail": "Detail",
    "action_required": "Action Required",
    "approved_by": "Approved By",
}


def flagged_items(scored: DataFrame, limit: int | None = None) -> DataFrame:
    """The detail table: the display columns that exist, under their headers.

    ``limit`` (default none) keeps the first rows in review order.
    """
    present = [c for c in DETAIL_HEADERS if c in scored.columns]
    out = scored
    if limit is not None:
        from .score import scored_order

        out = out.orderBy(*scored_order()).limit(limit)
    return out.select(*[F.col(c).alias(DETAIL_HEADERS[c]) for c in present])
