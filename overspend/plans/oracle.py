"""DuckDB SQL for every registered query (the correctness oracle).

The SQL restates each operator from its definition (Rule 1 with ``lag``, the
scoring as ``CASE`` chains, …) over the same test tables.  Conventions shared
with the Spark side so values hash equal:

* numeric literals are written as ``CAST(x AS DOUBLE)`` (bare ``1.15`` is a
  DECIMAL in DuckDB);
* rounding uses the same two definitions as ``functions/numeric.py``;
* money totals go through the shortest decimal text of each double, as
  Spark's double→decimal cast does, then are summed exactly;
* ordered outputs carry an explicit rank column.
"""

from __future__ import annotations

from ..config import DEFAULT_DETECTION as DP
from ..config import DEFAULT_REPORT as RP
from ..config import DEFAULT_SCORING as SP
from ..constants import ACTIONS, ALERT_NO_ITEMS, KPI_LABELS, RULE_LABELS, RULE_LABELS_SHORT, SEVERITY_RANK
from ..operators.report import BREAKDOWNS, DETAIL_HEADERS
from ..sources.fixtures import COPY_EVERY, EXPECTED_DAYS


def dbl(x: float) -> str:
    x = float(x)
    if x != x or x in (float("inf"), float("-inf")):
        return f"CAST('{x}' AS DOUBLE)"
    return f"CAST({x!r} AS DOUBLE)"


def q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def array_round(e: str, d: int) -> str:
    if d == 0:
        return f"round_even(({e}), 0)"
    s = dbl(10**d)
    return f"(round_even(({e}) * {s}, 0) / {s})"


def exact_round(e: str, d: int) -> str:
    s = dbl(10**d)
    p = f"(({e}) * {s})"
    hi = f"({dbl(134217729.0)} * ({e}))"
    xh = f"({hi} - ({hi} - ({e})))"
    xl = f"(({e}) - {xh})"
    err = f"(({xh} * {s} - {p}) + {xl} * {s})"
    r = f"round_even({p}, 0)"
    tie = f"(abs({p} - {r}) = {dbl(0.5)})"
    return (
        f"((CASE WHEN {tie} AND {err} > 0 THEN {p} + {dbl(0.5)} "
        f"WHEN {tie} AND {err} < 0 THEN {p} - {dbl(0.5)} ELSE {r} END) / {s})"
    )


def grouped(e: str, d: int) -> str:
    return (
        f"(CASE WHEN isnan(({e})) THEN 'nan' WHEN ({e}) = {dbl(float('inf'))} THEN 'inf' "
        f"WHEN ({e}) = {dbl(float('-inf'))} THEN '-inf' ELSE format('{{:,.{d}f}}', CAST(({e}) AS DOUBLE)) END)"
    )


def fixed(e: str, d: int) -> str:
    return (
        f"(CASE WHEN isnan(({e})) THEN 'nan' WHEN ({e}) = {dbl(float('inf'))} THEN 'inf' "
        f"WHEN ({e}) = {dbl(float('-inf'))} THEN '-inf' ELSE format('{{:.{d}f}}', CAST(({e}) AS DOUBLE)) END)"
    )


def iso(e: str) -> str:
    return f"strftime(({e}), '%Y-%m-%d')"


def money_total(e: str) -> str:
    return f"COALESCE(CAST(round_even(SUM(CAST(CAST(({e}) AS VARCHAR) AS DECIMAL(38,18))), 2) AS DECIMAL(38,2)), CAST(0 AS DECIMAL(38,2)))"


def exact_sum(e: str) -> str:
    return f"SUM(CAST(CAST(({e}) AS VARCHAR) AS DECIMAL(38,18)))"


def case_map(key: str, mapping: dict, cast: str | None = None) -> str:
    whens = " ".join(f"WHEN {key} = {q(k)} THEN {v if not isinstance(v, str) else q(v)}" for k, v in mapping.items())
    out = f"(CASE {whens} END)"
    return f"CAST({out} AS {cast})" if cast else out


TX_COLS = [
    "transaction_id", "date", "supplier_id", "supplier_name", "category", "baseline_rate", "invoice_amount",
    "expected_delivery_date", "actual_delivery_date", "po_number", "region", "approved_by", "is_anomaly",
    "anomaly_type",
]
TXC = ", ".join(TX_COLS)
FLAG_NULLS = {
    "breach_days": "CAST(NULL AS INTEGER)",
    "daily_count": "CAST(NULL AS BIGINT)",
    "rolling_mean": "CAST(NULL AS DOUBLE)",
    "rolling_std": "CAST(NULL AS DOUBLE)",
}


def _flag_select(rule: str, detail: str, leakage: str, **given: str) -> str:
    extra = ", ".join(f"{given.get(c, v)} AS {c}" for c, v in FLAG_NULLS.items())
    return f"SELECT {TXC}, {q(rule)} AS rule_triggered, {detail} AS rule_detail, CAST({leakage} AS DOUBLE) AS leakage_amount_gbp, {extra}"


_days_case = " ".join(f"WHEN p_type = {q(k)} THEN {v}" for k, v in EXPECTED_DAYS.items())
_sid = "CAST(l_suppkey AS VARCHAR)"
_base_id = (
    "concat_ws('-', CAST(l_orderkey AS VARCHAR), CAST(l_linenumber AS VARCHAR), CAST(l_partkey AS VARCHAR), "
    f"{_sid}, strftime(ship, '%Y%m%d'))"
)
W = DP.window_days
T = DP.price_threshold
G = DP.grace_days
SIG = DP.spike_sigma
RW = DP.rolling_window

_ratio = "(invoice_amount / baseline_rate)"
_price_hit = f"((baseline_rate <> 0 AND {_ratio} > {dbl(T)}) OR (baseline_rate = 0 AND invoice_amount > 0))"
_pct = f"(CASE WHEN baseline_rate = 0 THEN {dbl(float('inf'))} ELSE ({_ratio} - {dbl(1.0)}) * {dbl(100.0)} END)"
_thr = f"{(T - 1) * 100:.0f}"

CTES = {
    "li": f"""li AS (
  SELECT l.l_orderkey, l.l_partkey, l.l_suppkey, l.l_linenumber, l.l_extendedprice, l.l_discount, l.l_tax,
         CAST(l.l_shipdate AS DATE) AS ship, s.s_name, r.r_name AS region, p.p_type
  FROM lineitem l
  JOIN supplier s ON l.l_suppkey = s.s_suppkey
  JOIN part p ON l.l_partkey = p.p_partkey
  LEFT JOIN nation n ON s.s_nationkey = n.n_nationkey
  LEFT JOIN region r ON n.n_regionkey = r.r_regionkey
)""",
    "li2": f"""li2 AS (
  SELECT *, false AS is_copy FROM li
  UNION ALL
  SELECT *, true AS is_copy FROM li WHERE l_orderkey % {COPY_EVERY} = 0  -- lines that also get a re-billed copy
)""",
    "tx": f"""tx AS MATERIALIZED (
  SELECT
    CASE WHEN is_copy THEN 'DUP-' || {_base_id} ELSE {_base_id} END AS transaction_id,
    CASE WHEN is_copy THEN ship + 1 ELSE ship END AS date,
    'SUP' || CASE WHEN length({_sid}) >= 6 THEN {_sid} ELSE lpad({_sid}, 6, '0') END AS supplier_id,
    s_name AS supplier_name,
    p_type AS category,
    l_extendedprice * (1 - l_discount) AS baseline_rate,
    l_extendedprice * (1 + l_tax) AS invoice_amount,
    ship + CAST(CASE {_days_case} END AS INTEGER) AS expected_delivery_date,
    ship + l_linenumber AS actual_delivery_date,
    'PO-' || CAST(l_orderkey AS VARCHAR) AS po_number,
    region,
    CAST(NULL AS VARCHAR) AS approved_by,
    is_copy AS is_anomaly,
    CASE WHEN is_copy THEN 'duplicate' ELSE '' END AS anomaly_type
  FROM li2
)""",
    "dups": f"""dup_ids AS MATERIALIZED (
  SELECT DISTINCT transaction_id FROM (
    SELECT transaction_id, date,
           lag(date) OVER (PARTITION BY supplier_id, round_even(invoice_amount, 0) ORDER BY date, transaction_id) AS prev_date
    FROM tx
    WHERE supplier_id IS NOT NULL AND invoice_amount IS NOT NULL AND date IS NOT NULL
  ) WHERE prev_date IS NOT NULL AND CAST(date - prev_date AS INTEGER) <= {W}
), dups AS (
  SELECT {TXC} FROM tx SEMI JOIN dup_ids USING (transaction_id)
)""",
    "dup_flags": f"""dup_flags AS (
  {_flag_select('duplicate', "'Duplicate of supplier ' || supplier_id || ' invoice £' || " + grouped('invoice_amount', 2) + f" || ' within {W}d window'", 'invoice_amount')}
  FROM dups
)""",
    "price_flags": f"""price_flags AS (
  {_flag_select('price_variance', "'Invoice £' || " + grouped('invoice_amount', 2) + " || ' is ' || " + fixed(_pct, 1) + " || '% above baseline £' || " + grouped('baseline_rate', 2) + f" || ' (threshold: {_thr}%)'", array_round(f'invoice_amount - baseline_rate * {dbl(T)}', 2))}
  FROM tx WHERE {_price_hit}
)""",
    "sla": f"""sla AS (
  SELECT *, CAST(actual_delivery_date - expected_delivery_date AS INTEGER) - {G} AS breach_days FROM tx
)""",
    "sla_flags": f"""sla_flags AS (
  {_flag_select('sla_breach', "'Delivery ' || CAST(breach_days AS VARCHAR) || ' days late: expected ' || " + iso('expected_delivery_date') + " || ', actual ' || " + iso('actual_delivery_date'), array_round(f'breach_days * {dbl(DP.penalty_per_day)}', 2), breach_days='breach_days')}
  FROM sla WHERE breach_days > 0
)""",
    "daily": """daily AS (
  SELECT date, count(*) AS daily_count FROM tx WHERE date IS NOT NULL GROUP BY date
)""",
    "stats": f"""stats AS (
  SELECT date, daily_count,
         CASE WHEN n >= {DP.min_history} THEN m END AS rolling_mean,
         CASE WHEN n >= {DP.min_history} THEN s END AS rolling_std
  FROM (
    SELECT date, daily_count,
           count(daily_count) OVER w AS n, avg(daily_count) OVER w AS m, stddev_samp(daily_count) OVER w AS s
    FROM daily
    WINDOW w AS (ORDER BY date ROWS BETWEEN {RW} PRECEDING AND 1 PRECEDING)
  )
)""",
    "baseline": f"""baseline AS (
  SELECT *, rolling_mean + {dbl(SIG)} * rolling_std AS upper_bound,
         COALESCE(daily_count > rolling_mean + {dbl(SIG)} * rolling_std, false) AS is_spike
  FROM stats
)""",
    "spike_rows": """spike_rows AS (
  SELECT tx.*, b.daily_count, b.rolling_mean, b.rolling_std FROM tx JOIN baseline b USING (date) WHERE b.is_spike
)""",
    "spike_flags": f"""spike_flags AS (
  {_flag_select('volume_spike', "'Date ' || " + iso('date') + " || ': ' || CAST(daily_count AS VARCHAR) || ' transactions (baseline mean=' || " + fixed('rolling_mean', 1) + " || ', std=' || " + fixed('rolling_std', 1) + " || ', threshold=' || " + fixed(f'rolling_mean + {dbl(SIG)} * rolling_std', 1) + " || ')'", dbl(0.0), daily_count='daily_count', rolling_mean='rolling_mean', rolling_std='rolling_std')}
  FROM spike_rows
)""",
    "flags": """flags AS (
  SELECT * FROM (
    SELECT * FROM dup_flags
    UNION ALL SELECT * FROM price_flags
    UNION ALL SELECT * FROM sla_flags
    UNION ALL SELECT * FROM spike_flags
  ) QUALIFY row_number() OVER (PARTITION BY transaction_id, rule_triggered ORDER BY date) = 1
)""",
}

_low, _med, _high = float(SP.low_threshold), float(SP.medium_threshold), float(SP.high_threshold)
_x = "leakage_amount_gbp"
CTES["fin"] = f"""fin AS (
  SELECT *,
    CASE WHEN {_x} <= 0 THEN 0 WHEN {_x} < {dbl(_low)} THEN 1 WHEN {_x} < {dbl(_med)} THEN 2 WHEN {_x} < {dbl(_high)} THEN 3 ELSE 4 END AS _band,
    CASE WHEN {_x} <= 0 THEN NULL
         WHEN {_x} < {dbl(_low)} THEN {dbl(5.0)} + ({_x} / {dbl(_low)}) * {dbl(5.0)}
         WHEN {_x} < {dbl(_med)} THEN {dbl(10.0)} + (({_x} - {dbl(_low)}) / {dbl(_med - _low)}) * {dbl(10.0)}
         WHEN {_x} < {dbl(_high)} THEN {dbl(20.0)} + (({_x} - {dbl(_med)}) / {dbl(_high - _med)}) * {dbl(8.0)}
    END AS _fraw
  FROM flags
)"""
_base = case_map("rule_triggered", {k: float(v) for k, v in SP.base_scores.items()}, "DOUBLE")
CTES["scored0"] = f"""scored0 AS (
  SELECT * EXCLUDE (_band, _fraw),
    COALESCE({_base}, {dbl(SP.unknown_rule_score)}) AS base_score,
    CASE WHEN _band = 0 THEN {dbl(0.0)} WHEN _band = 4 THEN {dbl(30.0)} ELSE {exact_round('_fraw', 2)} END AS financial_score
  FROM fin
)"""
CTES["scored1"] = f"""scored1 AS (
  SELECT *, LEAST(base_score + financial_score, {dbl(100.0)}) AS composite_score FROM scored0
)"""
CTES["scored2"] = f"""scored2 AS (
  SELECT *, CASE WHEN composite_score >= {dbl(SP.critical_band)} THEN 'Critical'
                 WHEN composite_score >= {dbl(SP.high_band)} THEN 'High'
                 WHEN composite_score >= {dbl(SP.medium_band)} THEN 'Medium' ELSE 'Low' END AS severity
  FROM scored1
)"""
CTES["scored"] = f"""scored AS (
  SELECT *, {case_map('severity', SEVERITY_RANK, 'INTEGER')} AS severity_rank,
            {case_map('severity', ACTIONS)} AS action_required
  FROM scored2
)"""
CTES["summary"] = f"""summary AS (
  SELECT
    (SELECT {money_total(_x)} FROM scored) AS headline_gbp,
    (SELECT count(DISTINCT transaction_id) FROM scored) AS headline_transactions,
    (SELECT count(*) FROM scored) AS total_flags,
    (SELECT count(*) FROM scored WHERE severity = 'Critical') AS critical_count,
    (SELECT count(*) FROM scored WHERE severity = 'High') AS high_count,
    (SELECT count(*) FROM scored WHERE severity = 'Medium') AS medium_count,
    (SELECT count(*) FROM scored WHERE severity = 'Low') AS low_count,
    (SELECT count(*) FROM tx) AS total_transactions_analysed,
    (SELECT strftime(min(date), '%Y-%m-%d') FROM tx) AS date_range_start,
    (SELECT strftime(max(date), '%Y-%m-%d') FROM tx) AS date_range_end,
    {q(SP.currency)} AS currency
)"""

# dependency order of the CTEs
_ORDER = list(CTES)
_DEPS = {
    "li": [], "li2": ["li"], "tx": ["li2"], "dups": ["tx"], "dup_flags": ["dups"], "price_flags": ["tx"],
    "sla": ["tx"], "sla_flags": ["sla"], "daily": ["tx"], "stats": ["daily"], "baseline": ["stats"],
    "spike_rows": ["baseline", "tx"], "spike_flags": ["spike_rows"],
    "flags": ["dup_flags", "price_flags", "sla_flags", "spike_flags"], "fin": ["flags"], "scored0": ["fin"],
    "scored1": ["scored0"], "scored2": ["scored1"], "scored": ["scored2"], "summary": ["scored", "tx"],
}


def _closure(names: list[str]) -> list[str]:
    need: set[str] = set()

    def visit(n: str) -> None:
        if n in need:
            return
        need.add(n)
        for d in _DEPS[n]:
            visit(d)

    for n in names:
        visit(n)
    return [n for n in _ORDER if n in need]


def sql(body: str, *uses: str) -> str:
    return "WITH " + ",\n".join(CTES[n] for n in _closure(list(uses))) + "\n" + body


def _r6(c: str) -> str:
    return f"{array_round(c, 6)} AS {c}"


_FLAG_OUT = f"{TXC}, rule_triggered, rule_detail, leakage_amount_gbp, breach_days, daily_count, {_r6('rolling_mean')}, {_r6('rolling_std')}"
_SCORE_OUT = "base_score, financial_score, composite_score, severity, severity_rank, action_required"
_ROUT = "rule_triggered, rule_detail, leakage_amount_gbp"
_rule_label = f"COALESCE({case_map('rule_triggered', RULE_LABELS)}, rule_triggered)"
_rule_label_short = f"COALESCE({case_map('rule_triggered', RULE_LABELS_SHORT)}, rule_triggered)"

_top_sup = f"""(SELECT supplier_name, {money_total(_x)} AS leakage_gbp FROM scored WHERE supplier_name IS NOT NULL
   GROUP BY supplier_name ORDER BY leakage_gbp DESC, supplier_name LIMIT {{n}})"""

_finding_line = (
    "'• *' || COALESCE(transaction_id, 'N/A') || '* | ' || COALESCE(supplier_name, 'Unknown') || ' | Rule: `' || "
    "COALESCE(rule_triggered, 'N/A') || '` | Est. leakage: *£' || "
    + grouped(f"COALESCE({_x}, {dbl(0.0)})", 2)
    + " || '*'"
)
_top_items = f"""(SELECT transaction_id, supplier_name, rule_triggered, {_x}, severity,
     CAST(row_number() OVER (ORDER BY {_x} DESC NULLS LAST, transaction_id, rule_triggered) AS INTEGER) AS rank
   FROM scored WHERE severity = {{sev}} ORDER BY {_x} DESC NULLS LAST, transaction_id, rule_triggered LIMIT {{n}})"""

_kpi_values = [
    "'£' || " + grouped("headline_gbp", 2),
    "format('{:,}', total_transactions_analysed)",
    "format('{:,}', total_flags)",
    "CAST(critical_count AS VARCHAR)",
    "CAST(high_count AS VARCHAR)",
    "CAST(medium_count AS VARCHAR)",
    "CAST(low_count AS VARCHAR)",
]

ORACLE: dict[str, str] = {
    "load_transactions": sql(f"SELECT {TXC} FROM tx", "tx"),
    "load_profile": sql(
        "SELECT count(*) AS total_transactions, min(date) AS date_range_start, max(date) AS date_range_end FROM tx", "tx"
    ),
    "price_variance": sql(f"SELECT {TXC}, {_ROUT} FROM price_flags", "price_flags"),
    "sla_breach": sql(f"SELECT {TXC}, breach_days, {_ROUT} FROM sla_flags", "sla_flags"),
    "duplicates": sql(f"SELECT {TXC}, {_ROUT} FROM dup_flags", "dup_flags"),
    "daily_counts": sql("SELECT date, daily_count FROM daily", "daily"),
    "volume_baseline": sql(
        f"SELECT date, daily_count, {_r6('rolling_mean')}, {_r6('rolling_std')}, {_r6('upper_bound')}, is_spike FROM baseline",
        "baseline",
    ),
    "volume_spikes": sql(
        f"SELECT {TXC}, daily_count, {_r6('rolling_mean')}, {_r6('rolling_std')}, {_ROUT} FROM spike_flags", "spike_flags"
    ),
    "all_flags": sql(f"SELECT {_FLAG_OUT} FROM flags", "flags"),
    "rule_details": sql("SELECT transaction_id, rule_triggered, rule_detail FROM flags", "flags"),
    "run_summary": sql(
        f"""SELECT (SELECT count(*) FROM tx) AS total_transactions, (SELECT count(*) FROM flags) AS total_flagged,
       (SELECT {money_total(_x)} FROM flags) AS total_leakage_gbp,
       (SELECT strftime(min(date), '%Y-%m-%d') FROM tx) AS date_range_start,
       (SELECT strftime(max(date), '%Y-%m-%d') FROM tx) AS date_range_end""",
        "flags", "tx",
    ),
    "leakage_by_rule": sql(
        f"SELECT rule_triggered, count({_x}) AS count, {money_total(_x)} AS leakage_gbp FROM flags "
        "WHERE rule_triggered IS NOT NULL GROUP BY rule_triggered",
        "flags",
    ),
    "rule_run_stats": sql(
        f"""SELECT count(*) FILTER (WHERE rule_triggered = 'duplicate') AS duplicate_flags,
       count(*) FILTER (WHERE rule_triggered = 'price_variance') AS price_flags,
       {money_total(f"CASE WHEN rule_triggered = 'price_variance' THEN {_x} END")} AS price_leakage_gbp,
       count(*) FILTER (WHERE rule_triggered = 'sla_breach') AS sla_flags,
       CAST(COALESCE(max(CASE WHEN rule_triggered = 'sla_breach' THEN breach_days END), 0) AS INTEGER) AS sla_max_breach_days,
       count(*) FILTER (WHERE rule_triggered = 'volume_spike') AS spike_flags,
       count(DISTINCT CASE WHEN rule_triggered = 'volume_spike' THEN date END) AS spike_days
FROM flags""",
        "flags",
    ),
    "financial_score": sql(
        f"SELECT transaction_id, rule_triggered, {_x}, base_score, financial_score, composite_score FROM scored", "scored"
    ),
    "scored": sql(f"SELECT {_FLAG_OUT}, {_SCORE_OUT} FROM scored", "scored"),
    "scored_ranked": sql(
        f"""SELECT row_number() OVER (ORDER BY severity_rank DESC, {_x} DESC NULLS LAST, transaction_id, rule_triggered) AS rank,
       transaction_id, rule_triggered, severity, severity_rank, {_x}, composite_score FROM scored""",
        "scored",
    ),
    "critical_top3": sql(
        f"SELECT rank, transaction_id, supplier_name, rule_triggered, {_x}, severity FROM "
        + _top_items.format(sev=q("Critical"), n=RP.alert_items),
        "scored",
    ),
    "severity_breakdown": sql(
        """SELECT s.severity, COALESCE(c.flags, 0) AS flags, s.severity_rank
FROM (VALUES ('Critical', 4), ('High', 3), ('Medium', 2), ('Low', 1)) s(severity, severity_rank)
LEFT JOIN (SELECT severity, count(*) AS flags FROM scored GROUP BY severity) c USING (severity)""",
        "scored",
    ),
    "executive_summary": sql("SELECT * FROM summary", "summary"),
    "leakage_by_category": sql(
        f"""SELECT category, leakage_gbp, CAST(row_number() OVER (ORDER BY leakage_gbp DESC, category) AS INTEGER) AS rank
FROM (SELECT category, {money_total(_x)} AS leakage_gbp FROM scored WHERE category IS NOT NULL GROUP BY category)""",
        "scored",
    ),
    "top_suppliers": sql(
        "SELECT supplier_name, leakage_gbp, CAST(row_number() OVER (ORDER BY leakage_gbp DESC, supplier_name) AS INTEGER) AS rank FROM "
        + _top_sup.format(n=RP.top_suppliers),
        "scored",
    ),
    "rule_share": sql(
        f"""SELECT rule_triggered, {_rule_label} AS rule, count AS flags, leakage_gbp,
       {fixed("CAST(leakage_gbp AS DOUBLE) / (CASE WHEN sum(leakage_gbp) OVER () = 0 THEN " + dbl(1.0) + " ELSE CAST(sum(leakage_gbp) OVER () AS DOUBLE) END) * " + dbl(100.0), 1)} || '%' AS share_of_total
FROM (SELECT rule_triggered, count(transaction_id) AS count, {money_total(_x)} AS leakage_gbp
      FROM scored WHERE rule_triggered IS NOT NULL GROUP BY rule_triggered)""",
        "scored",
    ),
    "rule_performance": sql(
        f"""SELECT rule_triggered, {_rule_label_short} AS rule, total_flags, critical, high, medium, low,
       CAST(round_even(_sum, 2) AS DECIMAL(38,2)) AS total_leakage_gbp,
       CAST(round_even(_sum / total_flags, 2) AS DECIMAL(38,2)) AS avg_leakage_gbp,
       {array_round('_max', 2)} AS max_leakage_gbp
FROM (SELECT rule_triggered, count(*) AS total_flags,
             count(*) FILTER (WHERE severity = 'Critical') AS critical,
             count(*) FILTER (WHERE severity = 'High') AS high,
             count(*) FILTER (WHERE severity = 'Medium') AS medium,
             count(*) FILTER (WHERE severity = 'Low') AS low,
             {exact_sum(_x)} AS _sum, max({_x}) AS _max
      FROM scored WHERE rule_triggered IS NOT NULL GROUP BY rule_triggered)""",
        "scored",
    ),
    "daily_trend": sql(
        f"""SELECT date, count(transaction_id) AS flags, {money_total(_x)} AS leakage_gbp,
       count(*) FILTER (WHERE severity = 'Critical') AS critical,
       CAST(row_number() OVER (ORDER BY date) AS INTEGER) AS day_order
FROM scored WHERE date IS NOT NULL GROUP BY date""",
        "scored",
    ),
    "severity_heatmap": sql(
        f"""SELECT rule_triggered, {_rule_label} AS rule,
       count(*) FILTER (WHERE severity = 'Low') AS "Low",
       count(*) FILTER (WHERE severity = 'Medium') AS "Medium",
       count(*) FILTER (WHERE severity = 'High') AS "High",
       count(*) FILTER (WHERE severity = 'Critical') AS "Critical"
FROM scored WHERE rule_triggered IS NOT NULL GROUP BY rule_triggered""",
        "scored",
    ),
    "category_rule_leakage": sql(
        f"""SELECT *, CAST(row_number() OVER (PARTITION BY rule_triggered ORDER BY leakage_gbp, category) AS INTEGER) AS bar_order
FROM (SELECT category, rule_triggered, {money_total(_x)} AS leakage_gbp FROM scored
      WHERE category IS NOT NULL AND rule_triggered IS NOT NULL GROUP BY category, rule_triggered)""",
        "scored",
    ),
    "supplier_exposure": sql(
        f"""SELECT CAST(dense_rank() OVER (ORDER BY total ASC, supplier_name ASC) AS INTEGER) AS supplier_order,
       supplier_name, rule_triggered, {_rule_label} AS rule, leakage_gbp
FROM (
  SELECT t.supplier_name, t.rule_triggered,
         CAST(COALESCE(l.leakage_gbp, 0) AS DECIMAL(38,2)) AS leakage_gbp,
         sum(l.leakage_gbp) OVER (PARTITION BY t.supplier_name) AS total
  FROM (SELECT supplier_name,
               unnest((SELECT list(DISTINCT rule_triggered) FROM scored
                       WHERE supplier_name IN (SELECT supplier_name FROM {_top_sup.format(n=RP.exposure_suppliers)}))) AS rule_triggered
        FROM {_top_sup.format(n=RP.exposure_suppliers)}) t
  LEFT JOIN (SELECT supplier_name, rule_triggered, {money_total(_x)} AS leakage_gbp FROM scored
             GROUP BY supplier_name, rule_triggered) l
    ON l.supplier_name = t.supplier_name AND l.rule_triggered = t.rule_triggered
)""",
        "scored",
    ),
    "kpi_tiles": sql(
        "SELECT position, label, value FROM ("
        + " UNION ALL ".join(
            f"SELECT {i + 1} AS position, {q(label)} AS label, {v} AS value FROM summary"
            for i, (label, v) in enumerate(zip(KPI_LABELS, _kpi_values))
        )
        + ")",
        "summary",
    ),
    "flagged_items": sql(
        "SELECT " + ", ".join(f'{c} AS "{h}"' for c, h in DETAIL_HEADERS.items()) + " FROM scored", "scored"
    ),
    "alert_digest": sql(
        f"""SELECT {q(RP.alert_severity)} AS alert_severity, {RP.alert_severity.lower()}_count AS alert_count, headline_gbp,
       critical_count, high_count, total_transactions_analysed,
       date_range_start || ' → ' || date_range_end AS period,
       COALESCE((SELECT string_agg(line, chr(10) ORDER BY rank) FROM
                 (SELECT rank, {_finding_line} AS line FROM {_top_items.format(sev=q(RP.alert_severity), n=RP.alert_items)})),
                {q(ALERT_NO_ITEMS)}) AS top_findings
FROM summary WHERE {RP.alert_severity.lower()}_count > 0""",
        "summary",
    ),
    "rule_quality": sql(
        f"""SELECT rule_triggered,
       count(*) FILTER (WHERE t AND f) AS true_positives,
       count(*) FILTER (WHERE NOT t AND f) AS false_positives,
       count(*) FILTER (WHERE t AND NOT f) AS false_negatives,
       CASE WHEN count(*) FILTER (WHERE f) > 0 THEN {array_round("(count(*) FILTER (WHERE t AND f)) / (count(*) FILTER (WHERE f))", 6)} END AS precision,
       CASE WHEN count(*) FILTER (WHERE t) > 0 THEN {array_round("(count(*) FILTER (WHERE t AND f)) / (count(*) FILTER (WHERE t))", 6)} END AS recall
FROM (
  SELECT transaction_id, rule_triggered, bool_or(t) AS t, bool_or(f) AS f FROM (
    SELECT transaction_id, unnest(string_split(anomaly_type, '|')) AS rule_triggered, true AS t, false AS f
    FROM tx WHERE anomaly_type IS NOT NULL AND anomaly_type <> ''
    UNION ALL
    SELECT transaction_id, rule_triggered, false AS t, true AS f FROM flags
  ) WHERE rule_triggered <> '' GROUP BY transaction_id, rule_triggered
) GROUP BY rule_triggered""",
        "flags", "tx",
    ),
}

_digest = ("alert_severity", "alert_count", "headline_gbp", "critical_count", "high_count", "total_transactions_analysed", "period", "top_findings")
_with, _body = ORACLE["alert_digest"].rsplit("\nSELECT 'Critical' AS alert_severity", 1)
ORACLE["alert_payload"] = (
    _with
    + "\nSELECT CAST(to_json({" + ", ".join(f"{q(c)}: {c}" for c in _digest) + "}) AS VARCHAR) AS payload FROM (SELECT 'Critical' AS alert_severity"
    + _body
    + ")"
)

# repeated ids: lines loaded twice, and ids that come again a day later
_order = "CAST(substr(po_number, 4) AS BIGINT)"
_repeated = f"""tx AS (
  SELECT * FROM tx0
  UNION ALL SELECT * FROM tx0 WHERE {_order} % 7 = 0
  UNION ALL SELECT * REPLACE (date + 1 AS date) FROM tx0 WHERE {_order} % 11 = 0
)"""
ORACLE["dedup_flags"] = sql("SELECT transaction_id, rule_triggered, date, rule_detail, leakage_amount_gbp FROM flags", "flags").replace(
    CTES["tx"], CTES["tx"].replace("tx AS MATERIALIZED (", "tx0 AS MATERIALIZED (", 1) + ",\n" + _repeated
)
ORACLE["empty_totals"] = sql(
    f"""SELECT c.month, c.rule_triggered, COALESCE(f.flags, 0) AS flags, COALESCE(f.leakage_gbp, CAST(0 AS DECIMAL(38,2))) AS leakage_gbp
FROM (SELECT CAST(m AS DATE) AS month, r AS rule_triggered
      FROM (SELECT unnest(generate_series(date_trunc('month', min(date)), date_trunc('month', max(date)), INTERVAL 1 MONTH)) AS m FROM tx),
           (VALUES {", ".join(f"({q(r)})" for r in RULE_LABELS)}) v(r)) c
LEFT JOIN (SELECT CAST(date_trunc('month', date) AS DATE) AS month, rule_triggered, count(*) AS flags, {money_total(_x)} AS leakage_gbp
           FROM flags GROUP BY 1, 2) f
  ON f.month = c.month AND f.rule_triggered = c.rule_triggered""",
    "flags", "tx",
)


def _pairwise(window: int) -> str:
    """Rule 1 as a self-join over a range of days."""
    detail = "'Duplicate of supplier ' || supplier_id || ' invoice £' || " + grouped("invoice_amount", 2) + f" || ' within {window}d window'"
    return sql(
        f"""SELECT {TXC}, 'duplicate' AS rule_triggered, {detail} AS rule_detail, invoice_amount AS leakage_amount_gbp
FROM tx SEMI JOIN (
  WITH k AS (SELECT supplier_id AS s, round_even(invoice_amount, 0) AS a, date AS d, transaction_id AS i FROM tx)
  SELECT DISTINCT later.i AS transaction_id
  FROM k earlier JOIN k later ON earlier.s = later.s AND earlier.a = later.a AND earlier.d <= later.d AND later.d <= earlier.d + {window}
  WHERE earlier.d < later.d OR earlier.i < later.i
) USING (transaction_id)""",
        "tx",
    )


ORACLE["duplicates_pairwise"] = _pairwise(W)
ORACLE["duplicates_window30"] = _pairwise(30)

_keys = ("category", "rule_triggered", "severity")


def _breakdown(name: str, of: tuple[str, ...]) -> str:
    keys = ", ".join(c if c in of else f"CAST(NULL AS VARCHAR) AS {c}" for c in _keys)
    by_severity = ", ".join(f"count(*) FILTER (WHERE severity = {q(x)}) AS {x.lower()}" for x in ("Critical", "High", "Medium", "Low"))
    return (
        f"SELECT {q(name)} AS breakdown, {keys}, count(*) AS flags, count({_x}) AS with_amount, {by_severity}, "
        f"{money_total(_x)} AS leakage_gbp, CAST(round_even({exact_sum(_x)} / count(*), 2) AS DECIMAL(38,2)) AS avg_leakage_gbp, "
        f"{array_round(f'max({_x})', 2)} AS max_leakage_gbp FROM scored WHERE {' AND '.join(f'{c} IS NOT NULL' for c in of)} GROUP BY {', '.join(of)}"
    )


ORACLE["breakdowns"] = sql("\nUNION ALL\n".join(_breakdown(n, of) for n, of in BREAKDOWNS.items()), "scored")
