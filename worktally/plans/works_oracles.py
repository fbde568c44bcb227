"""DuckDB SQL for the queries of the works analytics, written apart from the DataFrame code."""

from __future__ import annotations

from worktally.plans.change_queries import _whole

REF = "DATE '2026-09-30'"
# The rules, features and metrics, written out here, so that a mistake in the engine's own tables shows.
_FLAGS = {
    "SOURCE_DATA_DEFECT_NEGATIVE_DELAY": "sanction_delay_days < 0",
    "SANCTION_DELAY_VERY_HIGH": "sanction_delay_days > greatest(t.delay_p95, -1)",
    "SANCTION_DELAY_HIGH": "sanction_delay_days >= 0 AND sanction_delay_days > t.delay_p90 AND sanction_delay_days <= t.delay_p95",
    "SANCTION_DELAY_ELEVATED": "sanction_delay_days >= 0 AND sanction_delay_days > t.delay_p75 AND sanction_delay_days <= t.delay_p90",
    "LONG_PENDING": "completion_date IS NULL AND pending_days > t.duration_p90",
    "LOW_EXPENDITURE": "completion_date IS NULL AND pending_days > 180 AND sanction_amount > 0 AND expenditure_amount = 0",
    "PAYMENT_STAGNATION": "completion_date IS NULL AND days_since_payment > 180",
    "COST_ANOMALY": "cost_status = 'VERY_HIGH' OR cost_status = 'HIGH'",
    "DURATION_ANOMALY": "completion_date IS NOT NULL AND (duration_status = 'VERY_LONG' OR duration_status = 'LONG')",
    "OVER_EXPENDITURE": "sanction_amount > 0 AND expenditure_amount > 1.05 * sanction_amount",
    "POST_COMPLETION_PAYMENT": "completion_date < last_expenditure_date",
}
_SIGNALS = {
    "SANCTION_MATCHES_RECOMMENDATION": "sanction_amount > 0 AND recommended_amount = sanction_amount",
    "RECENT_PAYMENT_ACTIVITY": "completion_date IS NULL AND days_since_payment <= 180",
    "EXPENDITURE_ON_TRACK": "expenditure_percentage >= 75 AND expenditure_percentage <= 100",
    "COMPLETION_RECORDED": "completion_date IS NOT NULL",
    "COST_WITHIN_PEER_RANGE": "cost_status = 'NORMAL'",
    "DURATION_WITHIN_PEER_RANGE": "duration_status = 'NORMAL'",
}
_PER_WORK = "CAST({0} AS DOUBLE) / CAST(total_works AS DOUBLE) * 100"
# Feature, direction, value, what it says.
_MEMBER_Z = [
    ("avg_cost_percentile", "HIGH", "avg_cost_percentile", "Average cost percentile is substantially above the comparable entity median."),
    ("avg_project_age_days", "BOTH", "avg_project_age_days", "Average project age deviates substantially from the comparable entity median."),
    ("avg_sanction_delay_days", "HIGH", "avg_sanction_delay_days", "Average sanction delay is substantially above the comparable entity median."),
    ("completion_rate_pct", "LOW", "completion_rate_pct", "Completion rate is substantially below the comparable entity median."),
    ("cost_anomaly_rate", "HIGH", _PER_WORK.format("cost_anomaly_works"), "Rate of cost-anomalous works is substantially above the comparable entity median."),
    ("duration_anomaly_rate", "HIGH", _PER_WORK.format("duration_anomaly_works"), "Rate of duration-anomalous works is substantially above the comparable entity median."),
    ("expenditure_over_sanction_rate", "HIGH", _PER_WORK.format("expenditure_over_sanction_works"), "Rate of works exceeding sanctioned amount is substantially above the comparable entity median."),
    ("expenditure_utilization_pct", "LOW", "expenditure_sanction_utilization_pct", "Expenditure utilization is substantially below the comparable entity median."),
    ("flagged_rate_pct", "HIGH", "flagged_rate_pct", "Flagged-work rate is substantially above the comparable entity median."),
    ("high_risk_rate_pct", "HIGH", "high_risk_rate_pct", "High-risk work rate is substantially above the comparable entity median."),
    ("negative_delay_rate", "HIGH", _PER_WORK.format("negative_sanction_delay_works"), "Rate of works with negative sanction delay is substantially above the comparable entity median."),
    ("overdue_rate", "HIGH", _PER_WORK.format("overdue_over_1_year"), "Rate of works overdue over 1 year is substantially above the comparable entity median."),
]
_STATE_Z = [
    ("avg_sanction_delay", "HIGH", "avg_sanction_delay_days", ""),
    ("completion_rate", "LOW", "completion_rate_pct", ""),
    ("cost_anomaly_rate", "HIGH", _PER_WORK.format("cost_anomaly_works"), ""),
    ("duration_anomaly_rate", "HIGH", _PER_WORK.format("duration_anomaly_works"), ""),
    ("expenditure_utilization", "LOW", "expenditure_sanction_utilization_pct", ""),
    ("overdue_rate", "HIGH", _PER_WORK.format("overdue_over_1_year"), ""),
    ("risk_rate", "HIGH", "flagged_rate_pct", ""),
]
_FLAGGED = "(len(risk_flags) > 0 OR risk_level = 'HIGH')"
_MEMBER_REFS = [
    ("risk", _FLAGGED, "0", 5),
    ("positive_signal", "completion_date IS NOT NULL AND expenditure_percentage >= 80", "0", 3),
    ("representative", "sanction_amount > 0", "0 - sanction_amount", 3),
    ("financial", "expenditure_amount > 0", "0 - expenditure_amount", 3),
    ("execution", "sanction_delay_days > 0", "0 - sanction_delay_days", 3),
]
_STATE_REFS = [("risk", _FLAGGED, "0 - len(risk_flags)", 5), ("representative", "sanction_amount > 0", "0 - sanction_amount", 3)]
# The 43 metrics of the national statistics: counts, amounts, days, shares.
_COUNTED = (
    "total_works recommended_works sanctioned_works completed_works ongoing_works pending_works flagged_works medium_risk_works high_risk_works cost_anomaly_works duration_anomaly_works "
    "expenditure_over_sanction_works expenditure_over_recommendation_works negative_sanction_delay_works negative_execution_works completion_before_sanction_works expenditure_before_sanction_works "
    "overdue_over_1_year overdue_over_2_years recommended_amount sanctioned_amount expenditure_amount completion_amount unspent_amount flagged_rate_pct high_risk_rate_pct completion_rate_pct "
    "sanction_rate_pct sanction_conversion_pct expenditure_sanction_utilization_pct expenditure_recommendation_pct"
).split()
_AVERAGED = (
    "avg_sanction_delay_days median_sanction_delay_days avg_execution_days median_execution_days avg_project_age_days max_project_age_days avg_pending_days max_pending_days "
    "avg_cost_percentile avg_duration_percentile avg_cost_deviation_pct avg_duration_deviation_pct"
).split()
_METRICS = [*_COUNTED, *_AVERAGED]


def _r(x: str, digits: int = 2) -> str:
    return f"(floor(({x}) * {float(10**digits)} + 0.5) / {float(10**digits)})"


def _rate(a: str, b: str) -> str:
    return f"(CASE WHEN ({b}) = 0 THEN 0.0 ELSE {_r(f'CAST({a} AS DOUBLE) / CAST({b} AS DOUBLE) * 100')} END)"


def _strip(x: str) -> str:
    return f"regexp_replace({x}, '^\\s+|\\s+$', '', 'g')"


def _date(x: str) -> str:
    forms = ("%Y-%m-%d", "%d-%b-%Y", "%d-%m-%Y", "%b %d, %Y %I:%M:%S %p", "%b %d, %Y")
    return "CAST(COALESCE(" + ", ".join(f"try_strptime({_strip(x)}, '{f}')" for f in forms) + ") AS DATE)"


def _amount(x: str) -> str:
    v = f"TRY_CAST({_strip(f'CAST({x} AS VARCHAR)')} AS DECIMAL(18,2))"
    return f"(CASE WHEN {v} > 0 THEN {v} END)"


def _activity(x: str) -> str:
    return _strip(f"regexp_replace({_strip(x)}, '^WS/\\s*MP[0-9]+/[0-9]{{4}}-[0-9]{{4}}/[0-9]+-', '', 'i')")


def _member(x: str) -> str:
    s = f"regexp_replace({_strip(f'''COALESCE({x}, '')''')}, '\\s*\\([^)]*\\)\\s*$', '')"
    s = f"regexp_replace({s}, '^(shri|smt\\.?|dr\\.?|mrs\\.?|ms\\.?|late)\\s+', '', 'i')"
    return f"upper({_strip(f'''regexp_replace({s}, '\\s+', ' ', 'g')''')})"


def _alloc(x: str) -> str:
    s = f"regexp_replace(lower({_strip(f'''COALESCE({x}, '')''')}), '\\s*\\([^)]*\\)\\s*$', '')"
    s = f"regexp_replace({s}, '^(shri|smt|dr|mrs|ms|mr|prof|late)\\.?\\s+', '')"
    return _strip(f"regexp_replace({s}, '\\s+', ' ', 'g')")


def _category(a: str, c: str) -> str:
    return f"COALESCE(NULLIF(trim(regexp_replace({a}, '^NA-', '', 'i')), ''), NULLIF(trim({c}), ''), 'UNCLASSIFIED')"


def _band(v: str, what: str) -> str:
    steps = " ".join(f"WHEN {what}_p{p} IS NOT NULL AND {v} <= {what}_p{p} THEN {b}" for p, b in ((25, 10.0), (50, 25.0), (75, 50.0), (90, 75.0), (95, 90.0)))
    return f"CASE WHEN {v} IS NOT NULL THEN CASE {steps} ELSE 97.5 END END"


def _peer_status(p: str, high: str, low: str) -> str:
    return (
        f"CASE WHEN benchmark_sample_size < 5 THEN 'NO_RELIABLE_BENCHMARK' WHEN status <> 'Completed' OR {p} IS NULL THEN 'NOT_APPLICABLE' WHEN {p} >= 95 THEN 'VERY_{high}' WHEN {p} >= 90 THEN '{high}' "
        f"WHEN {p} >= 75 THEN 'ABOVE_NORMAL' WHEN {p} >= 25 THEN 'NORMAL' WHEN {p} >= 10 THEN 'BELOW_NORMAL' ELSE 'VERY_{low}' END"
    )


def _listed(rules: dict[str, str]) -> str:
    cells = ", ".join(f"CASE WHEN {c} THEN '{n}' END" for n, c in rules.items())
    return f"list_filter([{cells}], lambda x: x IS NOT NULL)"


_QS = "[0.25, 0.5, 0.75, 0.9, 0.95]"
_CELLS = ", ".join(f"{_r(f'{c}[{i + 1}]', 4)} AS {w}_p{p}" for c, w in (("c", "cost"), ("d", "duration")) for i, p in enumerate((25, 50, 75, 90, 95)))
_GROUPS = "count(*) AS n, quantile_cont(cost, {q}) AS c, quantile_cont(duration, {q}) AS d".format(q=_QS)


def _n(cond: str, name: str) -> str:
    return f"count(*) FILTER (WHERE {cond}) AS {name}"


def _tot(c: str, name: str) -> str:
    return f"CAST(COALESCE(sum({c}), 0) AS DOUBLE) AS {name}"


def _mean(x: str, name: str) -> str:
    return f"{_r(f'CAST(sum(CAST({x} AS DECIMAL(28,4))) AS DOUBLE) / count({x})')} AS {name}"


def _med(x: str, name: str) -> str:
    return f"{_r(f'quantile_cont(CAST({x} AS DOUBLE), 0.5)')} AS {name}"


_PRICED = "CASE WHEN sanction_amount > 0 THEN sanction_amount END"
_SHARED = [
    "count(*) AS total_works",
    _n("status = 'Recommended'", "recommended_works"),
    _n("sanction_date IS NOT NULL", "sanctioned_works"),
    _n("status = 'Completed'", "completed_works"),
    _n("status = 'In Progress'", "ongoing_works"),
    _tot("recommended_amount", "recommended_amount"),
    _tot("sanction_amount", "sanctioned_amount"),
    _tot("expenditure_amount", "expenditure_amount"),
    _tot("completion_amount", "completion_amount"),
    _mean("sanction_delay_days", "avg_sanction_delay_days"),
    _med("sanction_delay_days", "median_sanction_delay_days"),
    _mean("execution_days", "avg_execution_days"),
    _med("execution_days", "median_execution_days"),
    _n("flag_count >= 1", "flagged_works"),
    _n("risk_level = 'HIGH'", "high_risk_works"),
    _n("project_age_days > 365 AND status <> 'Completed'", "overdue_over_1_year"),
    _n("project_age_days > 730 AND status <> 'Completed'", "overdue_over_2_years"),
    _n("cost_status IN ('VERY_HIGH', 'HIGH')", "cost_anomaly_works"),
    _n("duration_status IN ('VERY_LONG', 'LONG')", "duration_anomaly_works"),
    _n("sanction_amount > 0 AND expenditure_amount > sanction_amount", "expenditure_over_sanction_works"),
    _n("recommended_amount > 0 AND expenditure_amount > recommended_amount", "expenditure_over_recommendation_works"),
    _n("sanction_delay_days < 0", "negative_sanction_delay_works"),
    _mean(_PRICED, "avg_work_cost"),
    _med(_PRICED, "median_work_cost"),
]
_MEMBER = [
    "arg_min(state_id, work_id) FILTER (WHERE state_id IS NOT NULL) AS state_id",
    _mean("project_age_days", "avg_project_age_days"),
    "max(project_age_days) AS max_project_age_days",
    _mean("pending_days", "avg_pending_days"),
    "max(pending_days) AS max_pending_days",
    _n("risk_level = 'MEDIUM'", "medium_risk_works"),
    _n("execution_days < 0", "negative_execution_works"),
    _n("completion_date < sanction_date", "completion_before_sanction_works"),
    _n("last_expenditure_date < sanction_date", "expenditure_before_sanction_works"),
    _mean("cost_percentile", "avg_cost_percentile"),
    _mean("duration_percentile", "avg_duration_percentile"),
    _mean("cost_deviation", "avg_cost_deviation_pct"),
    _mean("duration_deviation", "avg_duration_deviation_pct"),
]
_STATE = ["count(DISTINCT (member_type, member_id)) AS active_members", "count(DISTINCT CASE WHEN member_type = 'MP' THEN member_id END) AS active_mps", "count(DISTINCT CASE WHEN member_type = 'MLA' THEN member_id END) AS active_mlas"]
_RATES = ", ".join(
    [
        "total_works - completed_works - ongoing_works AS pending_works",
        "sanctioned_amount - expenditure_amount AS unspent_amount",
        f"{_rate('flagged_works', 'total_works')} AS flagged_rate_pct",
        f"{_rate('high_risk_works', 'total_works')} AS high_risk_rate_pct",
        f"{_rate('completed_works', 'total_works')} AS completion_rate_pct",
        f"{_rate('sanctioned_works', 'total_works')} AS sanction_rate_pct",
        f"CASE WHEN sanctioned_amount > 0 AND sanctioned_works > 0 THEN {_rate('completed_works', 'sanctioned_works')} ELSE 0.0 END AS sanction_conversion_pct",
        f"CASE WHEN sanctioned_amount > 0 THEN {_r('expenditure_amount / sanctioned_amount * 100')} ELSE 0.0 END AS expenditure_sanction_utilization_pct",
        f"CASE WHEN recommended_amount > 0 THEN {_r('expenditure_amount / recommended_amount * 100')} ELSE 0.0 END AS expenditure_recommendation_pct",
    ]
)


def _features(table: str, features: list[tuple], keys: str) -> str:
    parts = []
    for name, direction, value, says in features:
        parts.append(f"SELECT {keys}, '{name}' AS feature, '{direction}' AS direction, '{says}' AS description, CAST({value} AS DOUBLE) AS v FROM {table} WHERE ranking_qualified AND ({value}) IS NOT NULL")
    return " UNION ALL ".join(parts)


def _z_chain(prefix: str, table: str, features: list[tuple], keys: str, by: str, high: int, medium: int) -> list[tuple[str, str]]:
    """CTEs: values, centres, spreads, scores, composites and levels of a table's features."""
    z = "CASE WHEN mad = 0 THEN 0.0 ELSE greatest(least(0.6745 * (v - median) / mad, 5.0), -5.0) END"
    part = "CASE direction WHEN 'HIGH' THEN greatest(0.0, z) WHEN 'LOW' THEN greatest(0.0, -z) ELSE abs(z) END"
    return [
        (f"{prefix}_values", _features(table, features, keys)),
        (f"{prefix}_centre", f"SELECT {by}, quantile_cont(v, 0.5) AS median FROM {prefix}_values GROUP BY {by} HAVING count(*) >= 5"),
        (f"{prefix}_spread", f"SELECT {by}, quantile_cont(abs(v - median), 0.5) AS mad FROM {prefix}_values JOIN {prefix}_centre USING ({by}) GROUP BY {by}"),
        (f"{prefix}_z", f"SELECT *, {z} AS z FROM {prefix}_values JOIN {prefix}_centre USING ({by}) JOIN {prefix}_spread USING ({by})"),
        (f"{prefix}_composite", f"SELECT {keys}, total_works, COALESCE(c, 0.0) AS c FROM (SELECT {keys}, total_works FROM {table} WHERE ranking_qualified) LEFT JOIN (SELECT {keys}, avg({part}) AS c FROM {prefix}_z GROUP BY {keys}) USING ({keys})"),
        (f"{prefix}_limits", f"SELECT quantile_cont(c, 0.95) AS high, quantile_cont(c, 0.8) AS medium FROM {prefix}_composite"),
        (f"{prefix}_anomaly", f"SELECT {keys}, {_r('c', 4)} AS anomaly_score, CASE WHEN c > high THEN 'HIGH' WHEN c > medium THEN 'MEDIUM' ELSE 'NORMAL' END AS anomaly_level, CASE WHEN total_works >= {high} THEN 'HIGH' WHEN total_works >= {medium} THEN 'MEDIUM' ELSE 'LOW' END AS confidence_level FROM {prefix}_composite, {prefix}_limits"),
    ]


_SCORE = f"{_r('COALESCE(completion_rate_pct, 0.0) * 0.4 + COALESCE(expenditure_sanction_utilization_pct, 0.0) * 0.4 + scale_score * 0.2')}"
_CLASS = "CASE WHEN w >= 85 THEN 'EXCEPTIONAL' WHEN w >= 70 THEN 'PERFORMER' WHEN w >= 50 THEN 'STABLE' WHEN w >= 35 THEN 'NEEDS_ATTENTION' ELSE 'UNDERPERFORMER' END"


def _rank_chain(prefix: str, table: str, keys: str, part: str, qualified: str) -> list[tuple[str, str]]:
    over = f"PARTITION BY {part}" if part else ""
    sep = ", " if part else ""
    mid = f"(rank() OVER ({over} ORDER BY total_works) - 1 + 0.5 * count(*) OVER (PARTITION BY {part}{sep}total_works)) / count(*) OVER ({over}) * 100"
    return [
        (f"{prefix}_scaled", f"SELECT *, {_r(mid)} AS scale_score FROM {table} WHERE {qualified}"),
        (f"{prefix}_scored", f"SELECT *, {_SCORE} AS w FROM {prefix}_scaled"),
        (f"{prefix}_placed", f"SELECT *, rank() OVER ({over} ORDER BY w DESC) AS rk, count(*) OVER ({over}) AS n FROM {prefix}_scored"),
        (
            f"{prefix}_ranks",
            f"SELECT {keys}, total_works, scale_score, w AS performance_score_weighted, CAST(rk AS INTEGER) AS rank, {_CLASS} AS performance_classification, {_r('CAST((n - rk) * 100 AS DOUBLE) / greatest(n - 1, 1)')} AS national_percentile FROM {prefix}_placed "
            f"UNION ALL SELECT {keys}, total_works, NULL, NULL, NULL, CASE WHEN total_works = 0 THEN 'NO_DATA' ELSE 'INSUFFICIENT_DATA' END, NULL FROM {table} WHERE NOT COALESCE({qualified}, false)",
        ),
    ]


_HASHED = "sha256(concat_ws('|', " + ", ".join(f"COALESCE(CAST({c} AS VARCHAR), '<NULL>')" for c in ("recommended_amount", "sanction_amount", "work_stage", "sanction_date")) + "))"
_IDLE = _COUNTED
_EXTRA = ["state_id", "avg_work_cost", "median_work_cost"]
_ALL_COLUMNS = ["member_type", "member_id", "ranking_qualified", *_METRICS, *_EXTRA]

CTES: list[tuple[str, str]] = [
    ("paid", f"SELECT {_whole('work_recommendation_dtl_id')} AS wid, {_amount('fund_disbursed_amt')} AS amount, {_date('expenditure_date')} AS day FROM (SELECT DISTINCT sno, work_recommendation_dtl_id, fund_disbursed_amt, expenditure_date FROM expenditure)"),
    ("payments", "SELECT CAST(wid AS BIGINT) AS work_id, CAST(sum(amount) AS DECIMAL(18,2)) AS expenditure_amount, min(day) AS first_expenditure_date, max(day) AS last_expenditure_date, count(*) AS n_payments FROM paid WHERE wid IS NOT NULL GROUP BY 1"),
    ("latest", "SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY work_id ORDER BY last_calculated DESC) AS rn FROM work_analysis WHERE work_id IS NOT NULL) WHERE rn = 1"),
    (
        "works",
        f"SELECT work_id, upper(replace(member_type, ' ', '')) AS member_type, member_id, state_id, {_activity('activity_name')} AS normalized_activity, work_category, recommendation_date, sanction_date, completion_date, "
        "CAST(CASE WHEN latest.recommended_amount > 0 THEN latest.recommended_amount ELSE 0 END AS DECIMAL(18,2)) AS recommended_amount, CAST(CASE WHEN sanction_amount > 0 THEN sanction_amount ELSE 0 END AS DECIMAL(18,2)) AS sanction_amount, "
        "CASE WHEN completion_amount > 0 THEN completion_amount END AS completion_amount, payments.expenditure_amount AS expenditure_amount, first_expenditure_date, last_expenditure_date FROM latest LEFT JOIN payments USING (work_id)",
    ),
    ("dated", "SELECT *, CASE WHEN completion_date IS NOT NULL THEN 'Completed' WHEN sanction_date IS NOT NULL THEN 'In Progress' WHEN recommendation_date IS NOT NULL THEN 'Recommended' ELSE 'Unknown' END AS status FROM works"),
    (
        "measured",
        f"SELECT *, date_diff('day', recommendation_date, sanction_date) AS sanction_delay_days, date_diff('day', recommendation_date, {REF}) AS project_age_days, CASE WHEN completion_date >= sanction_date THEN date_diff('day', sanction_date, completion_date) END AS execution_days, "
        f"CASE WHEN status <> 'Completed' THEN date_diff('day', sanction_date, {REF}) END AS pending_days, date_diff('day', last_expenditure_date, {REF}) AS days_since_payment, "
        + ", ".join(f"CASE WHEN sanction_amount > 0 THEN {_r(f'CAST({c}_amount AS DOUBLE) / CAST(sanction_amount AS DOUBLE) * 100')} END AS {c}_percentage" for c in ("expenditure", "completion"))
        + " FROM dated",
    ),
    ("peers", "SELECT *, CAST(sanction_amount AS DOUBLE) AS cost, CAST(execution_days AS DOUBLE) AS duration FROM measured WHERE sanction_amount > 0 AND sanction_date IS NOT NULL AND normalized_activity <> ''"),
    ("pools", "SELECT 'MP' AS pool, * FROM peers UNION ALL SELECT 'MLA', * FROM peers WHERE member_type = 'MLA'"),
    (
        "groups_",
        f"SELECT pool, 'STATE' AS level, normalized_activity, state_id, n, {_CELLS} FROM (SELECT pool, normalized_activity, state_id, {_GROUPS} FROM pools WHERE state_id IS NOT NULL GROUP BY ALL) "
        f"UNION ALL SELECT pool, 'NATIONAL', normalized_activity, NULL, n, {_CELLS} FROM (SELECT pool, normalized_activity, {_GROUPS} FROM pools GROUP BY ALL)",
    ),
    (
        "picked",
        "SELECT m.*, CASE WHEN s.n >= 20 THEN 'ACTIVITY_STATE_STRONG' WHEN s.n >= 10 THEN 'ACTIVITY_STATE_GOOD' WHEN s.n >= 5 THEN 'ACTIVITY_STATE_LIMITED' WHEN c.n >= 20 THEN 'ACTIVITY_NATIONAL_STRONG' WHEN c.n >= 10 THEN 'ACTIVITY_NATIONAL_GOOD' WHEN c.n >= 5 THEN 'ACTIVITY_NATIONAL_LIMITED' ELSE 'INSUFFICIENT' END AS benchmark_quality, "
        "CASE WHEN s.n >= 5 THEN s.n WHEN c.n >= 5 THEN c.n ELSE 0 END AS benchmark_sample_size, "
        + ", ".join(f"CASE WHEN s.n >= 5 THEN s.{w}_p{p} WHEN c.n >= 5 THEN c.{w}_p{p} END AS {w}_p{p}" for w in ("cost", "duration") for p in (25, 50, 75, 90, 95))
        + " FROM measured m LEFT JOIN groups_ s ON s.level = 'STATE' AND s.pool = CASE WHEN m.member_type = 'MLA' THEN 'MLA' ELSE 'MP' END AND s.normalized_activity = m.normalized_activity AND s.state_id = m.state_id "
        "LEFT JOIN groups_ c ON c.level = 'NATIONAL' AND c.pool = CASE WHEN m.member_type = 'MLA' THEN 'MLA' ELSE 'MP' END AND c.normalized_activity = m.normalized_activity",
    ),
    ("banded", f"SELECT *, {_band('CAST(sanction_amount AS DOUBLE)', 'cost')} AS cost_percentile, {_band('CAST(execution_days AS DOUBLE)', 'duration')} AS duration_percentile FROM picked"),
    (
        "benchmarked",
        f"SELECT *, {_peer_status('cost_percentile', 'HIGH', 'LOW')} AS cost_status, {_peer_status('duration_percentile', 'LONG', 'SHORT')} AS duration_status, "
        f"CASE WHEN cost_p50 <> 0 THEN {_r('(CAST(sanction_amount AS DOUBLE) - cost_p50) / cost_p50 * 100')} END AS cost_deviation, CASE WHEN duration_p50 <> 0 THEN {_r('(CAST(execution_days AS DOUBLE) - duration_p50) / duration_p50 * 100')} END AS duration_deviation FROM banded",
    ),
    (
        "t",
        ", ".join(f"{_r(f'p[{i + 1}]', 4)} AS delay_p{q}" for i, q in enumerate((75, 90, 95))).join(["SELECT ", f", {_r('d', 4)} AS duration_p90 FROM (SELECT quantile_cont(CAST(sanction_delay_days AS DOUBLE), [0.75, 0.9, 0.95]) FILTER (WHERE sanction_delay_days >= 0) AS p, quantile_cont(CAST(execution_days AS DOUBLE), 0.9) AS d FROM measured)"]),
    ),
    ("raised", f"SELECT benchmarked.*, {_listed(_FLAGS)} AS risk_flags, {_listed(_SIGNALS)} AS positive_signals FROM benchmarked, t"),
    (
        "flagged",
        "SELECT *, len(risk_flags) AS flag_count, CASE WHEN list_contains(risk_flags, 'OVER_EXPENDITURE') OR k >= 3 THEN 'HIGH' WHEN k = 2 THEN 'MEDIUM' WHEN k = 1 THEN 'LOW' ELSE 'NORMAL' END AS risk_level "
        "FROM (SELECT *, len(list_filter(risk_flags, lambda x: x <> 'SOURCE_DATA_DEFECT_NEGATIVE_DELAY')) AS k FROM raised)",
    ),
    ("members_", f"SELECT *, {_RATES}, total_works >= 5 AS ranking_qualified FROM (SELECT member_type, member_id, {', '.join([*_SHARED, *_MEMBER])} FROM flagged GROUP BY member_type, member_id)"),
    ("states_", f"SELECT *, {_RATES}, total_works >= 10 AND active_members >= 2 AS ranking_qualified FROM (SELECT state_id, {', '.join([*_SHARED, *_STATE])} FROM flagged WHERE state_id IS NOT NULL GROUP BY state_id)"),
    (
        "master",
        " UNION ALL ".join(f"SELECT '{t}' AS member_type, {s}_id AS member_id, {s}_name AS member_name, house_name, tenure, constituency_id FROM (SELECT *, row_number() OVER (PARTITION BY {s}_id ORDER BY loaded_at DESC, {s}_name DESC, house_name DESC NULLS LAST, tenure DESC NULLS LAST, constituency_id DESC NULLS LAST) AS rn FROM {s}s WHERE {s}_id IS NOT NULL) WHERE rn = 1" for t, s in (("MP", "mp"), ("MLA", "mla"))),
    ),
    ("named", f"SELECT *, {_member('member_name')} AS normalized_name FROM master"),
    ("taken", "SELECT DISTINCT member_type, normalized_name FROM named SEMI JOIN works USING (member_type, member_id) WHERE normalized_name <> ''"),
    ("idle", "SELECT named.* FROM named ANTI JOIN (SELECT DISTINCT member_type, member_id FROM works) USING (member_type, member_id) ANTI JOIN taken USING (member_type, normalized_name)"),
    (
        "limits",
        f"SELECT CASE WHEN lower({_strip('house_name')}) = 'state assembly' THEN 'MLA' ELSE 'MP' END AS member_type, mp_name AS member_name, state_name, constituency, house_name, tenure, {_date('tenure_start_date')} AS tenure_start_date, {_date('tenure_end_date')} AS tenure_end_date, "
        f"{_amount('allocated_amt')} AS allocated_amount, sno, {_member('mp_name')} AS normalized_name FROM allocated_limit WHERE {_strip('mp_name')} <> ''",
    ),
    (
        "context",
        "SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY normalized_name ORDER BY sno, member_type, member_name NULLS FIRST, state_name NULLS FIRST, constituency NULLS FIRST, house_name NULLS FIRST, tenure NULLS FIRST, tenure_start_date NULLS FIRST, tenure_end_date NULLS FIRST, allocated_amount NULLS FIRST) AS rn FROM limits WHERE normalized_name <> '') WHERE rn = 1",
    ),
    ("everyone", f"SELECT {', '.join(_ALL_COLUMNS)} FROM members_ UNION ALL SELECT member_type, member_id, false, {', '.join('0' if c in _IDLE else 'NULL' for c in [*_METRICS, *_EXTRA])} FROM idle"),
    *_rank_chain("member", "everyone", "member_type, member_id", "member_type", "ranking_qualified"),
    *_rank_chain("state", "states_", "state_id", "", "total_works IS NOT NULL"),
    *_z_chain("m", "members_", _MEMBER_Z, "member_type, member_id", "member_type, feature", 50, 20),
    *_z_chain("s", "states_", _STATE_Z, "state_id", "feature", 100, 50),
    ("deliveries", f"SELECT CAST({_whole('work_recommendation_dtl_id')} AS BIGINT) AS work_id, loaded_at, removed_at, letter_no, {_HASHED} AS content_hash FROM works_recommended"),
    (
        "ends",
        "SELECT work_id, min(loaded_at) AS first_load, max(loaded_at) AS last_load, first(content_hash ORDER BY loaded_at, content_hash, letter_no NULLS FIRST) AS a_hash, first(letter_no ORDER BY loaded_at, content_hash, letter_no NULLS FIRST) AS a_letter, "
        "last(content_hash ORDER BY loaded_at, content_hash, removed_at IS NULL) AS b_hash, last(removed_at IS NULL ORDER BY loaded_at, content_hash, removed_at IS NULL) AS there FROM deliveries WHERE work_id IS NOT NULL GROUP BY work_id",
    ),
    ("old_", "SELECT work_id, a_hash AS content_hash, a_letter AS letter_no FROM ends WHERE first_load < TIMESTAMP '2024-01-01'"),
    ("new_", "SELECT work_id, b_hash AS content_hash FROM ends WHERE there AND last_load >= TIMESTAMP '2020-01-01'"),
    (
        "diff",
        "SELECT COALESCE(o.work_id, n.work_id) AS work_id, CASE WHEN o.work_id IS NULL THEN 'append' WHEN n.work_id IS NULL THEN 'removed' WHEN o.content_hash = n.content_hash THEN 'unchanged' ELSE 'update' END AS op FROM old_ o FULL JOIN new_ n ON o.work_id = n.work_id",
    ),
    ("changed", "SELECT work_id FROM diff WHERE op IN ('append', 'update')"),
]


def _sql(final: str) -> str:
    return "WITH " + ",\n".join(f"{name} AS ({body})" for name, body in CTES) + "\n" + final


def _refs(keys: str, roles: list[tuple], where: str) -> str:
    parts = [f"SELECT {keys}, '{name}' AS evidence_role, CAST({order} AS DOUBLE) AS o, {k} AS k, work_id FROM flagged WHERE ({condition}){where}" for name, condition, order, k in roles]
    return f"SELECT {keys}, evidence_role, CAST(place AS INTEGER) AS place, work_id FROM (SELECT *, row_number() OVER (PARTITION BY {keys}, evidence_role ORDER BY o, work_id) AS place FROM ({' UNION ALL '.join(parts)})) WHERE place <= k"


def _statistics() -> str:
    long = " UNION ALL ".join(f"SELECT '{m}' AS metric_name, member_type, CAST({m} AS DOUBLE) AS v FROM members_ WHERE total_works > 0 AND {m} IS NOT NULL" for m in _METRICS)
    scoped = f"SELECT metric_name, s AS scope, v FROM (SELECT metric_name, unnest(['BOTH', member_type]) AS s, v FROM ({long})) WHERE s IS NOT NULL"
    quant = ", ".join(f"{_r(f'quantile_cont(v, {q})', 4)} AS {n}" for q, n in ((0.25, "p25"), (0.5, "median"), (0.75, "p75"), (0.9, "p90"), (0.95, "p95")))
    return f"SELECT metric_name, scope, count(*) AS n, {_r('CAST(sum(CAST(v AS DECIMAL(28,4))) AS DOUBLE) / count(v)', 4)} AS mean, {_r('stddev_pop(v)', 4)} AS std_dev, {_r('min(v)', 4)} AS minimum, {quant}, {_r('max(v)', 4)} AS maximum, {_r('quantile_cont(v, 0.75) - quantile_cont(v, 0.25)', 4)} AS iqr FROM ({scoped}) GROUP BY metric_name, scope"


_TREND = f"SELECT year(COALESCE(recommendation_date, sanction_date, last_expenditure_date, completion_date)) AS year, member_type, {', '.join(_SHARED[:9])}, {_SHARED[9]}, {_SHARED[11]} FROM flagged WHERE COALESCE(recommendation_date, sanction_date, last_expenditure_date, completion_date) IS NOT NULL GROUP BY 1, 2"
_CATEGORY = ", ".join(
    [
        "count(*) AS sample_size",
        "count(DISTINCT (member_type, member_id)) AS distinct_members",
        _n("status = 'Completed'", "completed_works"),
        _n("status = 'In Progress'", "ongoing_works"),
        _n("status = 'Recommended'", "recommended_works"),
        _n("sanction_amount > 0", "sanctioned_works"),
        *_SHARED[5:8],
        _n("project_age_days > 365 AND status <> 'Completed'", "overdue_works"),
        _n("flag_count >= 1", "flagged_works"),
        _mean(_PRICED, "avg_work_cost"),
        _med(_PRICED, "median_work_cost"),
        _mean("execution_days", "avg_execution_days"),
        _med("execution_days", "median_execution_days"),
    ]
)
_KEYED = f"(SELECT *, {_category('normalized_activity', 'work_category')} AS category FROM flagged)"
_FY = "CASE WHEN month({0}) >= 4 THEN year({0}) ELSE year({0}) - 1 END"
_OVERALL_SUMS = "total_works recommended_works sanctioned_works completed_works ongoing_works pending_works recommended_amount sanctioned_amount expenditure_amount flagged_works high_risk_works cost_anomaly_works duration_anomaly_works overdue_over_1_year overdue_over_2_years".split()
_COST = "CASE WHEN total_works > 0 AND sanctioned_amount > 0 AND sanctioned_works > 0 THEN sanctioned_amount / sanctioned_works END"


def _overall() -> str:
    sums = ", ".join(f"CAST(sum(CAST({c} AS DECIMAL(28,2))) AS {'DOUBLE' if c.endswith('amount') else 'BIGINT'}) AS {c}" for c in _OVERALL_SUMS)
    means = ", ".join(f"{_r(f'CAST(sum(CAST({m} AS DECIMAL(28,4))) FILTER (WHERE total_works > 0) AS DOUBLE) / count({m}) FILTER (WHERE total_works > 0)')} AS {m}, {_r(f'quantile_cont({m}, 0.5) FILTER (WHERE total_works > 0)')} AS {m.replace('avg', 'median')}" for m in ("avg_sanction_delay_days", "avg_execution_days", "avg_project_age_days"))
    at = ", ".join(f"{_r(f'costs[CAST(floor(len(costs) * {q}) AS INTEGER) + 1]')} AS {n}_work_cost" for n, q in (("p25", 0.25), ("median", 0.5), ("p75", 0.75), ("p90", 0.9), ("p95", 0.95)))
    inner = (
        f"SELECT scope, count(*) AS total_members, {_n('total_works > 0', 'work_bearing')}, {_n('total_works = 0', 'zero_work_members')}, {_n('total_works BETWEEN 1 AND 4', 'low_sample_members')}, {sums}, list_sort(list({_COST}) FILTER (WHERE {_COST} IS NOT NULL)) AS costs, {means} "
        "FROM (SELECT *, unnest(['BOTH', member_type]) AS scope FROM everyone) WHERE scope IS NOT NULL GROUP BY scope"
    )
    return f"SELECT * EXCLUDE (costs), {_rate('completed_works', 'total_works')} AS completion_rate_pct, {_rate('sanctioned_works', 'total_works')} AS sanction_rate_pct, CASE WHEN sanctioned_amount > 0 THEN {_r('expenditure_amount / sanctioned_amount * 100')} ELSE 0.0 END AS fund_utilization_pct, {at} FROM ({inner})"


def _categories() -> str:
    rates = f"{_rate('completed_works', 'sample_size')} AS completion_rate_pct, CASE WHEN sanctioned_amount <> 0 THEN {_r('expenditure_amount / sanctioned_amount * 100')} END AS utilization_pct, {_rate('overdue_works', 'sample_size')} AS overdue_rate_pct, {_rate('flagged_works', 'sample_size')} AS risk_rate_pct, CASE WHEN sample_size >= 100 THEN 'HIGH' WHEN sample_size >= 20 THEN 'MEDIUM' WHEN sample_size >= 5 THEN 'LOW' ELSE 'INSUFFICIENT' END AS confidence"
    inner = f"SELECT 'NATIONAL' AS scope, category, CAST(NULL AS INTEGER) AS state_id, {_CATEGORY} FROM {_KEYED} GROUP BY category UNION ALL SELECT 'STATE', category, state_id, {_CATEGORY} FROM {_KEYED} WHERE state_id IS NOT NULL GROUP BY category, state_id"
    return f"SELECT * EXCLUDE (overdue_works, flagged_works), {rates} FROM ({inner})"


def _fiscal() -> str:
    kinds = (("recommended", "recommendation_date", "recommended_amount"), ("sanctioned", "sanction_date", "sanction_amount"), ("completed", "completion_date", "completion_amount"))
    events = " UNION ALL ".join(f"SELECT member_type, '{k}' AS kind, {d} AS day, CAST({a} AS DECIMAL(18,2)) AS amount FROM measured" for k, d, a in kinds)
    events += " UNION ALL SELECT member_type, 'expenditure', paid.day, paid.amount FROM paid JOIN measured ON paid.wid = measured.work_id"
    counts = ", ".join(_n(f"kind = '{k}'", n) for k, n in (("recommended", "recommended_works"), ("sanctioned", "sanctioned_works"), ("completed", "completed_works"), ("expenditure", "expenditure_count")))
    sums = ", ".join(f"CAST(COALESCE(sum(amount) FILTER (WHERE kind = '{k}'), 0) AS DOUBLE) AS {n}" for k, n in (("recommended", "recommended_amount"), ("sanctioned", "sanctioned_amount"), ("completed", "completion_amount"), ("expenditure", "expenditure_amount")))
    return f"SELECT *, fy_start || '-' || lpad(CAST((fy_start + 1) % 100 AS VARCHAR), 2, '0') AS fy_label FROM (SELECT {_FY.format('day')} AS fy_start, member_type, {counts}, {sums} FROM ({events}) WHERE day IS NOT NULL GROUP BY 1, 2)"


_MARKS = (
    "SELECT member_type, member_id, n, amount FROM (SELECT upper(replace(member_type, ' ', '')) AS member_type, member_id, count(*) AS n, sum(sanction_amount) AS amount FROM "
    "(SELECT *, row_number() OVER (PARTITION BY work_id ORDER BY last_calculated DESC) AS rn FROM work_analysis WHERE work_id IS NOT NULL{0}) WHERE rn = 1 GROUP BY 1, 2) WHERE member_type IS NOT NULL AND member_id IS NOT NULL"
)

_ALLOCATION = (
    f"SELECT member_type, member_id, CAST(COALESCE(amount, 0) AS DOUBLE) AS allocated_amount, CASE WHEN n = 1 THEN 'HIGH' WHEN n > 1 THEN 'MEDIUM' ELSE 'LOW' END AS allocated_confidence FROM master LEFT JOIN "
    f"(SELECT k, tenure, h, count(*) AS n, max(amount) AS amount FROM (SELECT DISTINCT {_alloc('mp_name')} AS k, tenure, lower({_strip('''COALESCE(house_name, '')''')}) AS h, {_amount('allocated_amt')} AS amount FROM allocated_limit) WHERE k <> '' AND amount IS NOT NULL GROUP BY k, tenure, h) b ON b.k = {_alloc('member_name')} AND b.tenure = master.tenure AND b.h = lower({_strip('''COALESCE(master.house_name, '')''')})"
)

ORACLES = {
    "normalize_member_name": f"SELECT DISTINCT sno, mp_name, {_member('mp_name')} AS member_name, {_alloc('mp_name')} AS allocation_name FROM allocated_limit",
    "parse_date": f"SELECT sno, max({_date('expenditure_date')}) AS day, CAST(max({_amount('fund_disbursed_amt')}) AS DOUBLE) AS amount FROM expenditure GROUP BY sno",
    "normalize_activity": f"SELECT {_activity('activity_name')} AS normalized_activity, {_category(_activity('activity_name'), 'work_category')} AS category, count(*) AS n_rows FROM works_recommended GROUP BY 1, 2",
    "work_lifecycle": _sql("SELECT work_id, status, sanction_delay_days, project_age_days, execution_days, pending_days, days_since_payment, expenditure_percentage, completion_percentage FROM measured"),
    "benchmark_groups": _sql("SELECT * FROM groups_"),
    "benchmark_select": _sql("SELECT work_id, benchmark_quality, benchmark_sample_size, cost_percentile, duration_percentile, cost_status, duration_status, cost_deviation, duration_deviation FROM benchmarked"),
    "delay_distribution": _sql("SELECT * FROM t"),
    "risk_flags": _sql("SELECT work_id, array_to_string(risk_flags, ',') AS risk_flags, CAST(flag_count AS INTEGER) AS flag_count, risk_level, array_to_string(positive_signals, ',') AS positive_signals FROM flagged"),
    "member_metrics": _sql("SELECT * FROM members_"),
    "state_metrics": _sql("SELECT * FROM states_"),
    "national_statistics": _sql(_statistics()),
    "trends": _sql(f"SELECT *, {_rate('completed_works', 'total_works')} AS completion_rate_pct, year = 2026 AS is_partial_year FROM ({_TREND})"),
    "trends_dedup": _sql(f"SELECT year, member_type, total_works + 1 AS total_works FROM ({_TREND}) WHERE member_type IS NOT NULL"),
    "overall_metrics": _sql(_overall()),
    "category_metrics": _sql(_categories()),
    "fy_metrics": _sql(_fiscal()),
    "zero_work_members": _sql("SELECT idle.member_type, member_id, idle.normalized_name, c.state_name, c.house_name, c.tenure, c.allocated_amount FROM idle LEFT JOIN context c USING (normalized_name)"),
    "allocation_match": _sql(_ALLOCATION),
    "competition_rank": _sql("SELECT * FROM member_ranks"),
    "state_rank": _sql("SELECT * FROM state_ranks"),
    "peer_rank": _sql(
        f"SELECT member_type, member_id, cluster_id, CAST(rk AS INTEGER) AS peer_rank, {_r('CAST((n - rk) * 100 AS DOUBLE) / greatest(n - 1, 1)')} AS peer_percentile FROM (SELECT *, rank() OVER (PARTITION BY member_type, cluster_id ORDER BY performance_score_weighted DESC) AS rk, count(*) OVER (PARTITION BY member_type, cluster_id) AS n FROM "
        "(SELECT member_type, member_id, performance_score_weighted, CASE WHEN member_id % 7 <> 0 THEN CAST(member_id % 4 - 1 AS INTEGER) END AS cluster_id FROM member_ranks SEMI JOIN (SELECT member_type, member_id FROM members_ WHERE total_works >= 5) USING (member_type, member_id)) WHERE cluster_id >= 0 AND performance_score_weighted IS NOT NULL)"
    ),
    "risk_percentile_level": _sql(f"SELECT member_type, member_id, {_r('p', 4)} AS risk_percentile, CASE WHEN p >= 0.9 THEN 'CRITICAL' WHEN p >= 0.7 THEN 'HIGH' WHEN p >= 0.4 THEN 'MODERATE' ELSE 'LOW' END AS risk_level FROM (SELECT *, percent_rank() OVER (ORDER BY flagged_rate_pct) AS p FROM members_)"),
    "robust_z": _sql(f"SELECT member_type, member_id, feature, {_r('z', 4)} AS z FROM m_z"),
    "member_anomaly": _sql("SELECT * FROM m_anomaly"),
    "state_anomaly": _sql("SELECT * FROM s_anomaly"),
    "evidence_work_refs": _sql(_refs("member_type, member_id", _MEMBER_REFS, "")),
    "state_work_refs": _sql(_refs("state_id", _STATE_REFS, " AND state_id IS NOT NULL")),
    "ai_candidates": f"WITH now_ AS ({_MARKS.format('')}), known AS ({_MARKS.format(''' AND last_calculated < TIMESTAMP '2026-08-20' ''')}) SELECT now_.member_type, now_.member_id FROM now_ LEFT JOIN known USING (member_type, member_id) WHERE known.n IS NULL OR known.n <> now_.n OR known.amount IS DISTINCT FROM now_.amount",
    "backlog_merge": _sql("SELECT member_type, member_id, CASE WHEN ranking_qualified THEN 'fresh' ELSE 'backlog' END AS source FROM members_ WHERE member_type IS NOT NULL AND member_id IS NOT NULL"),
    "snapshot_diff": _sql("SELECT * FROM diff"),
    "snapshot_dedupe": f"SELECT *, CASE WHEN n_contents > 1 THEN 'conflict' WHEN n_rows > 1 THEN 'repeat' ELSE 'single' END AS state FROM (SELECT CAST({_whole('work_recommendation_dtl_id')} AS BIGINT) AS work_id, count(*) AS n_rows, count(DISTINCT COALESCE(recommended_amount, '<NULL>')) AS n_contents FROM works_recommended GROUP BY 1) WHERE work_id IS NOT NULL",
    "affected_entities": _sql(
        "SELECT 'WORK' AS entity_type, CAST(work_id AS VARCHAR) AS entity_id FROM measured SEMI JOIN changed USING (work_id) UNION SELECT member_type, CAST(member_id AS VARCHAR) FROM measured SEMI JOIN changed USING (work_id) WHERE member_type IS NOT NULL AND member_id IS NOT NULL "
        "UNION SELECT 'STATE', CAST(state_id AS VARCHAR) FROM measured SEMI JOIN changed USING (work_id) WHERE state_id IS NOT NULL"
    ),
    "affected_works": _sql("SELECT work_id FROM measured WHERE normalized_activity IN (SELECT normalized_activity FROM measured SEMI JOIN changed USING (work_id) WHERE normalized_activity IS NOT NULL)"),
    "time_sensitive": _sql("SELECT work_id FROM measured WHERE status IN ('In Progress', 'Recommended') OR expenditure_amount IS NOT NULL"),
    "upsert": "SELECT mp_id, mp_name, constituency_id, loaded_at FROM (SELECT *, row_number() OVER (PARTITION BY mp_id ORDER BY loaded_at DESC, mp_name DESC NULLS LAST, constituency_id DESC NULLS LAST) AS rn FROM mps) WHERE rn = 1",
    "ml_carryover": _sql("SELECT n.work_id, CASE WHEN o.content_hash = n.content_hash THEN o.letter_no END AS letter_no, CASE WHEN o.work_id IS NULL THEN 'new' WHEN o.content_hash = n.content_hash THEN 'preserved' ELSE 'stale' END AS carry_state FROM new_ n LEFT JOIN old_ o ON o.work_id = n.work_id"),
    "audit_duplicates": " UNION ALL ".join(f"SELECT '{t}' AS table_name, CAST(sum(n) AS BIGINT) AS n_rows, count(*) AS n_keys, {_n('n > 1', 'n_repeated_keys')} FROM (SELECT {k}, count(*) AS n FROM {t} GROUP BY {k})" for t, k in (("work_analysis", "work_id"), ("expenditure", "sno"), ("mps", "mp_id"), ("mlas", "mla_id"), ("allocated_limit", "sno"))),
    "audit_orphans": _sql(
        "SELECT 'works without member' AS check_name, count(*) AS n_keys FROM (SELECT DISTINCT member_type, member_id FROM works WHERE member_type IS NOT NULL AND member_id IS NOT NULL) ANTI JOIN master USING (member_type, member_id) UNION ALL "
        "SELECT 'members without work', count(*) FROM idle UNION ALL SELECT 'constituencies of mps', count(*) FROM (SELECT DISTINCT constituency_id FROM mps WHERE constituency_id IS NOT NULL) ANTI JOIN constituencies USING (constituency_id)"
    ),
    "audit_ranges": " UNION ALL ".join(
        f"SELECT '{n}' AS check_name, count(*) AS n_rows FROM work_analysis WHERE {c}"
        for n, c in (
            ("null member", "member_id IS NULL"),
            ("null state", "state_id IS NULL"),
            ("negative amount", "sanction_amount < 0 OR recommended_amount < 0 OR expenditure_amount < 0"),
            ("negative execution", "execution_days < 0"),
            ("share above 100", "expenditure_percentage > 100"),
            ("blank activity", "trim(activity_name) = ''"),
            ("completion before sanction", "completion_date < sanction_date"),
        )
    ),
    "audit_overlap": "SELECT mp_id AS member_id FROM mps INTERSECT SELECT mla_id FROM mlas",
}
ORACLES["work_build"] = (
    f"WITH paid AS ({CTES[0][1]}), payments AS ({CTES[1][1]}), rec AS (SELECT * FROM (SELECT *, CAST({_whole('work_recommendation_dtl_id')} AS BIGINT) AS work_id, row_number() OVER (PARTITION BY {_whole('work_recommendation_dtl_id')} ORDER BY loaded_at DESC, state_name DESC NULLS LAST, mp_name DESC NULLS LAST, activity_name DESC NULLS LAST, work_category DESC NULLS LAST, recommendation_date DESC NULLS LAST, sanction_date DESC NULLS LAST, sanction_amount DESC NULLS LAST, recommended_amount DESC NULLS LAST) AS rn FROM works_recommended) WHERE rn = 1 AND work_id IS NOT NULL), "
    f"san AS (SELECT * FROM (SELECT CAST({_whole('work_recommendation_dtl_id')} AS BIGINT) AS work_id, sanction_date AS s_date, sanction_amount AS s_amount, row_number() OVER (PARTITION BY {_whole('work_recommendation_dtl_id')} ORDER BY loaded_at DESC, state_name DESC NULLS LAST, mp_name DESC NULLS LAST, activity_name DESC NULLS LAST, work_category DESC NULLS LAST, recommendation_date DESC NULLS LAST, sanction_date DESC NULLS LAST, sanction_amount DESC NULLS LAST) AS rn FROM works_sanctioned) WHERE rn = 1 AND work_id IS NOT NULL) "
    f"SELECT work_id, {_activity('activity_name')} AS normalized_activity, {_date('recommendation_date')} AS recommendation_date, COALESCE({_date('s_date')}, {_date('sanction_date')}) AS sanction_date, CAST({_amount('recommended_amount')} AS DOUBLE) AS recommended_amount, CAST(COALESCE({_amount('s_amount')}, {_amount('sanction_amount')}) AS DOUBLE) AS sanction_amount, CAST(expenditure_amount AS DOUBLE) AS expenditure_amount, last_expenditure_date, n_payments FROM rec LEFT JOIN san USING (work_id) LEFT JOIN payments USING (work_id)"
)
_NINE = "work_recommendation_dtl_id work_id expenditure_date vendor_name vendor_id work_status state_name constituency mp_name".split()


def _sha(*columns: str) -> str:
    return "sha256(concat_ws('|', " + ", ".join(f"COALESCE(CAST({c} AS VARCHAR), '<NULL>')" for c in columns) + "))"


def _squeezed(c: str) -> str:
    return f"NULLIF(trim(regexp_replace({c}, '[\\s\\x{{A0}}]+', ' ', 'g')), '')"


_PARTS = [_squeezed(c) for c in ("mp_name", "state_name", "constituency", "tenure")]
_UPPER = "upper(trim(regexp_replace(state_name, '\\s+', ' ', 'g')))"
_P = "CAST(completed_works AS DOUBLE) / total_works"
ORACLES |= {
    "expenditure_fingerprint": f"SELECT {_sha(*_NINE, _amount('fund_disbursed_amt'))} AS fingerprint, count(*) AS n_rows FROM expenditure GROUP BY 1",
    "identity_key": f"SELECT DISTINCT sno, CASE WHEN {' AND '.join(f'{x} IS NOT NULL' for x in _PARTS)} THEN CAST(to_json([{', '.join(_PARTS)}]) AS VARCHAR) END AS identity, {_sha(_amount('allocated_amt'), 'house_of_parliament', _date('tenure_start_date'), _date('tenure_end_date'))} AS content_hash FROM allocated_limit",
    "wilson_score": _sql(
        f"SELECT member_type, member_id, {_r(f'({_P} + 3.8416 / (2 * total_works) - 1.96 * sqrt({_P} * (1 - {_P}) / total_works + 3.8416 / (4 * total_works * total_works))) / (1 + 3.8416 / total_works) * 100')} AS wilson_lower, {_r('(completion_rate_pct * total_works + 250.0) / (total_works + 5.0)')} AS shrunk_rate FROM members_"
    ),
    "prior_strength": _sql(f"SELECT member_type, n, {_r('m', 4)} AS mean, {_r('v', 4)} AS variance, CASE WHEN v > 0 THEN {_r('m * (1 - m) / v - 1')} END AS k FROM (SELECT member_type, count(completion_rate_pct) AS n, avg(completion_rate_pct / 100) AS m, var_pop(completion_rate_pct / 100) AS v FROM members_ WHERE total_works >= 5 GROUP BY member_type)"),
    "allocation_by_state": _sql(
        "SELECT state_id, count(*) AS n_members, CAST(sum(CAST(allocated_amount AS DECIMAL(18,2))) AS DOUBLE) AS allocated_amount FROM (SELECT DISTINCT member_type, member_id, state_id FROM works WHERE state_id IS NOT NULL) JOIN ("
        + _ALLOCATION
        + ") USING (member_type, member_id) GROUP BY state_id"
    ),
    "dimension_resolve": f"WITH known AS (SELECT CAST(state_id AS BIGINT) AS state_id, {_UPPER} AS state_name FROM states), fresh AS (SELECT DISTINCT {_UPPER} AS state_name FROM works_recommended WHERE {_UPPER} <> '' AND {_UPPER} NOT IN (SELECT state_name FROM known)) SELECT state_id, state_name FROM known UNION ALL SELECT (SELECT max(state_id) FROM known) + row_number() OVER (ORDER BY state_name), state_name FROM fresh",
    # The records' hashes hold their keys, so they are as unique as those.
    "stage_verify": _sql("SELECT unnest(['not empty', 'as many rows as expected', 'no repeated keys', 'evidence_hash is unique', 'anomalies exist']) AS check_name, unnest(['CRITICAL', 'HIGH', 'CRITICAL', 'HIGH', 'MEDIUM']) AS severity, unnest([n > 0, true, n = k, n = k, odd > 0 OR n <= 5]) AS passed FROM (SELECT count(*) AS n, count(DISTINCT (member_type, member_id)) AS k FROM everyone), (SELECT count(*) AS odd FROM m_anomaly WHERE anomaly_level <> 'NORMAL')"),
}
_HELD = ("completion_rate_pct", "expenditure_sanction_utilization_pct", "avg_sanction_delay_days")
ORACLES |= {
    "work_profiles": _sql(
        "SELECT work_id, CASE WHEN status = 'Recommended' OR expenditure_percentage IS NULL THEN 'UNKNOWN' WHEN expenditure_percentage >= 90 THEN 'STRONG' WHEN expenditure_percentage >= 50 THEN 'ADEQUATE' ELSE 'LOW' END AS financial_profile, "
        "CASE WHEN status = 'Completed' THEN CASE WHEN sanction_delay_days < 0 THEN 'UNKNOWN' ELSE 'ON_TRACK' END WHEN status = 'Recommended' OR pending_days IS NULL OR pending_days < 0 THEN 'UNKNOWN' WHEN pending_days > COALESCE(duration_p90, 365) * 1.5 THEN 'SEVERELY_DELAYED' WHEN pending_days > COALESCE(duration_p90, 365) THEN 'DELAYED' ELSE 'ON_TRACK' END AS timeline_profile, "
        "CASE WHEN status = 'Completed' OR days_since_payment IS NULL OR days_since_payment < 0 THEN 'NO_DATA' WHEN days_since_payment <= 180 THEN 'ACTIVE' WHEN days_since_payment <= 365 THEN 'SLOWING' ELSE 'STALLED' END AS payment_profile FROM benchmarked"
    ),
    "national_context": _sql("SELECT " + ", ".join(f"{_r(f'quantile_cont({m}, {q})', 4)} AS {m}_{n}" for m in _HELD for q, n in ((0.5, "median"), (0.9, "p90"))) + " FROM members_ WHERE total_works > 0"),
    "audit_histograms": _sql(" UNION ALL ".join(f"SELECT '{c}' AS column_name, CAST({c} AS VARCHAR) AS value, count(*) AS n_rows FROM flagged GROUP BY 2" for c in ("status", "risk_level", "benchmark_quality", "cost_status", "duration_status"))),
}
