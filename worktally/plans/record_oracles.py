"""DuckDB SQL for the output records, evidence, risks, deltas and audits, written apart from the DataFrame code."""

from __future__ import annotations

from worktally.plans.change_queries import _whole
from worktally.plans.works_oracles import _amount, _date, _member, _n, _r, _sha, _sql, _squeezed, _strip

_PART = "CAST({0} AS DOUBLE) * 100 / greatest(total_works, 1)"
_COMMON = f"COALESCE(expenditure_sanction_utilization_pct, 0.0) AS financial_efficiency, {_PART.format('completed_works')} AS implementation_efficiency, COALESCE(avg_sanction_delay_days, 0.0) AS timeliness"
_MEMBER_PROFILE = f"SELECT member_type, member_id, {_COMMON}, 100 - (flagged_rate_pct + {_PART.format('overdue_over_1_year')} + {_PART.format('cost_anomaly_works')} / 3) AS portfolio_health, ln(total_works + 1) AS portfolio_size_log FROM members_ WHERE total_works >= 5"
_STATE_PROFILE = f"SELECT state_id, {_COMMON}, 100 - ({_PART.format('overdue_over_1_year')} + flagged_rate_pct) / 2 AS portfolio_health, ln(total_works + 1) AS portfolio_size_log, ln(active_members + 1) AS active_members_log FROM states_"
_FEATURES = ["financial_efficiency", "implementation_efficiency", "timeliness", "portfolio_health", "portfolio_size_log"]


def _tag(f: str, title: str) -> str:
    return f"CASE WHEN c.{f} >= m.{f}[2] THEN 'High' WHEN c.{f} >= m.{f}[1] THEN 'Mid' ELSE 'Low' END || ' {title}'"


_CLUSTERS = (
    f"WITH placed AS (SELECT *, CAST(member_id % 4 - 1 AS INTEGER) AS cluster_id FROM ({_MEMBER_PROFILE}) WHERE member_id % 7 <> 0), m AS (SELECT quantile_cont(financial_efficiency, [0.333, 0.666]) AS financial_efficiency, quantile_cont(implementation_efficiency, [0.333, 0.666]) AS implementation_efficiency FROM placed), "
    "c AS (SELECT cluster_id, count(*) AS n, avg(financial_efficiency) AS financial_efficiency, avg(implementation_efficiency) AS implementation_efficiency FROM placed GROUP BY cluster_id) "
    f"SELECT member_type, member_id, placed.cluster_id, CASE WHEN n < 5 THEN 'insufficient' ELSE {_tag('financial_efficiency', 'Financial Eff.')} || ' / ' || {_tag('implementation_efficiency', 'Implementation Eff.')} END AS cluster_label, CASE WHEN n < 5 THEN 0 ELSE n END AS cluster_size FROM placed JOIN c ON c.cluster_id = placed.cluster_id, m"
)


def _risk(keys: str, entities: str, anomalies: str, where: str) -> str:
    """Risk from the scores that the ids give."""
    agg = f"SELECT {keys}, floor(quantile_cont(s, 0.95) * 1000000 + 0.5) / 1000000 AS isolation_95, count(*) AS n FROM (SELECT *, ((work_id * 7919) % 1000) / 1000.0 AS s FROM measured{where}) GROUP BY {keys}"
    raw = f"SELECT {keys}, isolation_95, COALESCE(n, 0) AS n, (COALESCE(isolation_95, 0.0) + CASE WHEN anomaly_score IS NULL THEN 0.5 ELSE greatest(0.0, least(1.0, (anomaly_score + 3) / 6)) END) / 2 * 100 AS raw FROM {entities} LEFT JOIN ({agg}) USING ({keys}) LEFT JOIN {anomalies} USING ({keys})"
    band = lambda x, steps, other: "CASE " + " ".join(f"WHEN {x} >= {a} THEN '{b}'" for a, b in steps) + f" ELSE '{other}' END"
    return (
        f"SELECT {keys}, {_r('raw')} AS risk_score, {band('place', ((0.9, 'CRITICAL'), (0.7, 'HIGH'), (0.4, 'MODERATE')), 'LOW')} AS risk_level, {band('n + 1', ((5, 'HIGH'), (2, 'MEDIUM')), 'LOW')} AS confidence, {band('raw', ((70, 'CRITICAL'), (50, 'HIGH'), (35, 'MODERATE')), 'LOW')} AS evidence_level, "
        f"CASE WHEN isolation_95 IS NULL THEN 'statistical anomaly only' ELSE printf('isolation anomaly 95th percentile %.2f', {_r('isolation_95')}) END AS evidence_summary, n AS sample_size FROM (SELECT *, percent_rank() OVER (ORDER BY raw) AS place FROM ({raw}))"
    )


_SUMMED = _r("COALESCE(completion_rate_pct, 0.0) + COALESCE(expenditure_sanction_utilization_pct, 0.0)")
_SUM_BAND = "CASE WHEN {0} >= 160 THEN 'PERFORMER' WHEN {0} >= 120 THEN 'AVERAGE' WHEN {0} >= 80 THEN 'NEEDS_ATTENTION' ELSE 'UNDERPERFORMER' END"
_ZEROED = ", ".join(f"CAST(COALESCE({c}, 0) AS DOUBLE) AS {c}" for c in "recommended_amount sanctioned_amount expenditure_amount completion_amount unspent_amount".split())
_MEMBER_COPIED = (
    "e.total_works, recommended_works, sanctioned_works, completed_works, ongoing_works, pending_works, completion_rate_pct, sanction_rate_pct, sanction_conversion_pct, avg_sanction_delay_days, median_sanction_delay_days, avg_execution_days, median_execution_days, "
    "avg_project_age_days, max_project_age_days, overdue_over_1_year, overdue_over_2_years, flagged_works, high_risk_works, medium_risk_works, flagged_rate_pct, high_risk_rate_pct, cost_anomaly_works, duration_anomaly_works"
)
_MEMBER_RECORD = (
    "SELECT e.member_type, e.member_id, COALESCE(n.member_name, c.member_name) AS member_name, e.state_id, COALESCE(s.state_name, c.state_name) AS state_name, n.constituency_id, c.house_name, c.tenure, c.tenure_start_date, c.tenure_end_date, "
    f"{_MEMBER_COPIED}, CAST(COALESCE(c.allocated_amount, 0) AS DOUBLE) AS allocated_amount, {_ZEROED}, COALESCE(expenditure_sanction_utilization_pct, 0.0) AS fund_utilization_pct, COALESCE(expenditure_recommendation_pct, 0.0) AS expenditure_rate_pct, "
    f"COALESCE(avg_work_cost, CASE WHEN sanctioned_amount > 0 AND sanctioned_works > 0 THEN {_r('sanctioned_amount / sanctioned_works')} END) AS avg_work_cost, median_work_cost, a.anomaly_score, COALESCE(a.anomaly_level, 'NORMAL') AS anomaly_level, COALESCE(a.confidence_level, 'LOW') AS confidence_level, "
    f"e.total_works = 0 AS zero_work_member, e.total_works < 5 AS low_sample_member, ranking_qualified, r.performance_classification, {_SUMMED} AS performance_score, r.rank, r.scale_score, r.performance_score_weighted "
    "FROM everyone e LEFT JOIN named n ON n.member_type = e.member_type AND n.member_id = e.member_id LEFT JOIN context c ON c.normalized_name = n.normalized_name LEFT JOIN states s ON s.state_id = e.state_id "
    "LEFT JOIN m_anomaly a ON a.member_type = e.member_type AND a.member_id = e.member_id LEFT JOIN member_ranks r ON r.member_type IS NOT DISTINCT FROM e.member_type AND r.member_id IS NOT DISTINCT FROM e.member_id AND e.member_type IS NOT NULL AND e.member_id IS NOT NULL"
)
_STATE_RECORD = (
    f"WITH m AS ({_MEMBER_RECORD}), held AS (SELECT state_id, count(*) AS total_members, {_n(chr(39).join(['member_type = ', 'MP', '']), 'mp_count')}, {_n(chr(39).join(['member_type = ', 'MLA', '']), 'mla_count')}, CAST(sum(CAST(allocated_amount AS DECIMAL(18,2))) AS DOUBLE) AS allocated_amount FROM m GROUP BY state_id) "
    "SELECT t.state_id, s.state_name, COALESCE(total_members, 0) AS total_members, COALESCE(mp_count, 0) AS mp_count, COALESCE(mla_count, 0) AS mla_count, active_members, t.total_works, recommended_works, sanctioned_works, completed_works, ongoing_works, pending_works, completion_rate_pct, sanction_rate_pct, COALESCE(h.allocated_amount, 0.0) AS allocated_amount, "
    "recommended_amount, sanctioned_amount, expenditure_amount, completion_amount, unspent_amount, expenditure_sanction_utilization_pct AS fund_utilization_pct, expenditure_recommendation_pct AS expenditure_rate_pct, avg_work_cost, median_work_cost, avg_sanction_delay_days, median_sanction_delay_days, avg_execution_days, median_execution_days, "
    "CAST(NULL AS DOUBLE) AS avg_project_age_days, overdue_over_1_year, overdue_over_2_years, flagged_works, high_risk_works, flagged_rate_pct AS risk_rate_pct, cost_anomaly_works, duration_anomaly_works, a.anomaly_score, COALESCE(a.anomaly_level, 'NORMAL') AS anomaly_level, COALESCE(a.confidence_level, 'LOW') AS confidence_level, "
    f"CASE WHEN ranking_qualified THEN {_SUM_BAND.format(_SUMMED)} ELSE 'INSUFFICIENT_DATA' END AS performance_classification, {_SUMMED} AS performance_score, r.rank, r.scale_score, r.performance_score_weighted "
    "FROM states_ t LEFT JOIN states s ON s.state_id = t.state_id LEFT JOIN held h ON h.state_id = t.state_id LEFT JOIN s_anomaly a ON a.state_id = t.state_id LEFT JOIN state_ranks r ON r.state_id = t.state_id"
)
_PRINT = "sha256(concat_ws('|', " + ", ".join(f"'{c}=' || COALESCE(CAST({c} AS VARCHAR), '')" for c in ("sanction_amount", "recommended_amount", "expenditure_amount", "sanction_delay_days", "execution_days", "project_age_days", "cost_percentile", "duration_percentile")) + "))"
_WORK_RECORD = (
    "WITH texts AS (SELECT work_id, constituency_id, state_name, activity_name, work_description FROM (SELECT *, row_number() OVER (PARTITION BY work_id ORDER BY last_calculated DESC) AS rn FROM work_analysis WHERE work_id IS NOT NULL) WHERE rn = 1) "
    "SELECT work_id, member_id, member_type, constituency_id, state_id, state_name, work_category, activity_name, normalized_activity, work_description, status, "
    + ", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in ("recommended_amount", "sanction_amount", "expenditure_amount", "completion_amount"))
    + ", recommendation_date, sanction_date, first_expenditure_date, last_expenditure_date, completion_date, sanction_delay_days, project_age_days, execution_days, pending_days, expenditure_percentage, completion_percentage, "
    "CASE WHEN benchmark_quality LIKE 'ACTIVITY_STATE%' THEN 'ACTIVITY_STATE' WHEN benchmark_quality LIKE 'ACTIVITY_NATIONAL%' THEN 'ACTIVITY_NATIONAL' ELSE 'NONE' END AS benchmark_peer_group, benchmark_quality, benchmark_sample_size, "
    "cost_p25, cost_p50, cost_p75, cost_p90, cost_p95, duration_p25, duration_p50, duration_p75, duration_p90, duration_p95, cost_percentile, duration_percentile, cost_status, duration_status, cost_deviation AS cost_deviation_from_median_percentage, duration_deviation AS duration_deviation_from_median_percentage, "
    f"CAST(to_json(risk_flags) AS VARCHAR) AS risk_flags, CAST(flag_count AS INTEGER) AS flag_count, risk_level, {_PRINT} AS feature_fingerprint FROM flagged LEFT JOIN texts USING (work_id)"
)


def _prefixed(table: str, section: str, columns: str) -> str:
    return ", ".join(f"{table}.{c} AS {section}_{c}" for c in columns.split())


_MEMBER_EVIDENCE = (
    "WITH stats AS (" + "SELECT quantile_cont(CAST(total_works AS DOUBLE), 0.5) AS tm, quantile_cont(CAST(total_works AS DOUBLE), 0.9) AS t9, quantile_cont(completion_rate_pct, 0.5) AS cm, quantile_cont(avg_sanction_delay_days, 0.5) AS dm FROM members_ WHERE total_works > 0), "
    "counted AS (SELECT member_type, member_id, CAST(least(5, count(*) FILTER (WHERE abs(z) >= 2)) AS INTEGER) AS n FROM m_z GROUP BY member_type, member_id), full_ AS (SELECT e.*, m.avg_pending_days AS apd, total_works = 0 AS zero_work_member, total_works < 5 AS low_sample_member FROM everyone e LEFT JOIN (SELECT member_type, member_id, avg_pending_days FROM members_) m USING (member_type, member_id)), "
    "alone AS (SELECT idle.member_type, idle.member_id, c.state_name, c.house_name, c.tenure, c.allocated_amount FROM idle LEFT JOIN context c ON c.normalized_name = idle.normalized_name) SELECT f.member_type, f.member_id, "
    + ", ".join(
        [
            _prefixed("f", "portfolio", "total_works recommended_works sanctioned_works completed_works ongoing_works pending_works completion_rate_pct sanction_rate_pct"),
            _prefixed("f", "financial", "recommended_amount sanctioned_amount expenditure_amount completion_amount unspent_amount expenditure_sanction_utilization_pct"),
            _prefixed("f", "execution", "avg_sanction_delay_days median_sanction_delay_days avg_execution_days median_execution_days avg_project_age_days max_project_age_days avg_pending_days max_pending_days"),
            _prefixed("f", "risk", "flagged_works high_risk_works medium_risk_works flagged_rate_pct high_risk_rate_pct overdue_over_1_year overdue_over_2_years"),
            _prefixed("f", "anomalies", "cost_anomaly_works duration_anomaly_works expenditure_over_sanction_works negative_sanction_delay_works avg_cost_percentile avg_duration_percentile"),
            _prefixed("f", "quality", "zero_work_member low_sample_member ranking_qualified"),
            f"{_r('tm', 4)} AS national_context_national_total_works_median, {_r('t9', 4)} AS national_context_national_total_works_p90, {_r('cm', 4)} AS national_context_national_completion_rate_median, {_r('dm', 4)} AS national_context_national_sanction_delay_median",
            "s.state_id AS state_context_state_id, s.total_works AS state_context_total_works, s.active_members AS state_context_active_members, s.completion_rate_pct AS state_context_completion_rate_pct, s.flagged_rate_pct AS state_context_risk_rate_pct",
            "a.anomaly_score AS entity_anomaly_anomaly_score, a.anomaly_level AS entity_anomaly_anomaly_level, a.confidence_level AS entity_anomaly_confidence_level, CASE WHEN a.anomaly_level IS NOT NULL THEN COALESCE(k.n, 0) END AS entity_anomaly_contributing_features",
            "CAST(i.allocated_amount AS DOUBLE) AS master_context_allocated_amount, i.house_name AS master_context_house_name, i.state_name AS master_context_state_name, i.tenure AS master_context_tenure",
        ]
    )
    + " FROM full_ f LEFT JOIN states_ s ON s.state_id = f.state_id LEFT JOIN m_anomaly a ON a.member_type = f.member_type AND a.member_id = f.member_id LEFT JOIN counted k ON k.member_type = f.member_type AND k.member_id = f.member_id LEFT JOIN alone i ON i.member_type = f.member_type AND i.member_id = f.member_id, stats"
)
_STATE_EVIDENCE = (
    "WITH counted AS (SELECT state_id, CAST(least(5, count(*) FILTER (WHERE abs(z) >= 2)) AS INTEGER) AS n FROM s_z GROUP BY state_id) SELECT t.state_id, "
    + ", ".join(
        [
            _prefixed("t", "portfolio", "total_works active_members recommended_works sanctioned_works completed_works ongoing_works completion_rate_pct sanction_rate_pct"),
            "t.active_mps AS portfolio_mp_active_members, t.active_mlas AS portfolio_mla_active_members",
            _prefixed("t", "financial", "recommended_amount sanctioned_amount expenditure_amount completion_amount"),
            "t.expenditure_sanction_utilization_pct AS financial_expenditure_utilization_pct",
            _prefixed("t", "execution", "avg_sanction_delay_days median_sanction_delay_days avg_execution_days median_execution_days"),
            _prefixed("t", "risk", "flagged_works high_risk_works overdue_over_1_year overdue_over_2_years"),
            "t.flagged_rate_pct AS risk_risk_rate_pct",
            _prefixed("t", "anomalies", "cost_anomaly_works duration_anomaly_works expenditure_over_sanction_works negative_sanction_delay_works"),
            "t.ranking_qualified AS quality_ranking_qualified",
            "a.anomaly_score AS entity_anomaly_anomaly_score, a.anomaly_level AS entity_anomaly_anomaly_level, a.confidence_level AS entity_anomaly_confidence_level, CASE WHEN a.anomaly_level IS NOT NULL THEN COALESCE(k.n, 0) END AS entity_anomaly_contributing_features",
        ]
    )
    + " FROM states_ t LEFT JOIN s_anomaly a ON a.state_id = t.state_id LEFT JOIN counted k ON k.state_id = t.state_id"
)
_NINE = ", ".join(_amount("fund_disbursed_amt") if c == "fund_disbursed_amt" else c for c in "work_recommendation_dtl_id work_id expenditure_date vendor_name work_status fund_disbursed_amt state_name constituency mp_name".split())
_FINGER = "sha256(concat_ws('|', " + ", ".join(f"COALESCE(CAST({c} AS VARCHAR), '<NULL>')" for c in ("work_recommendation_dtl_id", "work_id", "expenditure_date", "vendor_name", "work_status", _amount("fund_disbursed_amt"), "state_name", "constituency", "mp_name")) + "))"
_CLEAN = {c: _squeezed(f"CAST({c} AS VARCHAR)") for c in "work_recommendation_dtl_id work_id expenditure_date vendor_name work_status state_name constituency mp_name".split()}
_PUT = "sha256(concat_ws('|', " + ", ".join(f"COALESCE({c}, '<NULL>')" for c in (_CLEAN["work_recommendation_dtl_id"], _CLEAN["work_id"], _CLEAN["expenditure_date"], _CLEAN["vendor_name"], _CLEAN["work_status"], f"CAST({_amount('fund_disbursed_amt')} AS VARCHAR)", _CLEAN["state_name"], _CLEAN["constituency"], _CLEAN["mp_name"])) + "))"
_WID = f"CAST({_whole('work_recommendation_dtl_id')} AS BIGINT)"


def _kinds() -> str:
    parts = [
        f"SELECT '{t}' AS table_name, CASE WHEN count(DISTINCT {at}) > 1 THEN 'update' ELSE 'append' END AS op FROM {t} GROUP BY {k}"
        for t, k, at in (("works_recommended", "work_recommendation_dtl_id", "loaded_at"), ("works_sanctioned", "sno", "loaded_at"), ("mps", "mp_id", "loaded_at"), ("mlas", "mla_id", "loaded_at"), ("work_analysis", "work_id", "last_calculated"))
    ]
    return f"SELECT table_name, CASE WHEN bool_or(op = 'append') AND bool_or(op = 'update') THEN 'mixed' WHEN bool_or(op = 'append') THEN 'append' ELSE 'update' END AS change_type, count(*) AS n_records FROM ({' UNION ALL '.join(parts)}) GROUP BY table_name"


_CLASS = "CASE WHEN message LIKE '%429%' OR message LIKE '%rate limit%' THEN 'RATE_LIMITED' WHEN message LIKE '%timeout%' OR message LIKE '%timed out%' OR message LIKE '%deadline%' THEN 'TIMEOUT' ELSE 'UNKNOWN_ERROR' END"
_BACKLOG = (
    "WITH b AS (SELECT member_type, member_id, CAST(member_id % 12 AS INTEGER) AS n0 FROM members_ WHERE member_type IS NOT NULL AND member_id % 3 <> 0), o AS (SELECT member_type, member_id, total_works % 4 = 0 AS ok, CASE flagged_works % 3 WHEN 0 THEN '429: rate limit' WHEN 1 THEN 'deadline exceeded' ELSE 'odd' END AS message FROM members_ WHERE member_type IS NOT NULL AND member_id % 5 <> 0), "
    "j AS (SELECT *, COALESCE(n0, 0) + CASE WHEN ok = false THEN 1 ELSE 0 END AS n FROM b FULL JOIN o USING (member_type, member_id)) "
    "SELECT member_type, member_id, CASE WHEN ok IS NULL THEN 'PENDING' WHEN ok THEN 'RESOLVED' WHEN n >= 10 THEN 'EXHAUSTED' ELSE 'PENDING' END AS status, CAST(n AS INTEGER) AS attempt_count, "
    f"CASE WHEN ok = false THEN {_CLASS} WHEN n0 IS NOT NULL THEN 'TIMEOUT' END AS last_error_class, CASE WHEN ok = false THEN TIMESTAMP '2026-09-30' WHEN n0 IS NOT NULL THEN TIMESTAMP '2026-09-01' END AS last_attempt_at, "
    "CASE WHEN ok IS NULL THEN TIMESTAMP '2026-09-02' WHEN ok = false AND n < 10 THEN TIMESTAMP '2026-09-30' + to_hours(CAST([0, 1, 2, 4, 8, 12, 24, 24, 24, 48][n] AS INTEGER)) END AS next_retry_at FROM j"
)


def _loaded(select: str, where: str, tail: str) -> str:
    """The last delivery of each work of a table."""
    return f"SELECT * EXCLUDE (rn, loaded_at) FROM (SELECT *, row_number() OVER (PARTITION BY work_id ORDER BY loaded_at DESC, {tail}) AS rn FROM (SELECT {_WID} AS work_id, loaded_at, {select} FROM {where}) WHERE work_id IS NOT NULL) WHERE rn = 1"


_GIVEN = " OR ".join(f"{_squeezed(c)} IS NOT NULL" for c in ("sanction_date", "sanction_amount", "work_stage"))
_KIND = f"CASE WHEN lower(trim(house_name)) = 'state assembly' THEN 'MLA' ELSE 'MP' END"
_BORNE = "(SELECT member_type, normalized_name, count(*) AS n, min(member_id) AS member_id FROM named WHERE normalized_name <> '' GROUP BY ALL)"
_INVALID = [
    ("works", "work_analysis", [("null work_id", "work_id IS NULL"), ("null member_id", "member_id IS NULL"), ("null member_type", "member_type IS NULL")]),
    ("members", f"({_MEMBER_RECORD})", [("null member_id", "member_id IS NULL"), ("null member_type", "member_type IS NULL"), ("negative total_works", "total_works < 0"), ("negative completed_works", "completed_works < 0"), ("completion_rate_pct out of range", "completion_rate_pct < 0 OR completion_rate_pct > 100"), ("fund_utilization_pct out of range", "fund_utilization_pct < 0 OR fund_utilization_pct > 100"), ("no member_name", "COALESCE(member_name, '') = ''")]),
    ("states", "(SELECT * FROM states_ LEFT JOIN states USING (state_id))", [("null state_id", "state_id IS NULL"), ("negative total_works", "total_works < 0"), ("completion_rate_pct out of range", "completion_rate_pct < 0 OR completion_rate_pct > 100"), ("no state_name", "COALESCE(state_name, '') = ''")]),
]
_LIMIT = "SELECT member_type, member_id, tenure, house_name FROM (SELECT m.member_type, m.member_id, COALESCE(CASE WHEN m.member_id % 2 = 0 THEN m.tenure END, b.tenure) AS tenure, COALESCE(CASE WHEN m.member_id % 2 = 0 THEN m.house_name END, b.house_name) AS house_name FROM master m LEFT JOIN (SELECT member_type, k, min(tenure) AS tenure, min(house_name) AS house_name FROM (SELECT *, {1} AS k FROM limits) GROUP BY member_type, k HAVING count(*) = 1 AND k <> '') b ON b.member_type = m.member_type AND b.k = {0})"
_RISK_GIVEN = _risk("member_type, member_id", "members_", "m_anomaly", "")


def _short(x: str) -> str:
    s = f"regexp_replace(lower({_strip(f'''COALESCE({x}, '')''')}), '\\s*\\([^)]*\\)\\s*$', '')"
    s = f"regexp_replace({s}, '^(shri|smt|dr|mrs|ms|mr|prof|late)\\.?\\s+', '')"
    return _strip(f"regexp_replace({s}, '\\s+', ' ', 'g')")


_HAS = "json_extract(CAST(raw_json AS JSON), '$.MP_NAME') IS NOT NULL"
_PROBLEMS = f"CASE WHEN raw_json IS NULL OR NOT json_valid(raw_json) OR json_type(raw_json) <> 'OBJECT' THEN 'not an object' ELSE concat_ws(',', CASE WHEN NOT ({_HAS}) THEN 'missing MP_NAME' END, CASE WHEN contains(lower(raw_json), 'total_amt') THEN 'contains Total_Amt' END) END"

ORACLES = {
    "json_validation": f"SELECT dataset, {_PROBLEMS} AS problems, count(*) AS n_rows FROM records GROUP BY ALL",
    "member_features": _sql(f"SELECT member_type, member_id, {', '.join(f'{_r(c, 4)} AS {c}' for c in _FEATURES)} FROM ({_MEMBER_PROFILE})"),
    "state_features": _sql(f"SELECT state_id, {', '.join(f'{_r(c, 4)} AS {c}' for c in [*_FEATURES, 'active_members_log'])} FROM ({_STATE_PROFILE})"),
    "cluster_labels": _sql(f"SELECT * FROM ({_CLUSTERS})"),
    "entity_risk_given": _sql(_RISK_GIVEN),
    "state_risk_given": _sql(_risk("state_id", "states_", "s_anomaly", " WHERE state_id IS NOT NULL")),
    "isolation_agg_given": _sql(f"SELECT state_id, {_r('quantile_cont(((work_id * 7919) % 1000) / 1000.0, 0.95)', 4)} AS isolation_95, count(*) AS n FROM measured WHERE state_id IS NOT NULL GROUP BY state_id"),
    "anomaly_explanations": _sql(
        f"SELECT member_type, member_id, feature, {_r('v')} AS feature_value, {_r('z')} AS z_score, CASE WHEN {_r('z')} > 0 THEN 'HIGH' ELSE 'LOW' END AS direction, description FROM (SELECT *, row_number() OVER (PARTITION BY member_type, member_id ORDER BY abs(z) DESC, feature) AS place FROM m_z WHERE abs(z) >= 2 AND member_type IS NOT NULL AND member_id IS NOT NULL) WHERE place <= 5"
    ),
    "member_record": _sql(_MEMBER_RECORD),
    "state_record": _sql(f"SELECT * FROM ({_STATE_RECORD})"),
    "work_record": _sql(f"SELECT * FROM ({_WORK_RECORD})"),
    "member_evidence": _sql(f"SELECT * FROM ({_MEMBER_EVIDENCE})"),
    "state_evidence": _sql(f"SELECT * FROM ({_STATE_EVIDENCE})"),
    "performance_score": _sql(f"SELECT member_type, member_id, {_SUMMED} AS performance_score, {_SUM_BAND.format(_SUMMED)} AS performance_band FROM members_"),
    "master_population": _sql("SELECT member_type, count(*) AS n_records, count(DISTINCT normalized_name) AS n_names FROM limits GROUP BY member_type"),
    "member_resolution": _sql(f"SELECT name_state, count(*) AS n_rows, count(DISTINCT member_id) AS n_members FROM (SELECT CASE WHEN n IS NULL THEN 'missing' WHEN n > 1 THEN 'ambiguous' ELSE 'resolved' END AS name_state, CASE WHEN n = 1 THEN member_id END AS member_id FROM (SELECT {_member('mp_name')} AS normalized_name FROM works_recommended) LEFT JOIN (SELECT * FROM {_BORNE} WHERE member_type = 'MP') USING (normalized_name)) GROUP BY name_state"),
    "tenure_prefill": _sql(_LIMIT.format(_short("m.member_name"), _short("member_name"))),
    "master_context": _sql("SELECT n.member_type, n.member_id, n.normalized_name, c.state_name, c.house_name, c.tenure, c.tenure_start_date, c.tenure_end_date, CAST(c.allocated_amount AS DOUBLE) AS allocated_amount FROM named n LEFT JOIN context c USING (normalized_name)"),
    "ai_evidence": _sql("SELECT member_type, member_id, CASE WHEN ranking_qualified THEN 'fresh' ELSE 'backlog' END AS source, total_works, flagged_works FROM members_ WHERE member_type IS NOT NULL AND member_id IS NOT NULL"),
    "backlog_states": _sql(f"SELECT * FROM ({_BACKLOG})"),
    "change_types": _kinds(),
    "delta_works": f"SELECT DISTINCT w AS work_id FROM (SELECT {_WID} AS w FROM works_recommended UNION ALL SELECT {_WID} + 1000000 FROM works_sanctioned) WHERE w IS NOT NULL",
    "payment_conflicts": f"SELECT state, count(*) AS n_fingerprints, CAST(sum(n) AS BIGINT) AS n_rows FROM (SELECT f, count(*) AS n, CASE WHEN count(DISTINCT fund_disbursed_amt) + max(CASE WHEN fund_disbursed_amt IS NULL THEN 1 ELSE 0 END) > 1 THEN 'conflict' WHEN count(*) > 1 THEN 'repeat' ELSE 'single' END AS state FROM (SELECT {_FINGER} AS f, fund_disbursed_amt FROM expenditure) GROUP BY f) GROUP BY state",
    "diff_counts": "SELECT op, count(*) AS n_records FROM (SELECT CASE WHEN o.sno IS NULL THEN 'append' WHEN n.sno IS NULL THEN 'removed' WHEN o.v IS NOT DISTINCT FROM n.v THEN 'unchanged' ELSE 'update' END AS op FROM (SELECT sno, max(fund_disbursed_amt) AS v FROM expenditure WHERE loaded_at < TIMESTAMP '2024-01-01' GROUP BY sno) o FULL JOIN (SELECT sno, max(fund_disbursed_amt) AS v FROM expenditure WHERE loaded_at >= TIMESTAMP '2024-01-01' GROUP BY sno) n ON o.sno = n.sno) GROUP BY op",
    "ingest_payments": f"WITH known AS (SELECT DISTINCT {_WID} AS wid FROM works_recommended), once AS (SELECT {_PUT} AS f, any_value({_WID}) AS wid, any_value({_squeezed('work_status')}) AS work_status, any_value({_amount('fund_disbursed_amt')}) AS amount FROM expenditure GROUP BY 1) SELECT work_status, known.wid IS NULL AS unmatched, count(*) AS n_payments, CAST(sum(amount) AS DOUBLE) AS amount FROM once LEFT JOIN known ON known.wid = once.wid GROUP BY ALL",
    "ingest_sanctions": _loaded(f"{_date('sanction_date')} AS sanction_date, CAST({_amount('sanction_amount')} AS DOUBLE) AS sanction_amount, {_squeezed('work_stage')} AS work_stage", f"works_sanctioned WHERE {_GIVEN}", "sanction_date DESC NULLS LAST, sanction_amount DESC NULLS LAST, work_stage DESC NULLS LAST"),
    "ingest_recommendations": _loaded(f"{_date('recommendation_date')} AS recommendation_date, CAST({_amount('recommended_amount')} AS DOUBLE) AS recommended_amount, {_squeezed('letter_no')} AS letter_no", "works_recommended", "recommendation_date DESC NULLS LAST, recommended_amount DESC NULLS LAST, letter_no DESC NULLS LAST"),
    "ingest_allocations": _sql(f"SELECT member_type, member_id, CAST(amount AS DOUBLE) AS allocated_amount FROM (SELECT l.member_type, b.member_id, l.amount, row_number() OVER (PARTITION BY l.member_type, b.member_id ORDER BY l.loaded_at DESC, l.amount DESC NULLS LAST) AS rn FROM (SELECT {_KIND} AS member_type, {_member('mp_name')} AS normalized_name, loaded_at, {_amount('allocated_amt')} AS amount FROM allocated_limit) l JOIN (SELECT * FROM {_BORNE} WHERE n = 1) b ON b.member_type = l.member_type AND b.normalized_name = l.normalized_name) WHERE rn = 1"),
    "audit_population": _sql("SELECT member_type, CAST(sum(n) AS BIGINT) AS n_rows, CAST(sum(ids) AS BIGINT) AS n_ids, count(*) FILTER (WHERE normalized_name <> '' AND n > 1) AS n_repeated_names, CAST(COALESCE(sum(n) FILTER (WHERE normalized_name = ''), 0) AS BIGINT) AS n_blank_names FROM (SELECT member_type, normalized_name, count(*) AS n, count(DISTINCT member_id) AS ids FROM named GROUP BY ALL) GROUP BY member_type"),
    "audit_synthetic_ids": _sql(" UNION ALL ".join(f"SELECT '{name}' AS table_name, count(*) FILTER (WHERE {k} < 0 OR {k} >= 100000) AS n_rows FROM {t}" for name, t, k in (("mps", "mps", "mp_id"), ("mlas", "mlas", "mla_id"), ("member_metrics", "members_", "member_id")))),
    "audit_members": _sql("SELECT member_type, count(*) AS n_rows, count(DISTINCT member_id) AS n_ids, CAST(sum(total_works) AS BIGINT) AS n_works, count(*) FILTER (WHERE ranking_qualified) AS n_qualified FROM everyone GROUP BY member_type"),
    "audit_states": _sql("SELECT 'states without a name' AS check_name, count(*) AS n_keys FROM states_ ANTI JOIN states USING (state_id) UNION ALL SELECT 'states without works', count(*) FROM (SELECT DISTINCT state_id FROM states) ANTI JOIN states_ USING (state_id) UNION ALL SELECT 'states of members without metrics', count(*) FROM (SELECT DISTINCT state_id FROM members_ WHERE state_id IS NOT NULL) ANTI JOIN states_ USING (state_id)"),
    "audit_anomalies": _sql("SELECT anomaly_level AS level, count(*) AS n_rows, count(*) FILTER (WHERE anomaly_level NOT IN ('HIGH', 'MEDIUM', 'NORMAL')) AS n_invalid_level, count(*) FILTER (WHERE anomaly_score < 0 OR anomaly_score > 5) AS n_out_of_range, count(*) FILTER (WHERE anomaly_score IS NULL) AS n_null_score FROM m_anomaly GROUP BY anomaly_level"),
    "audit_scores": _sql("SELECT member_type, performance_classification, rank IS NOT NULL AS is_ranked, count(*) AS n_rows, count(*) FILTER (WHERE performance_score_weighted IS NULL) AS n_null, count(*) FILTER (WHERE performance_score_weighted < 0) AS n_negative, count(*) FILTER (WHERE performance_score_weighted > 100) AS n_over_100, min(performance_score_weighted) AS lowest, max(performance_score_weighted) AS highest FROM member_ranks GROUP BY ALL"),
    "audit_ranks": _sql("SELECT member_type, count(*) AS n_ranked, max(rank) AS highest_rank, count(*) FILTER (WHERE rank > (SELECT count(*) FROM member_ranks b WHERE b.rank IS NOT NULL AND b.member_type IS NOT DISTINCT FROM a.member_type)) AS n_beyond, count(*) FILTER (WHERE EXISTS (SELECT 1 FROM member_ranks b WHERE b.member_type = a.member_type AND b.rank < a.rank AND b.performance_score_weighted < a.performance_score_weighted)) AS n_not_monotone FROM member_ranks a WHERE rank IS NOT NULL GROUP BY member_type"),
    "audit_risk": _sql(f"SELECT risk_level AS level, count(*) AS n_rows, 0 AS n_invalid_level, count(*) FILTER (WHERE risk_score < 0 OR risk_score > 100) AS n_out_of_range, count(*) FILTER (WHERE risk_score IS NULL) AS n_null_score FROM ({_RISK_GIVEN}) GROUP BY risk_level"),
    "audit_freshness": " UNION ALL ".join(f"SELECT '{t}' AS table_name, count(*) AS n_rows, min({c}) AS first_time, max({c}) AS last_time FROM {t}" for t, c in (("work_analysis", "last_calculated"), ("expenditure", "loaded_at"), ("mps", "loaded_at"), ("mlas", "loaded_at"), ("works_recommended", "loaded_at"))),
    "audit_invalid": _sql(" UNION ALL ".join(f"SELECT '{name}' AS table_name, '{c}' AS check_name, count(*) FILTER (WHERE {cond}) AS n_rows FROM {t}" for name, t, checks in _INVALID for c, cond in checks)),
    "request_batches": _sql("SELECT member_type, CAST(sum(n) AS BIGINT) AS n_requests, CAST(sum(m) AS BIGINT) AS n_records FROM (SELECT member_type, five, 1 + sum(CASE WHEN breaks THEN 1 ELSE 0 END) AS n, count(*) AS m FROM (SELECT member_type, five, false AS breaks FROM (SELECT member_type, (row_number() OVER (PARTITION BY member_type ORDER BY member_id) - 1) // 5 AS five FROM members_ WHERE member_type IS NOT NULL AND member_id IS NOT NULL)) GROUP BY ALL) GROUP BY member_type"),
}
