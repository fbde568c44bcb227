"""Works that stand for an entity, hashed evidence records, and what is to be done with them again."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Fixed values: (role, condition, order, how many) of a member's references.
MEMBER_ROLES = [
    ("risk", "flag_count >= 1 OR risk_level = 'HIGH'", "0", 5),
    ("positive_signal", "status = 'Completed' AND expenditure_percentage >= 80", "0", 3),
    ("representative", "sanction_amount > 0", "-sanction_amount", 3),
    ("financial", "expenditure_amount > 0", "-expenditure_amount", 3),
    ("execution", "sanction_delay_days > 0", "-sanction_delay_days", 3),
]
STATE_ROLES = [("risk", "flag_count >= 1 OR risk_level = 'HIGH'", "-flag_count", 5), ("representative", "sanction_amount > 0", "-sanction_amount", 3)]
#: The sections of a member's and a state's record and their fields, which are columns of the metrics.
MEMBER_SECTIONS = {
    "portfolio": "total_works recommended_works sanctioned_works completed_works ongoing_works pending_works completion_rate_pct sanction_rate_pct".split(),
    "financial": "recommended_amount sanctioned_amount expenditure_amount completion_amount unspent_amount expenditure_sanction_utilization_pct".split(),
    "execution": "avg_sanction_delay_days median_sanction_delay_days avg_execution_days median_execution_days avg_project_age_days max_project_age_days avg_pending_days max_pending_days".split(),
    "risk": "flagged_works high_risk_works medium_risk_works flagged_rate_pct high_risk_rate_pct overdue_over_1_year overdue_over_2_years".split(),
    "anomalies": "cost_anomaly_works duration_anomaly_works expenditure_over_sanction_works negative_sanction_delay_works avg_cost_percentile avg_duration_percentile".split(),
    "quality": "zero_work_member low_sample_member ranking_qualified".split(),
}
STATE_SECTIONS = {
    "portfolio": "total_works active_members mp_active_members mla_active_members recommended_works sanctioned_works completed_works ongoing_works completion_rate_pct sanction_rate_pct".split(),
    "financial": "recommended_amount sanctioned_amount expenditure_amount completion_amount expenditure_utilization_pct".split(),
    "execution": "avg_sanction_delay_days median_sanction_delay_days avg_execution_days median_execution_days".split(),
    "risk": "flagged_works high_risk_works overdue_over_1_year overdue_over_2_years risk_rate_pct".split(),
    "anomalies": "cost_anomaly_works duration_anomaly_works expenditure_over_sanction_works negative_sanction_delay_works".split(),
    "quality": ["ranking_qualified"],
}
#: Hours until a failed entity is tried again, by attempt; after the last attempt it is given up.
BACKOFF_HOURS = {1: 0, 2: 1, 3: 2, 4: 4, 5: 8, 6: 12, 7: 24, 8: 24, 9: 24, 10: 48}
MOST_ATTEMPTS = 10
#: Classes of failures by what their text says, in order.
ERROR_CLASSES = [("429|rate limit", "RATE_LIMITED"), ("timeout|timed out|deadline", "TIMEOUT"), ("500|502|503", "SERVER_ERROR")]


def work_references(works: DataFrame, keys: list[str], roles: list[tuple] = MEMBER_ROLES) -> DataFrame:
    """(keys, evidence_role, place, work_id): the first works of each entity in each role; ties by work_id.

    One exchange serves all roles: a work is exploded into the roles it has, and a window keeps the
    first of each (Spark limits the rows of each partition before the exchange).
    """
    cells = [F.when(F.expr(condition), F.struct(F.lit(name).alias("evidence_role"), F.expr(order).cast("double").alias("o"), F.lit(k).alias("k"))) for name, condition, order, k in roles]
    each = works.select(*keys, "work_id", F.explode(F.array_compact(F.array(*cells))).alias("r")).select(*keys, "work_id", "r.*")
    place = F.row_number().over(Window.partitionBy(*keys, "evidence_role").orderBy("o", "work_id"))
    most = max(k for *_, k in roles)
    return each.withColumn("place", place).filter(F.col("place") <= most).filter("place <= k").select(*keys, "evidence_role", "place", "work_id")


def _section(columns: list[str]) -> Column:
    return F.struct(*[F.col(c) for c in sorted(columns)])


def member_sections(members: DataFrame, states: DataFrame, statistics: DataFrame, anomalies: DataFrame, idle_context: DataFrame) -> DataFrame:
    """(member_type, member_id, and the ten sections as structs) of every member.

    ``idle_context`` has member_type, member_id and the limit's columns of members without works; all
    others have a null master_context. A member without a state or an anomaly score has null there.
    """
    keys = ["member_type", "member_id"]
    own = statistics.filter("scope = 'BOTH'")
    pick = lambda m, c: F.max(F.when(F.col("metric_name") == m, F.col(c)))
    nation = own.agg(
        F.struct(
            pick("completion_rate_pct", "median").alias("national_completion_rate_median"),
            pick("avg_sanction_delay_days", "median").alias("national_sanction_delay_median"),
            pick("total_works", "median").alias("national_total_works_median"),
            pick("total_works", "p90").alias("national_total_works_p90"),
        ).alias("national_context")
    )
    around = states.select("state_id", F.struct("active_members", "completion_rate_pct", F.col("flagged_rate_pct").alias("risk_rate_pct"), "state_id", "total_works").alias("state_context"))
    odd = anomalies.select(*keys, F.struct("anomaly_level", "anomaly_score", "confidence_level", "contributing_features").alias("entity_anomaly"))
    idle = idle_context.select(*keys, F.struct("allocated_amount", "house_name", "state_name", "tenure").alias("master_context"))
    full = members.withColumns({"zero_work_member": F.col("total_works") == 0, "low_sample_member": F.col("total_works") < 5})
    joined = full.join(F.broadcast(nation), how="left").join(around, "state_id", "left").join(odd, keys, "left").join(idle, keys, "left")
    return joined.select(*keys, *[_section(columns).alias(name) for name, columns in MEMBER_SECTIONS.items()], "national_context", "state_context", "entity_anomaly", "master_context")


def state_sections(states: DataFrame, anomalies: DataFrame) -> DataFrame:
    """(state_id, and the seven sections as structs) of every state with works."""
    renamed = states.withColumns({"mp_active_members": F.col("active_mps"), "mla_active_members": F.col("active_mlas"), "expenditure_utilization_pct": F.col("expenditure_sanction_utilization_pct"), "risk_rate_pct": F.col("flagged_rate_pct")})
    odd = anomalies.select("state_id", F.struct("anomaly_level", "anomaly_score", "confidence_level", "contributing_features").alias("entity_anomaly"))
    return renamed.join(odd, "state_id", "left").select("state_id", *[_section(columns).alias(name) for name, columns in STATE_SECTIONS.items()], "entity_anomaly")


def evidence_records(sections: DataFrame, keys: list[str], version: str = "1") -> DataFrame:
    """(keys, evidence_version, evidence_json, evidence_hash): a nested record of the section columns.

    The JSON has sorted sections and fields and keeps nulls, so equal values give equal hashes.
    """
    body = F.struct(*[F.col(c) for c in sorted(sections.columns) if c not in keys])
    text = F.to_json(body, {"ignoreNullFields": "false"})
    return sections.select(*keys, F.lit(version).alias("evidence_version"), text.alias("evidence_json"), F.sha2(F.concat_ws("|", F.lit(version), *keys, text), 256).alias("evidence_hash"))


def stale_records(current: DataFrame, known: DataFrame, keys: list[str], marks: list[str]) -> DataFrame:
    """The current records that aren't known or whose marks (hash, version) differ from the known ones."""
    seen = known.select(*keys, *[F.col(m).alias(f"_{m}") for m in marks], F.lit(True).alias("_seen"))
    same = F.col("_seen").isNotNull()
    for m in marks:
        same = same & F.col(m).eqNullSafe(F.col(f"_{m}"))
    return current.join(seen, keys, "left").filter(~same).select(*current.columns)


def merge_backlog(fresh: DataFrame, backlog: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, source): fresh candidates, and those of the backlog that aren't among them; rows with a null key are left out."""
    mine = fresh.select(*keys).dropna().distinct().withColumn("source", F.lit("fresh"))
    rest = backlog.select(*keys).dropna().distinct().join(mine.select(*keys), keys, "left_anti").withColumn("source", F.lit("backlog"))
    return mine.unionByName(rest)


def candidates_with_evidence(merged: DataFrame, evidence: DataFrame, keys: list[str]) -> DataFrame:
    """The candidates of ``merge_backlog`` with their current evidence; those whose entity has none any more are left out."""
    return merged.join(evidence, keys)


def request_batches(candidates: DataFrame, keys: list[str], size: str, records_a_request: int = 5, most_characters: int = 40_000, by: list[str] | None = None) -> DataFrame:
    """``candidates`` with request_no: consecutive records (by key) of a group, at most so many and, by the column ``size``, so many characters a request.

    A record longer than the bound is a request of its own. Groups are ``by`` (all of them spread over
    a hash of the key where it isn't given), so no task numbers all records.
    """
    grouped = candidates if by else candidates.withColumn("_group", F.pmod(F.xxhash64(*keys), F.lit(64)))
    parts = by or ["_group"]
    w = Window.partitionBy(*parts).orderBy(*keys)
    numbered = grouped.withColumn("_five", F.floor((F.row_number().over(w) - 1) / records_a_request))
    inside = Window.partitionBy(*parts, "_five").orderBy(*keys)
    # Within a bundle of so many records a running sum starts a new request each time the bound is passed.
    filled = F.aggregate(
        F.collect_list(F.col(size).cast("bigint")).over(inside),
        F.struct(F.lit(0).cast("bigint").alias("held"), F.lit(0).alias("no")),
        lambda acc, n: F.when((acc["held"] > 0) & (acc["held"] + n > most_characters), F.struct(n.alias("held"), (acc["no"] + 1).alias("no"))).otherwise(F.struct((acc["held"] + n).alias("held"), acc["no"].alias("no"))),
    )
    out = numbered.withColumn("_no", filled["no"])
    return out.withColumn("request_no", F.concat_ws(":", *[F.coalesce(F.col(p).cast("string"), F.lit("")) for p in parts], "_five", "_no")).select(*candidates.columns, "request_no")


def error_class(text: Column) -> Column:
    """The class of a failure by its text; UNKNOWN_ERROR for any other, and for none."""
    out = None
    for pattern, name in ERROR_CLASSES:
        hit = F.lower(text).rlike(pattern)
        out = F.when(hit, name) if out is None else out.when(hit, name)
    return out.otherwise("UNKNOWN_ERROR")


def after_attempts(backlog: DataFrame, outcomes: DataFrame, keys: list[str], now: str) -> DataFrame:
    """The backlog after a round of attempts: (keys, status, attempt_count, last_error_class, last_attempt_at, next_retry_at).

    ``outcomes`` has keys, succeeded, message and a time ``attempted_at``; of several of one entity
    the last counts. A success is RESOLVED; a failure is one attempt more, PENDING with a time to try
    again, or EXHAUSTED after the last attempt. ``now`` is a time written out, never the clock.
    """
    last = outcomes.dropna(subset=keys).groupBy(*keys).agg(F.max(F.struct("attempted_at", "succeeded", "message")).alias("o")).select(*keys, "o.*")
    hours = F.create_map(*[F.lit(x) for pair in BACKOFF_HOURS.items() for x in pair])
    joined = backlog.select(*keys, F.col("status").alias("_status"), F.col("attempt_count").alias("_n"), F.col("last_error_class").alias("_class"), F.col("last_attempt_at").alias("_at"), F.col("next_retry_at").alias("_next")).join(last, keys, "full_outer")
    tried, failed = F.col("succeeded").isNotNull(), F.coalesce(~F.col("succeeded"), F.lit(False))
    n = F.coalesce("_n", F.lit(0)) + F.when(failed, 1).otherwise(0)
    at = F.lit(now).cast("timestamp")
    retry = at + F.make_dt_interval(F.lit(0), F.try_element_at(hours, n))
    status = F.when(~tried, F.col("_status")).when(F.col("succeeded"), "RESOLVED").when(n >= MOST_ATTEMPTS, "EXHAUSTED").otherwise("PENDING")
    return joined.select(
        *keys,
        status.alias("status"),
        n.cast("int").alias("attempt_count"),
        F.when(failed, error_class(F.col("message"))).otherwise(F.col("_class")).alias("last_error_class"),
        F.when(failed, at).otherwise(F.col("_at")).alias("last_attempt_at"),
        F.when(~tried, F.col("_next")).when(failed & (n < MOST_ATTEMPTS), retry).alias("next_retry_at"),
    )


def backlog_summary(backlog: DataFrame) -> DataFrame:
    """(status, last_error_class, n_entities) of a backlog."""
    return backlog.groupBy("status", "last_error_class").agg(F.count("*").alias("n_entities"))
