"""Queries of the output records, the resolution of names, deltas of payments and the audits."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from worktally.functions import measures
from worktally.functions.text import whole_number
from worktally.operators import audit, delta, evidence, ingest, members, records
from worktally.plans.works_plan import MEMBER, STATE, WorksPlan

QUERIES: dict = {}
_BUILDERS: dict = {}


def build(name: str, plan: WorksPlan) -> DataFrame:
    """The result of a query over the stages a plan has already built."""
    return _BUILDERS[name](plan)


def _query(f):
    _BUILDERS[f.__name__] = f
    QUERIES[f.__name__] = lambda spark, sf_dir: f(WorksPlan(spark, sf_dir))
    QUERIES[f.__name__].__doc__ = f.__doc__
    return f


@_query
def member_record(p: WorksPlan) -> DataFrame:
    """The output record of every member."""
    return records.member_records(p.all_members, p.master, members.first_by_name(p.population), p.table("states"), p.member_anomalies, p.member_ranks)


@_query
def state_record(p: WorksPlan) -> DataFrame:
    """The output record of every state with works."""
    return records.state_records(p.states, p.table("states"), member_record(p), p.state_anomalies, p.state_ranks)


@_query
def work_record(p: WorksPlan) -> DataFrame:
    """The output record of every work."""
    return records.work_records(p.flagged_once, p.table("work_analysis"))


@_query
def performance_score(p: WorksPlan) -> DataFrame:
    """The summed score of every member with works and its class."""
    score = records.summed_score(F.col("completion_rate_pct"), F.col("expenditure_sanction_utilization_pct"))
    return p.members_once.select(*MEMBER, score.alias("performance_score"), records.summed_band(score).alias("performance_band"))


@_query
def master_population(p: WorksPlan) -> DataFrame:
    """Limits and different names of the MPs and of the MLAs."""
    return members.population_counts(p.population)


@_query
def member_resolution(p: WorksPlan) -> DataFrame:
    """How many recommendations have a name that one MP, none or several bear."""
    resolved = members.resolve_names(p.table("works_recommended"), p.master, "mp_name", F.lit("MP"))
    return resolved.groupBy("name_state").agg(F.count("*").alias("n_rows"), F.countDistinct("member_id").alias("n_members"))


@_query
def tenure_prefill(p: WorksPlan) -> DataFrame:
    """Members without a tenure or house, with those of the one limit of their type and name."""
    known = p.population.select("member_type", "member_name", "tenure", "house_name")
    blank = p.master.withColumns({c: F.when(F.col("member_id") % 2 == 0, F.col(c)) for c in ("tenure", "house_name")})
    return members.prefilled(blank, known).select(*MEMBER, "tenure", "house_name")


@_query
def master_context(p: WorksPlan) -> DataFrame:
    """The first limit of each member's name."""
    named = p.master.select(*MEMBER, measures.member_name(F.col("member_name")).alias("normalized_name"))
    context = members.first_by_name(p.population).select("normalized_name", "state_name", "house_name", "tenure", "tenure_start_date", "tenure_end_date", F.col("allocated_amount").cast("double").alias("allocated_amount"))
    return named.join(context, "normalized_name", "left")


@_query
def ai_evidence(p: WorksPlan) -> DataFrame:
    """Fresh candidates and those of the backlog with the sizes of their current evidence."""
    merged = evidence.merge_backlog(p.members.filter("ranking_qualified"), p.members, MEMBER)
    return evidence.candidates_with_evidence(merged, p.members.select(*MEMBER, "total_works", "flagged_works"), MEMBER)


@_query
def backlog_states(p: WorksPlan) -> DataFrame:
    """A backlog of members after a round of attempts, whose outcomes the works give."""
    attempts = F.pmod(F.col("member_id"), F.lit(12)).cast("int")
    time = lambda s: F.lit(s).cast("timestamp")
    named = p.members.dropna(subset=MEMBER)
    backlog = named.filter("member_id % 3 <> 0").select(*MEMBER, F.lit("PENDING").alias("status"), attempts.alias("attempt_count"), F.lit("TIMEOUT").alias("last_error_class"), time("2026-09-01").alias("last_attempt_at"), time("2026-09-02").alias("next_retry_at"))
    said = F.when(F.col("flagged_works") % 3 == 0, "429: Rate limit").when(F.col("flagged_works") % 3 == 1, "deadline exceeded").otherwise("odd")
    outcomes = named.filter("member_id % 5 <> 0").select(*MEMBER, (F.col("total_works") % 4 == 0).alias("succeeded"), said.alias("message"), time("2026-09-30").alias("attempted_at"))
    return evidence.after_attempts(backlog, outcomes, MEMBER, "2026-09-30 00:00:00")


@_query
def change_types(p: WorksPlan) -> DataFrame:
    """Whether each source table got new keys, new versions of known ones, or both."""
    parts = None
    for name, key in (("works_recommended", "work_recommendation_dtl_id"), ("works_sanctioned", "sno"), ("mps", "mp_id"), ("mlas", "mla_id"), ("work_analysis", "work_id")):
        at = "last_calculated" if name == "work_analysis" else "loaded_at"
        loads = p.table(name).groupBy(F.col(key).cast("string").alias("k")).agg(F.countDistinct(at).alias("n"))
        one = loads.select(F.lit(name).alias("table_name"), F.when(F.col("n") > 1, "update").otherwise("append").alias("op"))
        parts = one if parts is None else parts.unionByName(one)
    return delta.change_types(parts)


@_query
def delta_works(p: WorksPlan) -> DataFrame:
    """The works that recommendations and sanctions, taken as a delta of MPs and of MLAs, belong to."""
    one = lambda table, name: p.table(table).select(F.lit(name).alias("table_name"), F.col("work_recommendation_dtl_id").alias("WORK_RECOMMENDATION_DTL_ID"))
    return delta.works_of_delta(one("works_recommended", "works_recommended").unionByName(one("works_sanctioned", "mla_works_sanctioned")).unionByName(one("expenditure", "calamity")))


def _fingerprint():
    return measures.hash_of(*[measures.parse_amount(F.col(c)) if c == "fund_disbursed_amt" else F.col(c) for c in ingest.PAYMENT_IDENTITY])


@_query
def payment_conflicts(p: WorksPlan) -> DataFrame:
    """How many fingerprints of payments occur once, again, or with another content."""
    found = delta.payment_conflicts(p.table("expenditure"), _fingerprint(), ["sno", "vendor_id", "loaded_at"])
    return found.groupBy("state").agg(F.count("*").alias("n_fingerprints"), F.sum("n_rows").alias("n_rows"))


@_query
def diff_counts(p: WorksPlan) -> DataFrame:
    """How many payments one load added, removed or left beside the loads before."""
    rows = p.table("expenditure").select(F.col("sno"), "loaded_at", "fund_disbursed_amt")
    at = F.lit("2024-01-01").cast("timestamp")
    old, new = (rows.filter(c).groupBy("sno").agg(F.max("fund_disbursed_amt").alias("v")) for c in (F.col("loaded_at") < at, F.col("loaded_at") >= at))
    return delta.diff_counts(delta.table_diff(old, new, ["sno"], "v"))


@_query
def ingest_payments(p: WorksPlan) -> DataFrame:
    """Payments as they are put in: once for each fingerprint, with the work they belong to."""
    known = ingest.works(p.table("works_recommended"), "MP")
    out = ingest.payments(p.table("expenditure"), known, "MP")
    return out.groupBy("work_status", F.col("work_id").isNull().alias("unmatched")).agg(F.count("*").alias("n_payments"), F.sum("amount").cast("double").alias("amount"))


@_query
def ingest_sanctions(p: WorksPlan) -> DataFrame:
    """Sanctions as they are put in, from the rows that give any of their fields."""
    out = ingest.sanctions(p.table("works_sanctioned"), "MP")
    return out.select("work_id", "sanction_date", F.col("sanction_amount").cast("double").alias("sanction_amount"), "work_stage")


@_query
def ingest_recommendations(p: WorksPlan) -> DataFrame:
    """Recommendations as they are put in."""
    out = ingest.recommendations(p.table("works_recommended"), "MP")
    return out.select("work_id", "recommendation_date", F.col("recommended_amount").cast("double").alias("recommended_amount"), "letter_no")


@_query
def ingest_allocations(p: WorksPlan) -> DataFrame:
    """Limits as they are put in, of names that one member bears."""
    limits = p.table("allocated_limit")
    kind = F.when(F.lower(F.trim("house_name")) == members.ASSEMBLY, "MLA").otherwise("MP")
    out = ingest.allocations(members.resolve_names(limits, p.master, "mp_name", kind))
    return out.select(*MEMBER, F.col("allocated_amount").cast("double").alias("allocated_amount"))


@_query
def audit_population(p: WorksPlan) -> DataFrame:
    """Members by type: ids, repeated and blank names."""
    return audit.population(p.master, "member_type", measures.member_name(F.col("member_name")), "member_id")


@_query
def audit_synthetic_ids(p: WorksPlan) -> DataFrame:
    """Ids that no source gives."""
    return audit.synthetic_ids({"mps": (p.table("mps"), "mp_id"), "mlas": (p.table("mlas"), "mla_id"), "member_metrics": (p.members, "member_id")})


@_query
def audit_members(p: WorksPlan) -> DataFrame:
    """Member records by type: rows, keys, works and how many are qualified."""
    return p.all_members.groupBy("member_type").agg(F.count("*").alias("n_rows"), F.countDistinct("member_id").alias("n_ids"), F.sum("total_works").alias("n_works"), F.count_if("ranking_qualified").alias("n_qualified"))


@_query
def audit_states(p: WorksPlan) -> DataFrame:
    """States of the metrics without a name, and named states without works."""
    a, b = p.states.select("state_id"), p.table("states").select("state_id")
    return audit.orphans(a, b, STATE, "states without a name").unionByName(audit.orphans(b, a, STATE, "states without works")).unionByName(audit.orphans(p.members.select("state_id"), a, STATE, "states of members without metrics"))


@_query
def audit_evidence(p: WorksPlan) -> DataFrame:
    """Work references by role: rows, entities and works, and references to works that aren't there."""
    refs = evidence.work_references(p.flagged, MEMBER)
    lost = refs.join(p.measured.select("work_id"), "work_id", "left_anti").groupBy("evidence_role").agg(F.count("*").alias("n_lost"))
    counted = refs.groupBy("evidence_role").agg(F.count("*").alias("n_rows"), F.countDistinct(F.struct(*MEMBER)).alias("n_members"), F.countDistinct("work_id").alias("n_works"))
    return counted.join(lost, "evidence_role", "left").withColumn("n_lost", F.coalesce("n_lost", F.lit(0)))


@_query
def audit_anomalies(p: WorksPlan) -> DataFrame:
    """Members by anomaly level; invalid levels, scores out of range and missing ones."""
    return audit.level_checks(p.member_anomalies, "anomaly_level", "anomaly_score", ["HIGH", "MEDIUM", "NORMAL"], 0, 5)


@_query
def audit_scores(p: WorksPlan) -> DataFrame:
    """Scores of members by type and class."""
    return audit.score_summary(p.member_ranks)


@_query
def audit_ranks(p: WorksPlan) -> DataFrame:
    """Ranks beyond the population, and ranks against the scores."""
    return audit.rank_consistency(p.member_ranks)


@_query
def audit_risk(p: WorksPlan) -> DataFrame:
    """Members by risk level, from given isolation scores."""
    from worktally.plans import works_queries

    return audit.level_checks(works_queries.build("entity_risk_given", p), "risk_level", "risk_score", ["CRITICAL", "HIGH", "MODERATE", "LOW"], 0, 100)


@_query
def audit_freshness(p: WorksPlan) -> DataFrame:
    """First and last load or calculation of each table."""
    t = p.table
    return audit.freshness({"work_analysis": (t("work_analysis"), "last_calculated"), "expenditure": (t("expenditure"), "loaded_at"), "mps": (t("mps"), "loaded_at"), "mlas": (t("mlas"), "loaded_at"), "works_recommended": (t("works_recommended"), "loaded_at")})


@_query
def audit_invalid(p: WorksPlan) -> DataFrame:
    """Records with missing keys and names, negative counts and shares outside 0 to 100."""
    percent = lambda c: f"{c} < 0 OR {c} > 100"
    checks = [
        ("works", p.table("work_analysis"), {"null work_id": "work_id IS NULL", "null member_id": "member_id IS NULL", "null member_type": "member_type IS NULL"}),
        ("members", member_record(p), {
            "null member_id": "member_id IS NULL", "null member_type": "member_type IS NULL", "negative total_works": "total_works < 0", "negative completed_works": "completed_works < 0",
            "completion_rate_pct out of range": percent("completion_rate_pct"), "fund_utilization_pct out of range": percent("fund_utilization_pct"), "no member_name": "member_name IS NULL OR member_name = ''",
        }),
        ("states", p.states.join(p.table("states"), "state_id", "left"), {
            "null state_id": "state_id IS NULL", "negative total_works": "total_works < 0", "completion_rate_pct out of range": percent("completion_rate_pct"), "no state_name": "state_name IS NULL OR state_name = ''",
        }),
    ]
    out = None
    for name, df, rules in checks:
        one = audit.range_checks(df, rules).select(F.lit(name).alias("table_name"), "check_name", "n_rows")
        out = one if out is None else out.unionByName(one)
    return out


@_query
def request_batches(p: WorksPlan) -> DataFrame:
    """Members by requests of five: how many requests each type needs."""
    sized = p.members.dropna(subset=MEMBER).select(*MEMBER, F.lit(1000).alias("n_characters"))
    batched = evidence.request_batches(sized, ["member_id"], "n_characters", by=["member_type"])
    return batched.groupBy("member_type").agg(F.countDistinct("request_no").alias("n_requests"), F.count("*").alias("n_records"))
