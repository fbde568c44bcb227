"""Queries of the works analytics: one for each operator."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from worktally.functions import measures
from worktally.operators import anomaly, audit, benchmarks, delta, evidence, isolation, members, metrics, profiling, ranking, validation, works
from worktally.operators.snapshot_changes import PUBLIC_WORKS, content_hash
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
def normalize_member_name(p: WorksPlan) -> DataFrame:
    """Names of the limits without titles and terms."""
    name = F.col("mp_name")
    return p.table("allocated_limit").select("sno", "mp_name", measures.member_name(name).alias("member_name"), measures.allocation_name(name).alias("allocation_name")).distinct()


@_query
def parse_date(p: WorksPlan) -> DataFrame:
    """Payment dates and amounts as typed, and what they mean."""
    return p.table("expenditure").groupBy("sno").agg(F.max(measures.parse_date(F.col("expenditure_date"))).alias("day"), F.max(measures.parse_amount(F.col("fund_disbursed_amt"))).cast("double").alias("amount"))


@_query
def normalize_activity(p: WorksPlan) -> DataFrame:
    """How many rows have each normalised activity and category."""
    a = measures.activity_name(F.col("activity_name"))
    keyed = p.table("works_recommended").select(a.alias("normalized_activity"), measures.category_key(a, F.col("work_category")).alias("category"))
    return keyed.groupBy("normalized_activity", "category").agg(F.count("*").alias("n_rows"))


@_query
def work_build(p: WorksPlan) -> DataFrame:
    """Recommendations with their sanction and payments."""
    built = works.build_works(p.table("works_recommended"), p.table("works_sanctioned"), p.payments)
    return built.select("work_id", "normalized_activity", "recommendation_date", "sanction_date", *[F.col(c).cast("double").alias(c) for c in ("recommended_amount", "sanction_amount", "expenditure_amount")], "last_expenditure_date", "n_payments")


@_query
def work_lifecycle(p: WorksPlan) -> DataFrame:
    """Status, durations and shares of every work."""
    return p.measured_once.select("work_id", "status", "sanction_delay_days", "project_age_days", "execution_days", "pending_days", "days_since_payment", "expenditure_percentage", "completion_percentage")


@_query
def benchmark_groups(p: WorksPlan) -> DataFrame:
    """Peer groups and their percentiles."""
    return p.groups_once


@_query
def benchmark_select(p: WorksPlan) -> DataFrame:
    """Each work's peer group, bands and deviations."""
    return p.benchmarked.select("work_id", "benchmark_quality", "benchmark_sample_size", "cost_percentile", "duration_percentile", "cost_status", "duration_status", "cost_deviation", "duration_deviation")


@_query
def delay_distribution(p: WorksPlan) -> DataFrame:
    """Global percentiles of delays and execution times."""
    return benchmarks.delay_distribution(p.measured_once, p.accuracy)


@_query
def risk_flags(p: WorksPlan) -> DataFrame:
    """Flags, level and signals of every work."""
    return p.flagged_once.select("work_id", F.array_join("risk_flags", ",").alias("risk_flags"), "flag_count", "risk_level", F.array_join("positive_signals", ",").alias("positive_signals"))


@_query
def member_metrics(p: WorksPlan) -> DataFrame:
    """Aggregates by member."""
    return p.members_once


@_query
def state_metrics(p: WorksPlan) -> DataFrame:
    """Aggregates by state."""
    return p.states_once


@_query
def national_statistics(p: WorksPlan) -> DataFrame:
    """Statistics of the members' metrics."""
    return metrics.national_statistics(p.members)


@_query
def trends(p: WorksPlan) -> DataFrame:
    """Aggregates by year and member type."""
    return metrics.trends(p.flagged_once)


@_query
def trends_dedup(p: WorksPlan) -> DataFrame:
    """Two deliveries of the trends, reduced to the last of each year and type."""
    rows = metrics.trends(p.flagged_once).select("year", "member_type", "total_works")
    twice = rows.withColumn("seq", F.lit(1)).unionByName(rows.withColumns({"seq": F.lit(2), "total_works": F.col("total_works") + 1}))
    return works.latest_rows(twice, ["year", "member_type"], ["seq"]).select("year", "member_type", "total_works")


@_query
def overall_metrics(p: WorksPlan) -> DataFrame:
    """Aggregates over all members, by scope."""
    return metrics.overall_metrics(p.all_members)


@_query
def category_metrics(p: WorksPlan) -> DataFrame:
    """Aggregates by category, national and by state."""
    return metrics.category_metrics(p.flagged_once, p.accuracy)


@_query
def fy_metrics(p: WorksPlan) -> DataFrame:
    """Events by fiscal year and member type."""
    return metrics.fiscal_metrics(p.measured, p.payment_rows)


@_query
def zero_work_members(p: WorksPlan) -> DataFrame:
    """Members of the master without works."""
    return members.zero_work_members(p.master, p.measured_once, p.population)


@_query
def allocation_match(p: WorksPlan) -> DataFrame:
    """Limits matched to members by name and tenure."""
    return members.match_allocations(p.master, p.table("allocated_limit"))


@_query
def competition_rank(p: WorksPlan) -> DataFrame:
    """Scale score, weighted score, rank, class and percentile of every member."""
    return p.member_ranks


@_query
def state_rank(p: WorksPlan) -> DataFrame:
    """The same for states."""
    return p.state_ranks


def _peers(ranks: DataFrame, clusters: DataFrame) -> DataFrame:
    """Rank and percentile of the weighted score among members of one type and cluster; cluster -1 and null, and null scores, have none."""
    placed = ranks.join(clusters.select("member_type", "member_id", "cluster_id"), ["member_type", "member_id"]).filter("cluster_id >= 0")
    return ranking.rank_within(placed, "performance_score_weighted", ["member_type", "cluster_id"]).select("member_type", "member_id", "cluster_id", "peer_rank", "peer_percentile")


def _given_clusters(p: WorksPlan) -> DataFrame:
    """Members' features with clusters that the ids give, so that SQL can follow: -1 to 2, and null for every seventh."""
    cluster = F.when(F.col("member_id") % 7 != 0, (F.col("member_id") % 4 - 1).cast("int"))
    return profiling.member_features(p.members).withColumn("cluster_id", cluster)


@_query
def peer_rank(p: WorksPlan) -> DataFrame:
    """Rank and percentile of the weighted score among members of one type and given cluster."""
    return _peers(p.member_ranks, _given_clusters(p))


@_query
def peer_rank_profiles(p: WorksPlan) -> DataFrame:
    """The same in the clusters of the members' profiles."""
    return _peers(p.member_ranks, build("kmeans_profile", p))


@_query
def member_features(p: WorksPlan) -> DataFrame:
    """The features of the members' profiles."""
    rows = profiling.member_features(p.members)
    return rows.select("member_type", "member_id", *[measures.round_to(F.col(c), 4).alias(c) for c in profiling.MEMBER_PROFILE])


@_query
def state_features(p: WorksPlan) -> DataFrame:
    """The features of the states' profiles."""
    rows = profiling.state_features(p.states)
    return rows.select("state_id", *[measures.round_to(F.col(c), 4).alias(c) for c in profiling.STATE_PROFILE])


@_query
def cluster_labels(p: WorksPlan) -> DataFrame:
    """The labels of given clusters of members."""
    return profiling.cluster_labels(_given_clusters(p).filter("cluster_id IS NOT NULL"), ["member_type", "member_id"])


@_query
def risk_percentile_level(p: WorksPlan) -> DataFrame:
    """Level of each member by the share of members with a lower flagged rate."""
    out = ranking.percent_rank_level(p.members.select("member_type", "member_id", "flagged_rate_pct"), "flagged_rate_pct")
    return out.select("member_type", "member_id", measures.round_to(F.col("risk_percentile"), 4).alias("risk_percentile"), "risk_level")


@_query
def robust_z(p: WorksPlan) -> DataFrame:
    """Robust z of every member feature within its type."""
    long = anomaly.feature_values(p.members.filter("ranking_qualified"), anomaly.MEMBER_FEATURES, ["member_type", "member_id"])
    return anomaly.robust_z(long, ["member_type", "feature"]).select("member_type", "member_id", "feature", measures.round_to(F.col("z"), 4).alias("z"))


@_query
def member_anomaly(p: WorksPlan) -> DataFrame:
    """Composite anomaly score, level and confidence of members."""
    return p.member_anomalies.select("member_type", "member_id", "anomaly_score", "anomaly_level", "confidence_level")


@_query
def state_anomaly(p: WorksPlan) -> DataFrame:
    """Composite anomaly score, level and confidence of states."""
    return p.state_anomalies.select("state_id", "anomaly_score", "anomaly_level", "confidence_level")


@_query
def anomaly_explanations(p: WorksPlan) -> DataFrame:
    """The features that make a member unusual, at most five each."""
    return p.member_anomalies.select("member_type", "member_id", F.explode("contributing_features").alias("f")).select("member_type", "member_id", "f.*")


@_query
def isolation_forest(p: WorksPlan) -> DataFrame:
    """Isolation score and level of every work."""
    return isolation.isolation_scores(p.benchmarked)


def _risk(p: WorksPlan, scores: DataFrame, keys: list[str]) -> DataFrame:
    entities, found = (p.members, p.member_anomalies) if "member_id" in keys else (p.states, p.state_anomalies)
    works_of = p.measured if "member_id" in keys else p.measured.filter("state_id IS NOT NULL")
    return anomaly.entity_risk(entities.select(*keys).join(found, keys, "left"), isolation.isolation_by(works_of, scores, keys, accuracy=p.accuracy), keys)


def _given_scores(p: WorksPlan) -> DataFrame:
    """Isolation scores that the ids give, so that SQL can follow."""
    return p.measured.select("work_id", (F.col("work_id") * 7919 % 1000 / 1000.0).alias("isolation_score"))


@_query
def entity_risk(p: WorksPlan) -> DataFrame:
    """Risk of members from isolation and anomaly scores."""
    return _risk(p, isolation.isolation_scores(p.benchmarked), MEMBER)


@_query
def state_risk(p: WorksPlan) -> DataFrame:
    """Risk of states from isolation and anomaly scores."""
    return _risk(p, isolation.isolation_scores(p.benchmarked), STATE)


@_query
def entity_risk_given(p: WorksPlan) -> DataFrame:
    """Risk of members from given isolation scores and their anomaly scores."""
    return _risk(p, _given_scores(p), MEMBER)


@_query
def state_risk_given(p: WorksPlan) -> DataFrame:
    """Risk of states from given isolation scores and their anomaly scores."""
    return _risk(p, _given_scores(p), STATE)


@_query
def isolation_agg_given(p: WorksPlan) -> DataFrame:
    """The 95th percentile of given isolation scores of each state's works."""
    # The given scores take 1999 values at most, so exact percentiles cost little at any size.
    return isolation.isolation_by(p.measured.filter("state_id IS NOT NULL"), _given_scores(p), ["state_id"], digits=4)


@_query
def kmeans_profile(p: WorksPlan) -> DataFrame:
    """K-Means cluster and label of members."""
    return profiling.kmeans_profiles(profiling.member_features(p.members), MEMBER, profiling.MEMBER_PROFILE)


@_query
def state_profile(p: WorksPlan) -> DataFrame:
    """K-Means cluster and label of states."""
    return profiling.kmeans_profiles(profiling.state_features(p.states), STATE, profiling.STATE_PROFILE, profiling.STATE_CLUSTER)


@_query
def evidence_work_refs(p: WorksPlan) -> DataFrame:
    """The works that stand for each member."""
    return evidence.work_references(p.flagged_once, ["member_type", "member_id"])


@_query
def state_work_refs(p: WorksPlan) -> DataFrame:
    """The works that stand for each state."""
    return evidence.work_references(p.flagged_once.filter("state_id IS NOT NULL"), ["state_id"], evidence.STATE_ROLES)


def _flat(sections: DataFrame, keys: list[str]) -> DataFrame:
    """Every field of the sections as a column ``section_field``; of the features only how many there are."""
    out = []
    for f in sections.schema.fields:
        if f.name not in keys:
            for inner in f.dataType.fields:
                c = F.col(f.name)[inner.name]
                out.append((F.size(c).cast("int") if inner.name == "contributing_features" else c.cast("double") if inner.name == "allocated_amount" else c).alias(f"{f.name}_{inner.name}"))
    return sections.select(*keys, *out)


def _member_sections(p: WorksPlan) -> DataFrame:
    return evidence.member_sections(p.all_members, p.states, metrics.national_statistics(p.members), p.member_anomalies, p.idle)


@_query
def member_evidence(p: WorksPlan) -> DataFrame:
    """The ten sections of each member's evidence, field by field."""
    return _flat(_member_sections(p), MEMBER)


@_query
def state_evidence(p: WorksPlan) -> DataFrame:
    """The seven sections of each state's evidence, field by field."""
    return _flat(evidence.state_sections(p.states, p.state_anomalies), STATE)


@_query
def member_evidence_records(p: WorksPlan) -> DataFrame:
    """Hashed JSON records of the members' evidence."""
    return evidence.evidence_records(_member_sections(p), MEMBER)


@_query
def state_evidence_records(p: WorksPlan) -> DataFrame:
    """Hashed JSON records of the states' evidence."""
    return evidence.evidence_records(evidence.state_sections(p.states, p.state_anomalies), STATE)


@_query
def ai_candidates(p: WorksPlan) -> DataFrame:
    """Members whose works are new or changed since the calculations before 20 August 2026."""
    keys = ["member_type", "member_id"]

    def marks(rows: DataFrame) -> DataFrame:
        once = works.latest_rows(rows, ["work_id"], ["last_calculated"]).withColumn("member_type", F.upper(F.regexp_replace("member_type", " ", "")))
        grouped = once.groupBy(*keys).agg(F.count("*").alias("n"), F.sum("sanction_amount").alias("amount"))
        return grouped.dropna(subset=keys).select(*keys, measures.hash_of(F.col("n"), F.col("amount")).alias("evidence_hash"))

    rows = p.table("work_analysis")
    known = marks(rows.filter(F.col("last_calculated") < F.lit("2026-08-20").cast("timestamp")))
    return evidence.stale_records(marks(rows), known, keys, ["evidence_hash"]).select(*keys)


@_query
def backlog_merge(p: WorksPlan) -> DataFrame:
    """Qualified members, and the others with works as a backlog."""
    keys = ["member_type", "member_id"]
    return evidence.merge_backlog(p.members.filter("ranking_qualified"), p.members, keys)


def _four_fields() -> Column:
    """The content as the SQL of the queries below has it: four fields as typed. The queries named _full take all, by value."""
    return measures.hash_of(F.col("recommended_amount"), F.col("sanction_amount"), F.col("work_stage"), F.col("sanction_date"))


def _all_fields() -> Column:
    return content_hash(PUBLIC_WORKS.datasets["works_recommended"])


def _versions(p: WorksPlan, content: Callable[[], Column] = _four_fields) -> tuple[DataFrame, DataFrame]:
    """The first and the last delivery of each recommendation, with a hash of its content."""
    rows = p.table("works_recommended").select(works.whole_number(F.col("work_recommendation_dtl_id")).cast("bigint").alias("work_id"), "loaded_at", "removed_at", "letter_no", content().alias("content_hash"))
    ends = rows.groupBy("work_id").agg(F.min(F.struct("loaded_at", "content_hash", "letter_no")).alias("a"), F.max(F.struct("loaded_at", "content_hash", F.col("removed_at").isNull().alias("there"))).alias("b"))
    split = ends.filter("work_id IS NOT NULL")
    first_loaded, last_loaded = F.col("a.loaded_at"), F.col("b.loaded_at")
    cutoff = F.lit("2024-01-01").cast("timestamp")
    old = split.filter(first_loaded < cutoff).select("work_id", F.col("a.content_hash").alias("content_hash"), F.col("a.letter_no").alias("letter_no"))
    new = split.filter(F.col("b.there") & (last_loaded >= F.lit("2020-01-01").cast("timestamp"))).select("work_id", F.col("b.content_hash").alias("content_hash"))
    return old, new


@_query
def snapshot_diff(p: WorksPlan) -> DataFrame:
    """Appended, updated, unchanged and removed works between two versions."""
    return delta.table_diff(*_versions(p), ["work_id"], "content_hash")


@_query
def snapshot_diff_full(p: WorksPlan) -> DataFrame:
    """The same by all content fields."""
    return delta.table_diff(*_versions(p, _all_fields), ["work_id"], "content_hash")


@_query
def snapshot_dedupe(p: WorksPlan) -> DataFrame:
    """Keys delivered once, again with the same content, or with another."""
    rows = p.table("works_recommended").withColumn("work_id", works.whole_number(F.col("work_recommendation_dtl_id")).cast("bigint"))
    return delta.dedupe_by_hash(rows, ["work_id"], F.coalesce(F.col("recommended_amount"), F.lit("<NULL>")))


@_query
def snapshot_dedupe_full(p: WorksPlan) -> DataFrame:
    """The same by all content fields."""
    rows = p.table("works_recommended").withColumn("work_id", works.whole_number(F.col("work_recommendation_dtl_id")).cast("bigint"))
    return delta.dedupe_by_hash(rows, ["work_id"], _all_fields())


def _changed(p: WorksPlan, content: Callable[[], Column] = _four_fields) -> DataFrame:
    return delta.table_diff(*_versions(p, content), ["work_id"], "content_hash").filter("op IN ('append', 'update')").select("work_id")


@_query
def affected_entities(p: WorksPlan) -> DataFrame:
    """Works, members and states touched by the changed works."""
    return delta.affected_entities(p.measured, _changed(p))


@_query
def affected_entities_full(p: WorksPlan) -> DataFrame:
    """The same by all content fields."""
    return delta.affected_entities(p.measured, _changed(p, _all_fields))


@_query
def affected_works(p: WorksPlan) -> DataFrame:
    """Works that share an activity with a changed one."""
    return delta.affected_peers(p.measured, _changed(p))


@_query
def affected_works_full(p: WorksPlan) -> DataFrame:
    """The same by all content fields."""
    return delta.affected_peers(p.measured, _changed(p, _all_fields))


@_query
def time_sensitive(p: WorksPlan) -> DataFrame:
    """Works whose measures change with the day."""
    return delta.time_sensitive(p.measured_once)


@_query
def upsert(p: WorksPlan) -> DataFrame:
    """Members' first deliveries, with the later ones put in."""
    rows = p.table("mps").select("mp_id", "mp_name", "constituency_id", "loaded_at")
    first = rows.groupBy("mp_id").agg(F.min(F.struct("loaded_at", "mp_name", "constituency_id")).alias("r")).select("mp_id", "r.mp_name", "r.constituency_id", "r.loaded_at")
    return delta.upsert(first, rows, ["mp_id"], ["loaded_at"])


@_query
def ml_carryover(p: WorksPlan) -> DataFrame:
    """The earlier version's letter numbers, carried over where the content is the same."""
    old, new = _versions(p)
    return delta.carry_over(new, old, "work_id", "content_hash", ["letter_no"]).select("work_id", "letter_no", "carry_state")


@_query
def ml_carryover_full(p: WorksPlan) -> DataFrame:
    """The same by all content fields."""
    old, new = _versions(p, _all_fields)
    return delta.carry_over(new, old, "work_id", "content_hash", ["letter_no"]).select("work_id", "letter_no", "carry_state")


@_query
def audit_duplicates(p: WorksPlan) -> DataFrame:
    """Repeated keys of the source tables."""
    t = p.table
    return audit.duplicate_keys({"work_analysis": (t("work_analysis"), ["work_id"]), "expenditure": (t("expenditure"), ["sno"]), "mps": (t("mps"), ["mp_id"]), "mlas": (t("mlas"), ["mla_id"]), "allocated_limit": (t("allocated_limit"), ["sno"])})


@_query
def audit_orphans(p: WorksPlan) -> DataFrame:
    """Keys without a counterpart, both ways."""
    keys = ["member_type", "member_id"]
    a, b = p.measured.select(*keys), p.master.select(*keys)
    ids = lambda df, c: df.select(F.col(c).alias("constituency_id"))
    places = ids(p.table("constituencies"), "constituency_id")
    return audit.orphans(a, b, keys, "works without member").unionByName(audit.orphans(b, a, keys, "members without work")).unionByName(audit.orphans(ids(p.table("mps"), "constituency_id"), places, ["constituency_id"], "constituencies of mps"))


@_query
def audit_ranges(p: WorksPlan) -> DataFrame:
    """Values outside their range, counted in one pass."""
    checks = {
        "null member": "member_id IS NULL",
        "null state": "state_id IS NULL",
        "negative amount": "sanction_amount < 0 OR recommended_amount < 0 OR expenditure_amount < 0",
        "negative execution": "execution_days < 0",
        "share above 100": "expenditure_percentage > 100",
        "blank activity": "trim(activity_name) = ''",
        "completion before sanction": "completion_date < sanction_date",
    }
    return audit.range_checks(p.table("work_analysis"), checks)


@_query
def audit_overlap(p: WorksPlan) -> DataFrame:
    """Ids that occur as MP and as MLA."""
    return audit.overlap(p.table("mps").select(F.col("mp_id").alias("member_id")), p.table("mlas").select(F.col("mla_id").alias("member_id")), "member_id")


@_query
def expenditure_fingerprint(p: WorksPlan) -> DataFrame:
    """How often each payment was delivered, by the fingerprint of its nine fields."""
    fields = "work_recommendation_dtl_id work_id expenditure_date vendor_name vendor_id work_status state_name constituency mp_name".split()
    mark = measures.hash_of(*[F.col(f) for f in fields], measures.parse_amount(F.col("fund_disbursed_amt")))
    return p.table("expenditure").groupBy(mark.alias("fingerprint")).agg(F.count("*").alias("n_rows"))


@_query
def identity_key(p: WorksPlan) -> DataFrame:
    """Identity and content hash of every limit; the identity is null if a part of it is blank."""
    c = F.col
    identity = measures.identity_of(c("mp_name"), c("state_name"), c("constituency"), c("tenure"))
    content = measures.hash_of(measures.parse_amount(c("allocated_amt")), c("house_of_parliament"), measures.parse_date(c("tenure_start_date")), measures.parse_date(c("tenure_end_date")))
    return p.table("allocated_limit").select("sno", identity.alias("identity"), content.alias("content_hash")).distinct()


@_query
def wilson_score(p: WorksPlan) -> DataFrame:
    """Lower Wilson bound and shrunk rate of completions."""
    score = measures.wilson_lower(F.col("completed_works"), F.col("total_works"))
    drawn = measures.shrunk(F.col("completion_rate_pct"), F.col("total_works"))
    return p.members.select("member_type", "member_id", measures.round_to(score).alias("wilson_lower"), measures.round_to(drawn).alias("shrunk_rate"))


@_query
def prior_strength(p: WorksPlan) -> DataFrame:
    """Weight of the prior of the completion rate, by the method of moments."""
    return members.prior_strength(p.members, "completion_rate_pct")


@_query
def allocation_by_state(p: WorksPlan) -> DataFrame:
    """Limits by state, each member once a state."""
    return members.allocations_by_state(members.match_allocations(p.master, p.table("allocated_limit")), p.measured)


@_query
def dimension_resolve(p: WorksPlan) -> DataFrame:
    """The states with the names that occur in recommendations but not among them."""
    upper = lambda c: F.upper(F.trim(F.regexp_replace(c, r"\s+", " ")))
    known = p.table("states").select("state_id", upper("state_name").alias("state_name"))
    return delta.resolve_or_insert(known, p.table("works_recommended").select(upper("state_name").alias("state_name")).filter("state_name <> ''"), "state_id", "state_name")


@_query
def isolation_agg(p: WorksPlan) -> DataFrame:
    """The 95th percentile of the isolation scores of each state's works."""
    scores = isolation.isolation_scores(p.benchmarked)
    return isolation.isolation_by(p.measured.filter("state_id IS NOT NULL"), scores, ["state_id"], accuracy=p.accuracy)


@_query
def stage_verify(p: WorksPlan) -> DataFrame:
    """Checks of the members' evidence records against the members and their anomalies."""
    odd = p.member_anomalies.filter("anomaly_level <> 'NORMAL'")
    return audit.verify_stage(evidence.evidence_records(_member_sections(p), MEMBER), p.all_members, MEMBER, unique="evidence_hash", found=odd)


@_query
def work_profiles(p: WorksPlan) -> DataFrame:
    """Financial, timeline and payment profile of every work."""
    return works.with_profiles(p.benchmarked).select("work_id", "financial_profile", "timeline_profile", "payment_profile")


@_query
def national_context(p: WorksPlan) -> DataFrame:
    """National medians and 90th percentiles of three metrics."""
    return metrics.national_context(metrics.national_statistics(p.members))


@_query
def audit_histograms(p: WorksPlan) -> DataFrame:
    """Works by status, level and quality of benchmark."""
    return audit.histograms(p.flagged_once, ["status", "risk_level", "benchmark_quality", "cost_status", "duration_status"])


@_query
def json_validation(p: WorksPlan) -> DataFrame:
    """How many raw lines have which problems."""
    lines = p.table("records").select("dataset", "raw_json")
    checked = validation.validate_json(lines, "raw_json", ["MP_NAME"], forbidden=["Total_Amt"])
    return checked.groupBy("dataset", F.array_join("problems", ",").alias("problems")).agg(F.count("*").alias("n_rows"))
