"""Output records: one wide row for each member, state and work, from the stages of the analysis."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from worktally.functions.measures import grade, member_name, round_to
from worktally.operators.works import latest_rows

#: Bands of the summed score (0 to 200).
SUM_BANDS = [(160, "PERFORMER"), (120, "AVERAGE"), (80, "NEEDS_ATTENTION")]
#: The features whose values make a work's fingerprint.
FINGERPRINT = ("sanction_amount", "recommended_amount", "expenditure_amount", "sanction_delay_days", "execution_days", "project_age_days", "cost_percentile", "duration_percentile")


def summed_score(completion: Column, utilisation: Column) -> Column:
    """Completion and utilisation added, 0 to 200; a missing one counts as 0."""
    return round_to(F.coalesce(completion, F.lit(0.0)) + F.coalesce(utilisation, F.lit(0.0)))


def summed_band(score: Column) -> Column:
    """The class of a summed score."""
    return grade(score, SUM_BANDS, "UNDERPERFORMER")


def feature_fingerprint() -> Column:
    """SHA-256 of ``name=value`` of the FINGERPRINT columns, joined by a pipe; a null value is an empty text."""
    return F.sha2(F.concat_ws("|", *[F.concat(F.lit(f"{c}="), F.coalesce(F.col(c).cast("string"), F.lit(""))) for c in FINGERPRINT]), 256)


def member_records(members: DataFrame, master: DataFrame, context: DataFrame, states: DataFrame, anomalies: DataFrame, ranks: DataFrame) -> DataFrame:
    """One record for each member, those without works too.

    ``context`` is ``members.first_by_name``; it gives the tenure and the allocation by name, and the
    state's name where the member's works give none. Costs without works that were priced fall back
    to the sanctioned amount by sanctioned work. Members that no anomaly score has are NORMAL with LOW confidence.
    """
    keys = ["member_type", "member_id"]
    named = members.join(master.select(*keys, "member_name", "constituency_id"), keys, "left").withColumn("_n", member_name(F.col("member_name")))
    held = context.select(F.col("normalized_name").alias("_n"), *[F.col(c).alias(f"_{c}") for c in ("member_name", "state_name", "house_name", "tenure", "tenure_start_date", "tenure_end_date", "allocated_amount")])
    joined = named.join(held, "_n", "left").join(states.select("state_id", F.col("state_name").alias("_own_state")), "state_id", "left")
    joined = joined.join(anomalies.select(*keys, "anomaly_score", "anomaly_level", "confidence_level"), keys, "left").join(ranks.select(*keys, "rank", "scale_score", "performance_score_weighted", "performance_classification"), keys, "left")
    c = F.col
    fallback = F.when((c("sanctioned_amount") > 0) & (c("sanctioned_works") > 0), round_to(c("sanctioned_amount") / c("sanctioned_works")))
    counts = "total_works recommended_works sanctioned_works completed_works ongoing_works pending_works completion_rate_pct sanction_rate_pct sanction_conversion_pct".split()
    days = "avg_sanction_delay_days median_sanction_delay_days avg_execution_days median_execution_days avg_project_age_days max_project_age_days overdue_over_1_year overdue_over_2_years".split()
    risk = "flagged_works high_risk_works medium_risk_works flagged_rate_pct high_risk_rate_pct cost_anomaly_works duration_anomaly_works".split()
    zero = lambda x: F.coalesce(c(x), F.lit(0.0)).cast("double")
    return joined.select(
        *keys,
        F.coalesce("member_name", "_member_name").alias("member_name"),
        "state_id",
        F.coalesce("_own_state", "_state_name").alias("state_name"),
        "constituency_id",
        c("_house_name").alias("house_name"),
        c("_tenure").alias("tenure"),
        c("_tenure_start_date").alias("tenure_start_date"),
        c("_tenure_end_date").alias("tenure_end_date"),
        *counts,
        zero("_allocated_amount").alias("allocated_amount"),
        *[zero(x).alias(x) for x in ("recommended_amount", "sanctioned_amount", "expenditure_amount", "completion_amount", "unspent_amount")],
        zero("expenditure_sanction_utilization_pct").alias("fund_utilization_pct"),
        zero("expenditure_recommendation_pct").alias("expenditure_rate_pct"),
        F.coalesce("avg_work_cost", fallback).alias("avg_work_cost"),
        "median_work_cost",
        *days,
        *risk,
        "anomaly_score",
        F.coalesce("anomaly_level", F.lit("NORMAL")).alias("anomaly_level"),
        F.coalesce("confidence_level", F.lit("LOW")).alias("confidence_level"),
        (c("total_works") == 0).alias("zero_work_member"),
        (c("total_works") < 5).alias("low_sample_member"),
        "ranking_qualified",
        "performance_classification",
        summed_score(c("completion_rate_pct"), c("expenditure_sanction_utilization_pct")).alias("performance_score"),
        "rank",
        "scale_score",
        "performance_score_weighted",
    )


def state_records(states: DataFrame, names: DataFrame, members: DataFrame, anomalies: DataFrame, ranks: DataFrame) -> DataFrame:
    """One record for each state with works; ``members`` are the member records, which give the counts and the allocations."""
    c = F.col
    held = members.groupBy("state_id").agg(F.count("*").alias("total_members"), F.count_if(c("member_type") == "MP").alias("mp_count"), F.count_if(c("member_type") == "MLA").alias("mla_count"), F.sum(c("allocated_amount").cast("decimal(18,2)")).cast("double").alias("allocated_amount"))
    joined = states.join(names.select("state_id", "state_name"), "state_id", "left").join(held, "state_id", "left")
    joined = joined.join(anomalies.select("state_id", "anomaly_score", "anomaly_level", "confidence_level"), "state_id", "left").join(ranks.select("state_id", "rank", "scale_score", "performance_score_weighted"), "state_id", "left")
    score = summed_score(c("completion_rate_pct"), c("expenditure_sanction_utilization_pct"))
    none = lambda x: F.coalesce(c(x), F.lit(0))
    return joined.select(
        "state_id",
        "state_name",
        *[none(x).alias(x) for x in ("total_members", "mp_count", "mla_count")],
        *"active_members total_works recommended_works sanctioned_works completed_works ongoing_works pending_works completion_rate_pct sanction_rate_pct".split(),
        none("allocated_amount").cast("double").alias("allocated_amount"),
        *"recommended_amount sanctioned_amount expenditure_amount completion_amount unspent_amount".split(),
        c("expenditure_sanction_utilization_pct").alias("fund_utilization_pct"),
        c("expenditure_recommendation_pct").alias("expenditure_rate_pct"),
        *"avg_work_cost median_work_cost avg_sanction_delay_days median_sanction_delay_days avg_execution_days median_execution_days".split(),
        F.lit(None).cast("double").alias("avg_project_age_days"),
        *"overdue_over_1_year overdue_over_2_years flagged_works high_risk_works".split(),
        c("flagged_rate_pct").alias("risk_rate_pct"),
        "cost_anomaly_works",
        "duration_anomaly_works",
        "anomaly_score",
        F.coalesce("anomaly_level", F.lit("NORMAL")).alias("anomaly_level"),
        F.coalesce("confidence_level", F.lit("LOW")).alias("confidence_level"),
        F.when(c("ranking_qualified"), summed_band(score)).otherwise("INSUFFICIENT_DATA").alias("performance_classification"),
        score.alias("performance_score"),
        "rank",
        "scale_score",
        "performance_score_weighted",
    )


def work_records(flagged: DataFrame, work_analysis: DataFrame) -> DataFrame:
    """One record for each work: the source's texts, the measures, the peers' percentiles, flags as JSON and the fingerprint of its features."""
    kept = ["constituency_id", "state_name", "activity_name", "work_description"]
    texts = latest_rows(work_analysis, ["work_id"], ["last_calculated"]).select("work_id", *kept)
    group = F.when(F.col("benchmark_quality").startswith("ACTIVITY_STATE"), "ACTIVITY_STATE").when(F.col("benchmark_quality").startswith("ACTIVITY_NATIONAL"), "ACTIVITY_NATIONAL").otherwise("NONE")
    percentiles = [f"{what}_p{p}" for what in ("cost", "duration") for p in (25, 50, 75, 90, 95)]
    return flagged.join(texts, "work_id", "left").select(
        *"work_id member_id member_type constituency_id state_id state_name work_category activity_name normalized_activity work_description status".split(),
        *[F.col(x).cast("double").alias(x) for x in ("recommended_amount", "sanction_amount", "expenditure_amount", "completion_amount")],
        *"recommendation_date sanction_date first_expenditure_date last_expenditure_date completion_date".split(),
        *"sanction_delay_days project_age_days execution_days pending_days expenditure_percentage completion_percentage".split(),
        group.alias("benchmark_peer_group"),
        "benchmark_quality",
        "benchmark_sample_size",
        *percentiles,
        *"cost_percentile duration_percentile cost_status duration_status".split(),
        F.col("cost_deviation").alias("cost_deviation_from_median_percentage"),
        F.col("duration_deviation").alias("duration_deviation_from_median_percentage"),
        F.to_json("risk_flags").alias("risk_flags"),
        "flag_count",
        "risk_level",
        feature_fingerprint().alias("feature_fingerprint"),
    )
