"""Robust z scores of entity features and their composite.

Features are unpivoted once; medians and deviations of all features and populations come from two
grouped aggregates and two joins on the small table of (population, feature).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from worktally.functions.measures import grade, round_to
from worktally.operators.ranking import percent_rank_level

#: Fixed values: (feature, direction, column, column to divide by in percent or null, what an outlier says). Names and texts are output.
MEMBER_FEATURES = [
    ("flagged_rate_pct", "HIGH", "flagged_rate_pct", None, "Flagged-work rate is substantially above the comparable entity median."),
    ("high_risk_rate_pct", "HIGH", "high_risk_rate_pct", None, "High-risk work rate is substantially above the comparable entity median."),
    ("completion_rate_pct", "LOW", "completion_rate_pct", None, "Completion rate is substantially below the comparable entity median."),
    ("expenditure_utilization_pct", "LOW", "expenditure_sanction_utilization_pct", None, "Expenditure utilization is substantially below the comparable entity median."),
    ("avg_sanction_delay_days", "HIGH", "avg_sanction_delay_days", None, "Average sanction delay is substantially above the comparable entity median."),
    ("overdue_rate", "HIGH", "overdue_over_1_year", "total_works", "Rate of works overdue over 1 year is substantially above the comparable entity median."),
    ("cost_anomaly_rate", "HIGH", "cost_anomaly_works", "total_works", "Rate of cost-anomalous works is substantially above the comparable entity median."),
    ("duration_anomaly_rate", "HIGH", "duration_anomaly_works", "total_works", "Rate of duration-anomalous works is substantially above the comparable entity median."),
    ("avg_cost_percentile", "HIGH", "avg_cost_percentile", None, "Average cost percentile is substantially above the comparable entity median."),
    ("expenditure_over_sanction_rate", "HIGH", "expenditure_over_sanction_works", "total_works", "Rate of works exceeding sanctioned amount is substantially above the comparable entity median."),
    ("negative_delay_rate", "HIGH", "negative_sanction_delay_works", "total_works", "Rate of works with negative sanction delay is substantially above the comparable entity median."),
    ("avg_project_age_days", "BOTH", "avg_project_age_days", None, "Average project age deviates substantially from the comparable entity median."),
]
#: Fixed values, as above.
STATE_FEATURES = [
    ("risk_rate", "HIGH", "flagged_rate_pct", None, "Risk rate is substantially above the comparable state median."),
    ("completion_rate", "LOW", "completion_rate_pct", None, "Completion rate is substantially below the comparable state median."),
    ("expenditure_utilization", "LOW", "expenditure_sanction_utilization_pct", None, "Expenditure utilization is substantially below the comparable state median."),
    ("avg_sanction_delay", "HIGH", "avg_sanction_delay_days", None, "Average sanction delay is substantially above the comparable state median."),
    ("cost_anomaly_rate", "HIGH", "cost_anomaly_works", "total_works", "Rate of cost-anomalous works is substantially above the comparable state median."),
    ("duration_anomaly_rate", "HIGH", "duration_anomaly_works", "total_works", "Rate of duration-anomalous works is substantially above the comparable state median."),
    ("overdue_rate", "HIGH", "overdue_over_1_year", "total_works", "Rate of works overdue over 1 year is substantially above the comparable state median."),
]
#: Works from which the confidence in a member's or a state's score is high or medium.
MEMBER_CONFIDENCE, STATE_CONFIDENCE = [(50, "HIGH"), (20, "MEDIUM")], [(100, "HIGH"), (50, "MEDIUM")]
CONSISTENCY, CLIP, EXPLAIN_FROM, EXPLANATIONS, MINIMUM = 0.6745, 5.0, 2.0, 5, 5


def robust_z(values: DataFrame, by: list[str]) -> DataFrame:
    """``values`` with z: 0.6745 (x - median) / MAD within ``by``, at most 5 in size; 0 where MAD is 0.

    Groups of fewer than five values are left out.
    """
    half = F.lit(0.5)
    centre = values.groupBy(*by).agg(F.percentile("v", half).alias("median"), F.count("v").alias("n")).filter(F.col("n") >= MINIMUM)
    off = values.join(centre, by)
    spread = off.groupBy(*by).agg(F.percentile(F.abs(F.col("v") - F.col("median")), half).alias("mad"))
    z = F.lit(CONSISTENCY) * (F.col("v") - F.col("median")) / F.col("mad")
    clipped = F.when(F.col("mad") == 0, 0.0).otherwise(F.greatest(F.least(z, F.lit(CLIP)), F.lit(-CLIP)))
    return off.join(spread, by).withColumn("z", clipped).drop("median", "mad", "n")


def feature_values(entities: DataFrame, features: list[tuple], keep: list[str]) -> DataFrame:
    """(keep, feature, direction, v) of every feature that has a value."""
    cells = []
    for name, direction, column, base, _ in features:
        v = F.col(column).cast("double")
        if base:
            v = F.when(F.col(base) != 0, v / F.col(base).cast("double") * 100)
        cells.append(F.struct(F.lit(name).alias("feature"), F.lit(direction).alias("direction"), v.alias("v")))
    return entities.select(*keep, F.explode(F.array(*cells)).alias("x")).select(*keep, "x.*").filter("v IS NOT NULL")


def entity_anomalies(entities: DataFrame, features: list[tuple], keys: list[str], population: list[str], confidence: list[tuple] = MEMBER_CONFIDENCE) -> DataFrame:
    """(keys, anomaly_score, anomaly_level, confidence_level, contributing_features) of the qualified entities.

    z scores are taken within ``population``; the levels' thresholds, the 95th and 80th percentile
    of the composites, over all. A qualified entity without features scores 0.
    """
    qualified = entities.filter("ranking_qualified")
    long = feature_values(qualified, features, keys)
    scored = robust_z(long, [*population, "feature"]) if population else robust_z(long, ["feature"])
    part = F.when(F.col("direction") == "HIGH", F.greatest(F.lit(0.0), F.col("z"))).when(F.col("direction") == "LOW", F.greatest(F.lit(0.0), -F.col("z"))).otherwise(F.abs("z"))
    strong = F.when(F.abs("z") >= EXPLAIN_FROM, F.struct((-F.abs("z")).alias("o"), "feature", round_to(F.col("v")).alias("feature_value"), round_to(F.col("z")).alias("z_score")))
    said = F.create_map(*[F.lit(x) for name, *_, text in features for x in (name, text)])
    # At most one entry for each feature.
    combined = scored.groupBy(*keys).agg(F.avg(part).alias("c"), F.slice(F.sort_array(F.collect_list(strong)), 1, EXPLANATIONS).alias("top"))
    full = qualified.select(*keys, grade(F.col("total_works"), confidence, "LOW").alias("confidence_level")).join(combined, keys, "left").withColumn("c", F.coalesce("c", F.lit(0.0)))
    limits = full.agg(F.percentile("c", F.lit(0.95)).alias("high"), F.percentile("c", F.lit(0.80)).alias("medium"))
    level = F.when(F.col("c") > F.col("high"), "HIGH").when(F.col("c") > F.col("medium"), "MEDIUM").otherwise("NORMAL")
    explained = F.transform(F.coalesce("top", F.array()), lambda t: F.struct(t["feature"].alias("feature"), t["feature_value"].alias("feature_value"), t["z_score"].alias("z_score"), F.when(t["z_score"] > 0, "HIGH").otherwise("LOW").alias("direction"), said[t["feature"]].alias("description")))
    one_row = F.broadcast(limits)
    return full.join(one_row, how="left").select(*keys, round_to(F.col("c"), 4).alias("anomaly_score"), level.alias("anomaly_level"), "confidence_level", explained.alias("contributing_features"))


#: Bands of the score in the evidence of a risk, and of the works behind it (plus one) in its confidence.
RISK_BANDS, RISK_CONFIDENCE = [(70, "CRITICAL"), (50, "HIGH"), (35, "MODERATE")], [(5, "HIGH"), (2, "MEDIUM")]


def entity_risk(entities: DataFrame, isolation: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, risk_score, risk_level, confidence, evidence_level, evidence_summary, sample_size): the mean of the isolation figure and the scaled anomaly score.

    ``isolation`` has keys, isolation_95 and n; without it the part is 0. An unknown anomaly score counts as 0.5.
    """
    stat = F.when(F.col("anomaly_score").isNull(), 0.5).otherwise(F.greatest(F.lit(0.0), F.least(F.lit(1.0), (F.col("anomaly_score") + 3) / 6)))
    joined = entities.select(*keys, "anomaly_score").join(isolation.select(*keys, "isolation_95", "n"), keys, "left")
    raw = joined.withColumn("raw", (F.coalesce("isolation_95", F.lit(0.0)) + stat) / 2 * 100)
    levelled = percent_rank_level(raw, "raw")
    n = F.coalesce("n", F.lit(0)).cast("bigint")
    summary = F.coalesce(F.format_string("isolation anomaly 95th percentile %.2f", round_to(F.col("isolation_95"))), F.lit("statistical anomaly only"))
    return levelled.select(
        *keys,
        round_to(F.col("raw")).alias("risk_score"),
        "risk_level",
        grade(n + 1, RISK_CONFIDENCE, "LOW").alias("confidence"),
        grade(F.col("raw"), RISK_BANDS, "LOW").alias("evidence_level"),
        F.when(F.col("isolation_95").isNull(), "statistical anomaly only").otherwise(summary).alias("evidence_summary"),
        n.alias("sample_size"),
    )
