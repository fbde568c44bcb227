"""Aggregates of works by member, state, year, category, fiscal year and nation."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from worktally.functions.measures import category_key, fiscal_label, fiscal_year, rate, round_to
from worktally.operators.works import REFERENCE_DATE

MEMBER_MINIMUM, STATE_MINIMUM, STATE_MEMBERS = 5, 10, 2


def _n(condition: str, name: str) -> Column:
    return F.count_if(F.expr(condition)).alias(name)


def _total(column: str, name: str) -> Column:
    return F.coalesce(F.sum(column), F.lit(0)).cast("double").alias(name)


def _mean(x: str, name: str) -> Column:
    # The sum is exact, so the mean doesn't depend on the order of the rows.
    v = F.expr(x).cast("decimal(28,4)")
    return round_to(F.sum(v).cast("double") / F.count(v)).alias(name)


def _median(x: str, name: str, accuracy: int | None = None) -> Column:
    v = F.expr(x).cast("double")
    return round_to(F.percentile_approx(v, F.lit(0.5), F.lit(accuracy)) if accuracy else F.percentile(v, F.lit(0.5))).alias(name)


def _shared(accuracy: int | None = None) -> list[Column]:
    return [
        F.count("*").alias("total_works"),
        _n("status = 'Recommended'", "recommended_works"),
        _n("sanction_date IS NOT NULL", "sanctioned_works"),
        _n("status = 'Completed'", "completed_works"),
        _n("status = 'In Progress'", "ongoing_works"),
        _total("recommended_amount", "recommended_amount"),
        _total("sanction_amount", "sanctioned_amount"),
        _total("expenditure_amount", "expenditure_amount"),
        _total("completion_amount", "completion_amount"),
        _mean("sanction_delay_days", "avg_sanction_delay_days"),
        _median("sanction_delay_days", "median_sanction_delay_days", accuracy),
        _mean("execution_days", "avg_execution_days"),
        _median("execution_days", "median_execution_days", accuracy),
        _n("flag_count >= 1", "flagged_works"),
        _n("risk_level = 'HIGH'", "high_risk_works"),
        _n("project_age_days > 365 AND status <> 'Completed'", "overdue_over_1_year"),
        _n("project_age_days > 730 AND status <> 'Completed'", "overdue_over_2_years"),
        _n("cost_status IN ('VERY_HIGH', 'HIGH')", "cost_anomaly_works"),
        _n("duration_status IN ('VERY_LONG', 'LONG')", "duration_anomaly_works"),
        _n("sanction_amount > 0 AND expenditure_amount > sanction_amount", "expenditure_over_sanction_works"),
        _n("recommended_amount > 0 AND expenditure_amount > recommended_amount", "expenditure_over_recommendation_works"),
        _n("sanction_delay_days < 0", "negative_sanction_delay_works"),
        _mean("CASE WHEN sanction_amount > 0 THEN sanction_amount END", "avg_work_cost"),
        _median("CASE WHEN sanction_amount > 0 THEN sanction_amount END", "median_work_cost", accuracy),
    ]


def _with_rates(df: DataFrame) -> DataFrame:
    money = lambda a, b: F.when(F.col(b) > 0, round_to(F.col(a) / F.col(b) * 100)).otherwise(0.0)
    conversion = F.when((F.col("sanctioned_amount") > 0) & (F.col("sanctioned_works") > 0), rate(F.col("completed_works"), F.col("sanctioned_works"))).otherwise(0.0)
    return df.withColumns(
        {
            "pending_works": F.col("total_works") - F.col("completed_works") - F.col("ongoing_works"),
            "unspent_amount": F.col("sanctioned_amount") - F.col("expenditure_amount"),
            "flagged_rate_pct": rate(F.col("flagged_works"), F.col("total_works")),
            "high_risk_rate_pct": rate(F.col("high_risk_works"), F.col("total_works")),
            "completion_rate_pct": rate(F.col("completed_works"), F.col("total_works")),
            "sanction_rate_pct": rate(F.col("sanctioned_works"), F.col("total_works")),
            "sanction_conversion_pct": conversion,
            "expenditure_sanction_utilization_pct": money("expenditure_amount", "sanctioned_amount"),
            "expenditure_recommendation_pct": money("expenditure_amount", "recommended_amount"),
        }
    )


def member_metrics(works: DataFrame, accuracy: int | None = None) -> DataFrame:
    """One row for each (member_type, member_id); the state is that of the member's first work that has one.

    Medians are exact and interpolated; with ``accuracy`` they are off by at most a share of 1 / accuracy of the ranks, in bounded memory.
    """
    grouped = works.groupBy("member_type", "member_id").agg(
        *_shared(accuracy),
        F.min_by("state_id", F.when(F.col("state_id").isNotNull(), F.col("work_id"))).alias("state_id"),
        _mean("project_age_days", "avg_project_age_days"),
        F.max("project_age_days").alias("max_project_age_days"),
        _mean("pending_days", "avg_pending_days"),
        F.max("pending_days").alias("max_pending_days"),
        _n("risk_level = 'MEDIUM'", "medium_risk_works"),
        _n("execution_days < 0", "negative_execution_works"),
        _n("completion_date < sanction_date", "completion_before_sanction_works"),
        _n("last_expenditure_date < sanction_date", "expenditure_before_sanction_works"),
        _mean("cost_percentile", "avg_cost_percentile"),
        _mean("duration_percentile", "avg_duration_percentile"),
        _mean("cost_deviation", "avg_cost_deviation_pct"),
        _mean("duration_deviation", "avg_duration_deviation_pct"),
    )
    return _with_rates(grouped).withColumn("ranking_qualified", F.col("total_works") >= MEMBER_MINIMUM)


def state_metrics(works: DataFrame, accuracy: int | None = None) -> DataFrame:
    """One row for each state; works without a state are left out. Medians as in ``member_metrics``."""
    members = lambda kind: F.countDistinct(F.when(F.col("member_type") == kind, F.col("member_id")))
    grouped = (
        works.filter("state_id IS NOT NULL")
        .groupBy("state_id")
        .agg(*_shared(accuracy), F.countDistinct(F.struct("member_type", "member_id")).alias("active_members"), members("MP").alias("active_mps"), members("MLA").alias("active_mlas"))
    )
    qualified = (F.col("total_works") >= STATE_MINIMUM) & (F.col("active_members") >= STATE_MEMBERS)
    return _with_rates(grouped).withColumn("ranking_qualified", qualified)


#: The metrics of the national statistics.
STATISTICS = (
    "total_works recommended_works sanctioned_works completed_works ongoing_works pending_works recommended_amount sanctioned_amount expenditure_amount "
    "completion_amount unspent_amount avg_sanction_delay_days median_sanction_delay_days avg_execution_days median_execution_days avg_project_age_days "
    "max_project_age_days avg_pending_days max_pending_days flagged_works medium_risk_works high_risk_works flagged_rate_pct high_risk_rate_pct "
    "cost_anomaly_works duration_anomaly_works expenditure_over_sanction_works expenditure_over_recommendation_works negative_sanction_delay_works "
    "negative_execution_works completion_before_sanction_works expenditure_before_sanction_works overdue_over_1_year overdue_over_2_years "
    "avg_cost_percentile avg_duration_percentile avg_cost_deviation_pct avg_duration_deviation_pct completion_rate_pct sanction_rate_pct "
    "sanction_conversion_pct expenditure_sanction_utilization_pct expenditure_recommendation_pct"
).split()


def national_statistics(members: DataFrame, metrics: list[str] = STATISTICS) -> DataFrame:
    """(metric_name, scope, n, mean, std_dev, minimum, p25, median, p75, p90, p95, maximum, iqr) over members with works.

    scope is BOTH, MP or MLA; a metric without values has no row.
    """
    pairs = F.explode(F.array(*[F.struct(F.lit(m).alias("metric_name"), F.col(m).cast("double").alias("v")) for m in metrics]))
    long = members.filter("total_works > 0").select("member_type", pairs.alias("x")).select("member_type", "x.*").filter("v IS NOT NULL")
    fractions = F.array(*[F.lit(f) for f in (0.25, 0.5, 0.75, 0.9, 0.95)])
    grouped = long.groupingSets([["metric_name", "member_type"], ["metric_name"]], "metric_name", "member_type").agg(
        F.grouping("member_type").alias("g"), F.count("*").alias("n"), (F.sum(F.col("v").cast("decimal(28,4)")).cast("double") / F.count("v")).alias("m"), F.stddev_pop("v").alias("s"), F.min("v").alias("lo"), F.max("v").alias("hi"), F.percentile("v", fractions).alias("p")
    )
    r = lambda c: round_to(c, 4)
    p = F.col("p")
    return grouped.select(
        "metric_name",
        F.when(F.col("g") == 1, "BOTH").otherwise(F.col("member_type")).alias("scope"),
        "n",
        r(F.col("m")).alias("mean"),
        r(F.col("s")).alias("std_dev"),
        r(F.col("lo")).alias("minimum"),
        *[r(p[i]).alias(name) for i, name in enumerate(("p25", "median", "p75", "p90", "p95"))],
        r(F.col("hi")).alias("maximum"),
        r(p[2] - p[0]).alias("iqr"),
    ).filter("scope IS NOT NULL")


def trends(works: DataFrame, reference_date: date = REFERENCE_DATE) -> DataFrame:
    """One row for each (year, member_type); the year is that of the first date a work has."""
    year = F.year(F.coalesce("recommendation_date", "sanction_date", "last_expenditure_date", "completion_date"))
    grouped = (
        works.withColumn("year", year)
        .filter("year IS NOT NULL")
        .groupBy("year", "member_type")
        .agg(*_shared()[:9], _mean("sanction_delay_days", "avg_sanction_delay_days"), _mean("execution_days", "avg_execution_days"))
    )
    return grouped.withColumns({"completion_rate_pct": rate(F.col("completed_works"), F.col("total_works")), "is_partial_year": F.col("year") == reference_date.year})


def overall_metrics(members: DataFrame) -> DataFrame:
    """One row for each scope (BOTH, MP, MLA) over all members, those without works too.

    Cost figures are nearest ranks, element int(n * q), of the members' mean costs.
    """
    working = F.col("total_works") > 0
    cost = F.when(working & (F.col("sanctioned_amount") > 0) & (F.col("sanctioned_works") > 0), F.col("sanctioned_amount") / F.col("sanctioned_works"))
    both = members.select("*", cost.alias("cost"), F.explode(F.array(F.lit("BOTH"), F.col("member_type"))).alias("scope")).filter("scope IS NOT NULL")
    sums = "total_works recommended_works sanctioned_works completed_works ongoing_works pending_works recommended_amount sanctioned_amount expenditure_amount flagged_works high_risk_works cost_anomaly_works duration_anomaly_works overdue_over_1_year overdue_over_2_years".split()
    means = "avg_sanction_delay_days avg_execution_days avg_project_age_days".split()
    grouped = both.groupBy("scope").agg(
        F.count("*").alias("total_members"),
        F.count_if(working).alias("work_bearing"),
        F.count_if(F.col("total_works") == 0).alias("zero_work_members"),
        F.count_if(F.expr("total_works BETWEEN 1 AND 4")).alias("low_sample_members"),
        *[(F.sum(F.col(s).cast("decimal(28,2)")).cast("double") if s.endswith("amount") else F.sum(s)).alias(s) for s in sums],
        # Bounded by the members (hundreds to thousands), never by the works.
        F.sort_array(F.collect_list("cost")).alias("costs"),
        *[_mean(f"CASE WHEN total_works > 0 THEN {m} END", m) for m in means],
        *[round_to(F.percentile(F.when(working, F.col(m)), F.lit(0.5))).alias(m.replace("avg", "median")) for m in means],
    )
    n = F.size("costs")
    at = lambda q: round_to(F.try_element_at("costs", F.floor(n * F.lit(q)).cast("int") + 1))
    out = grouped.withColumns(
        {
            "completion_rate_pct": rate(F.col("completed_works"), F.col("total_works")),
            "sanction_rate_pct": rate(F.col("sanctioned_works"), F.col("total_works")),
            "fund_utilization_pct": F.when(F.col("sanctioned_amount") > 0, round_to(F.col("expenditure_amount") / F.col("sanctioned_amount") * 100)).otherwise(0.0),
            **{f"{name}_work_cost": at(q) for name, q in (("p25", 0.25), ("median", 0.5), ("p75", 0.75), ("p90", 0.9), ("p95", 0.95))},
        }
    )
    return out.drop("costs")


def category_metrics(works: DataFrame, accuracy: int | None = None) -> DataFrame:
    """Works by category, national and by state. Medians as in ``member_metrics``."""
    keyed = works.withColumn("category", category_key(F.col("normalized_activity"), F.col("work_category")))
    priced = "CASE WHEN sanction_amount > 0 THEN sanction_amount END"
    grouped = keyed.groupingSets([["category", "state_id"], ["category"]], "category", "state_id").agg(
        F.grouping("state_id").alias("g"),
        F.count("*").alias("sample_size"),
        F.countDistinct(F.struct("member_type", "member_id")).alias("distinct_members"),
        _n("status = 'Completed'", "completed_works"),
        _n("status = 'In Progress'", "ongoing_works"),
        _n("status = 'Recommended'", "recommended_works"),
        _n("sanction_amount > 0", "sanctioned_works"),
        _total("recommended_amount", "recommended_amount"),
        _total("sanction_amount", "sanctioned_amount"),
        _total("expenditure_amount", "expenditure_amount"),
        _n("project_age_days > 365 AND status <> 'Completed'", "overdue_works"),
        _n("flag_count >= 1", "flagged_works"),
        _mean(priced, "avg_work_cost"),
        _median(priced, "median_work_cost", accuracy),
        _mean("execution_days", "avg_execution_days"),
        _median("execution_days", "median_execution_days", accuracy),
    )
    n = F.col("sample_size")
    return grouped.filter("g = 1 OR state_id IS NOT NULL").select(
        F.when(F.col("g") == 1, "NATIONAL").otherwise("STATE").alias("scope"),
        *[c for c in grouped.columns if c not in ("g", "overdue_works", "flagged_works")],
        rate(F.col("completed_works"), n).alias("completion_rate_pct"),
        F.when(F.col("sanctioned_amount") != 0, round_to(F.col("expenditure_amount") / F.col("sanctioned_amount") * 100)).alias("utilization_pct"),
        rate(F.col("overdue_works"), n).alias("overdue_rate_pct"),
        rate(F.col("flagged_works"), n).alias("risk_rate_pct"),
        F.when(n >= 100, "HIGH").when(n >= 20, "MEDIUM").when(n >= 5, "LOW").otherwise("INSUFFICIENT").alias("confidence"),
    )


def fiscal_metrics(works: DataFrame, payments: DataFrame) -> DataFrame:
    """Events by fiscal year and member type: one union of typed events and one aggregate, instead of outer joins.

    ``payments`` has work_id, day and amount, one row for each payment.
    """
    kinds = (("recommended", "recommendation_date", "recommended_amount"), ("sanctioned", "sanction_date", "sanction_amount"), ("completed", "completion_date", "completion_amount"))
    events = F.explode(F.array(*[F.struct(F.lit(k).alias("kind"), F.col(d).alias("day"), F.col(a).cast("decimal(18,2)").alias("amount")) for k, d, a in kinds]))
    of_works = works.select("member_type", events.alias("e")).select("member_type", "e.*")
    paid = payments.join(works.select("work_id", "member_type"), "work_id").select("member_type", F.lit("expenditure").alias("kind"), "day", "amount")
    rows = of_works.unionByName(paid).filter("day IS NOT NULL").withColumn("fy_start", fiscal_year(F.col("day")))
    is_kind = lambda k: F.col("kind") == k
    counts = [F.count_if(is_kind(k)).alias(n) for k, n in (("recommended", "recommended_works"), ("sanctioned", "sanctioned_works"), ("completed", "completed_works"), ("expenditure", "expenditure_count"))]
    amounts = [F.coalesce(F.sum(F.when(is_kind(k), F.col("amount"))), F.lit(0)).cast("double").alias(n) for k, n in (("recommended", "recommended_amount"), ("sanctioned", "sanctioned_amount"), ("completed", "completion_amount"), ("expenditure", "expenditure_amount"))]
    return rows.groupBy("fy_start", "member_type").agg(*counts, *amounts).withColumn("fy_label", fiscal_label(F.col("fy_start")))


def national_context(statistics: DataFrame, metrics: tuple[str, ...] = ("completion_rate_pct", "expenditure_sanction_utilization_pct", "avg_sanction_delay_days")) -> DataFrame:
    """One row: the national median and 90th percentile of a few metrics over both populations."""
    own = statistics.filter("scope = 'BOTH'")
    pick = lambda m, c: F.max(F.when(F.col("metric_name") == m, F.col(c))).alias(f"{m}_{c}")
    return own.agg(*[pick(m, c) for m in metrics for c in ("median", "p90")])
