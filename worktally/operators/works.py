"""One record for each work: assembly from deliveries, cleaning, durations and money.

Deliveries are reduced to the latest row of a key before any join, so that each join is one to one
and a key delivered many times costs no more than its own partition's aggregate.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from worktally.functions.measures import activity_name, parse_amount, parse_date, round_to
from worktally.functions.text import whole_number

#: The day the measures refer to; never the clock.
REFERENCE_DATE = date(2026, 9, 30)


def latest_rows(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The row of each key that is last by ``order`` (ties: the largest row); rows with a null key are left out."""
    rest = [c for c in df.columns if c not in keys and c not in order]
    kept = df.dropna(subset=keys).groupBy(*keys).agg(F.max(F.struct(*order, *rest)).alias("r"))
    return kept.select(*keys, *[F.col(f"r.{c}").alias(c) for c in df.columns if c not in keys])


def payments_by_work(expenditure: DataFrame) -> DataFrame:
    """(work_id, expenditure_amount, first_expenditure_date, last_expenditure_date, n_payments): each payment once, positive amounts only."""
    once = expenditure.groupBy("sno").agg(F.max(F.struct("work_recommendation_dtl_id", "fund_disbursed_amt", "expenditure_date")).alias("p"))
    typed = once.select(
        whole_number(F.col("p.work_recommendation_dtl_id")).cast("bigint").alias("work_id"), parse_amount(F.col("p.fund_disbursed_amt")).alias("amount"), parse_date(F.col("p.expenditure_date")).alias("day")
    )
    return typed.filter("work_id IS NOT NULL").groupBy("work_id").agg(F.sum("amount").cast("decimal(18,2)").alias("expenditure_amount"), F.min("day").alias("first_expenditure_date"), F.max("day").alias("last_expenditure_date"), F.count("*").alias("n_payments"))


def build_works(recommended: DataFrame, sanctioned: DataFrame, payments: DataFrame) -> DataFrame:
    """Recommendations with their sanction and payments, one row for each work.

    The last delivery of a key wins; sanction fields fall back to the recommendation's.
    """

    def typed(df: DataFrame) -> DataFrame:
        keyed = df.withColumn("work_id", whole_number(F.col("work_recommendation_dtl_id")).cast("bigint"))
        return keyed.select("work_id", "loaded_at", "state_name", "mp_name", "activity_name", "work_category", "recommendation_date", "sanction_date", "sanction_amount", *[c for c in ("recommended_amount",) if c in df.columns])

    rec = latest_rows(typed(recommended), ["work_id"], ["loaded_at"])
    san = latest_rows(typed(sanctioned), ["work_id"], ["loaded_at"]).select("work_id", F.col("sanction_date").alias("s_date"), F.col("sanction_amount").alias("s_amount"))
    joined = rec.join(san, "work_id", "left").join(payments, "work_id", "left")
    return joined.select(
        "work_id",
        "mp_name",
        "state_name",
        activity_name(F.col("activity_name")).alias("normalized_activity"),
        "work_category",
        parse_date(F.col("recommendation_date")).alias("recommendation_date"),
        F.coalesce(parse_date(F.col("s_date")), parse_date(F.col("sanction_date"))).alias("sanction_date"),
        parse_amount(F.col("recommended_amount")).alias("recommended_amount"),
        F.coalesce(parse_amount(F.col("s_amount")), parse_amount(F.col("sanction_amount"))).alias("sanction_amount"),
        "expenditure_amount",
        "last_expenditure_date",
        "n_payments",
    )


def clean_analysis(work_analysis: DataFrame, payments: DataFrame) -> DataFrame:
    """The latest calculation of each work with typed keys, positive amounts and its payments."""
    latest = latest_rows(work_analysis, ["work_id"], ["last_calculated"])
    positive = lambda c: F.when(F.col(c) > 0, F.col(c))
    kept = latest.select(
        "work_id",
        F.upper(F.regexp_replace("member_type", " ", "")).alias("member_type"),
        "member_id",
        "state_id",
        activity_name(F.col("activity_name")).alias("normalized_activity"),
        "work_category",
        "recommendation_date",
        "sanction_date",
        "completion_date",
        F.coalesce(positive("recommended_amount"), F.lit(0)).cast("decimal(18,2)").alias("recommended_amount"),
        F.coalesce(positive("sanction_amount"), F.lit(0)).cast("decimal(18,2)").alias("sanction_amount"),
        positive("completion_amount").alias("completion_amount"),
    )
    return kept.join(payments.drop("n_payments"), "work_id", "left")


def status() -> Column:
    """Completed, In Progress, Recommended or Unknown by the dates a work has."""
    return F.when(F.col("completion_date").isNotNull(), "Completed").when(F.col("sanction_date").isNotNull(), "In Progress").when(F.col("recommendation_date").isNotNull(), "Recommended").otherwise("Unknown")


def with_measures(works: DataFrame, reference_date: date = REFERENCE_DATE) -> DataFrame:
    """Status, durations in days and shares of the sanction of each work.

    A completion before the sanction has no execution time; shares are null without a sanction.
    """
    ref = F.lit(reference_date)
    spent = lambda c: F.when(F.col("sanction_amount") > 0, round_to(F.col(c).cast("double") / F.col("sanction_amount").cast("double") * 100))
    took = F.datediff("completion_date", "sanction_date")
    return works.withColumn("status", status()).withColumns(
        {
            "sanction_delay_days": F.datediff("sanction_date", "recommendation_date"),
            "project_age_days": F.datediff(ref, "recommendation_date"),
            "execution_days": F.when(took >= 0, took),
            "pending_days": F.when(F.col("status") != "Completed", F.datediff(ref, "sanction_date")),
            "days_since_payment": F.datediff(ref, "last_expenditure_date"),
            "expenditure_percentage": spent("expenditure_amount"),
            "completion_percentage": spent("completion_amount"),
        }
    )


def with_profiles(works: DataFrame, default_days: int = 365) -> DataFrame:
    """financial_profile, timeline_profile and payment_profile of benchmarked works.

    The timeline is held against the peers' 90th percentile of execution times, else ``default_days``.
    """
    share, waits, since = F.col("expenditure_percentage"), F.col("pending_days"), F.col("days_since_payment")
    limit = F.coalesce("duration_p90", F.lit(float(default_days)))
    done, planned = F.col("status") == "Completed", F.col("status") == "Recommended"
    money = F.when(planned | share.isNull(), "UNKNOWN").when(share >= 90, "STRONG").when(share >= 50, "ADEQUATE").otherwise("LOW")
    finished = F.when(F.col("sanction_delay_days") < 0, "UNKNOWN").otherwise("ON_TRACK")
    open_works = F.when(planned | waits.isNull() | (waits < 0), "UNKNOWN").when(waits > limit * 1.5, "SEVERELY_DELAYED").when(waits > limit, "DELAYED").otherwise("ON_TRACK")
    paid = F.when(done | since.isNull() | (since < 0), "NO_DATA").when(since <= 180, "ACTIVE").when(since <= 365, "SLOWING").otherwise("STALLED")
    return works.withColumns({"financial_profile": money, "timeline_profile": F.when(done, finished).otherwise(open_works), "payment_profile": paid})
