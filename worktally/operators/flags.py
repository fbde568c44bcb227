"""Declarative flags: ordered rules over a row and one row of global thresholds."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: The flags in order, each a condition in SQL. ``t`` is the row of thresholds.
RULES = {
    "SOURCE_DATA_DEFECT_NEGATIVE_DELAY": "sanction_delay_days < 0",
    "SANCTION_DELAY_VERY_HIGH": "sanction_delay_days >= 0 AND sanction_delay_days > t.delay_p95",
    "SANCTION_DELAY_HIGH": "sanction_delay_days >= 0 AND sanction_delay_days > t.delay_p90 AND NOT sanction_delay_days > t.delay_p95",
    "SANCTION_DELAY_ELEVATED": "sanction_delay_days >= 0 AND sanction_delay_days > t.delay_p75 AND NOT sanction_delay_days > t.delay_p90",
    "LONG_PENDING": "status <> 'Completed' AND pending_days > t.duration_p90",
    "LOW_EXPENDITURE": "status <> 'Completed' AND sanction_amount > 0 AND expenditure_amount = 0 AND pending_days > 180",
    "PAYMENT_STAGNATION": "status <> 'Completed' AND days_since_payment > 180",
    "COST_ANOMALY": "cost_status IN ('VERY_HIGH', 'HIGH')",
    "DURATION_ANOMALY": "status = 'Completed' AND duration_status IN ('VERY_LONG', 'LONG')",
    "OVER_EXPENDITURE": "sanction_amount > 0 AND expenditure_amount > sanction_amount * 1.05",
    "POST_COMPLETION_PAYMENT": "last_expenditure_date > completion_date",
}
DEFECTS = ("SOURCE_DATA_DEFECT_NEGATIVE_DELAY",)
#: Signals in order.
SIGNALS = {
    "SANCTION_MATCHES_RECOMMENDATION": "recommended_amount > 0 AND sanction_amount > 0 AND sanction_amount = recommended_amount",
    "RECENT_PAYMENT_ACTIVITY": "status <> 'Completed' AND days_since_payment <= 180",
    "EXPENDITURE_ON_TRACK": "expenditure_percentage BETWEEN 75 AND 100",
    "COMPLETION_RECORDED": "status = 'Completed'",
    "COST_WITHIN_PEER_RANGE": "cost_status = 'NORMAL'",
    "DURATION_WITHIN_PEER_RANGE": "duration_status = 'NORMAL'",
}


def matching(rules: dict[str, str]) -> Column:
    """The names of the rules whose condition holds, in order."""
    return F.array_compact(F.array(*[F.when(F.expr(condition), F.lit(name)) for name, condition in rules.items()]))


def with_flags(works: DataFrame, thresholds: DataFrame, rules: dict[str, str] = RULES) -> DataFrame:
    """risk_flags, flag_count, risk_level and positive_signals of each work; ``thresholds`` is one row."""
    one = thresholds.select(F.struct("*").alias("t"))
    flagged = works.join(F.broadcast(one.limit(1)), how="left").withColumn("risk_flags", matching(rules)).drop("t")
    real = F.size(F.filter("risk_flags", lambda f: ~f.isin(*DEFECTS)))
    level = F.when(F.array_contains("risk_flags", "OVER_EXPENDITURE") | (real >= 3), "HIGH").when(real == 2, "MEDIUM").when(real == 1, "LOW").otherwise("NORMAL")
    return flagged.withColumns({"flag_count": F.size("risk_flags"), "risk_level": level, "positive_signals": matching(SIGNALS)})
