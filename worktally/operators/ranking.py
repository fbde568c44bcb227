"""Scores, ranks and percentiles of members and states; one window sort for each population."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from worktally.functions.measures import grade, round_to

#: Weights of completion, utilisation and scale, and the classes of the weighted score.
WEIGHTS = (0.40, 0.40, 0.20)
CLASSES = [(85, "EXCEPTIONAL"), (70, "PERFORMER"), (50, "STABLE"), (35, "NEEDS_ATTENTION")]
RISK_LEVELS = [(0.90, "CRITICAL"), (0.70, "HIGH"), (0.40, "MODERATE")]


def midrank_percent(value: str, partition: list[str]) -> Column:
    """(values below + half the equal ones) / all, in percent with two digits."""
    below = F.rank().over(Window.partitionBy(*partition).orderBy(value)) - 1
    equal = F.count("*").over(Window.partitionBy(*partition, value))
    return round_to((below + equal * F.lit(0.5)) / F.count("*").over(Window.partitionBy(*partition)) * 100)


def _one(partition: list[str]) -> tuple[list[str], dict[str, Column]]:
    """A population of all rows needs a key of its own for its window; entities are few."""
    return (partition, {}) if partition else (["population"], {"population": F.lit("ALL")})


def ranked(entities: DataFrame, id_col: str, partition: list[str], qualified: Column) -> DataFrame:
    """(partition, id, scale_score, performance_score_weighted, rank, performance_classification, national_percentile).

    Entities that aren't qualified have null scores and ranks, and NO_DATA or INSUFFICIENT_DATA.
    Equal scores share a rank and the next rank skips.
    """
    keys, extra = _one(partition)
    base = entities.withColumns({**extra, "qualified": qualified})
    good = base.filter("qualified").withColumn("scale_score", midrank_percent("total_works", keys))
    a, b, c = WEIGHTS
    zero = lambda x: F.coalesce(F.col(x), F.lit(0.0))
    score = round_to(zero("completion_rate_pct") * a + zero("expenditure_sanction_utilization_pct") * b + F.col("scale_score") * c)
    good = good.withColumn("performance_score_weighted", score)
    place = F.rank().over(Window.partitionBy(*keys).orderBy(F.desc("performance_score_weighted")))
    n = F.count("*").over(Window.partitionBy(*keys))
    good = good.withColumns({"rank": place, "population_size": n})
    good = good.withColumn("performance_classification", grade(F.col("performance_score_weighted"), CLASSES, "UNDERPERFORMER"))
    good = good.withColumn("national_percentile", round_to((F.col("population_size") - F.col("rank")) * 100 / F.greatest(F.col("population_size") - 1, F.lit(1))))
    columns = [*partition, id_col, "total_works", "scale_score", "performance_score_weighted", "rank", "performance_classification", "national_percentile"]
    bad = base.filter(~F.coalesce(F.col("qualified"), F.lit(False)))
    empty = {"scale_score": "double", "performance_score_weighted": "double", "rank": "int", "national_percentile": "double"}
    bad = bad.withColumns({k: F.lit(None).cast(t) for k, t in empty.items()})
    bad = bad.withColumn("performance_classification", F.when(F.col("total_works") == 0, "NO_DATA").otherwise("INSUFFICIENT_DATA"))
    return good.select(*columns).unionByName(bad.select(*columns))


def rank_within(df: DataFrame, score: str, partition: list[str]) -> DataFrame:
    """peer_rank and peer_percentile by a score within groups; null scores have neither."""
    scored = df.filter(F.col(score).isNotNull())
    n = F.count("*").over(Window.partitionBy(*partition))
    place = F.rank().over(Window.partitionBy(*partition).orderBy(F.desc(score)))
    return scored.withColumns({"peer_rank": place, "peer_percentile": round_to((n - place) * 100 / F.greatest(n - 1, F.lit(1)))})


def percent_rank_level(df: DataFrame, score: str) -> DataFrame:
    """risk_percentile and risk_level by the share of entities strictly below, all in one population."""
    with_key = df.withColumn("population", F.lit("ALL"))
    share = F.percent_rank().over(Window.partitionBy("population").orderBy(score))
    return with_key.withColumn("risk_percentile", share).withColumn("risk_level", grade(F.col("risk_percentile"), RISK_LEVELS, "LOW")).drop("population")
