"""Percentiles of the work measures (problem 2)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from worktally.llm.quantiles import daily_digests, percentiles
from worktally.runtime import cut

#: The measured columns and their decimals.
MEASURES = {"sanction_amount": 2, "execution_days": 0}
FRACTIONS = {"p10": 0.10, "p25": 0.25, "median": 0.50, "p75": 0.75, "p90": 0.90, "p95": 0.95, "p99": 0.99}


#: Days of the window of ``p2_last_days``, back from the last calculation.
LAST_DAYS = 30


def _digests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The digests of every day, written once: all that the queries below read."""
    works = spark.read.parquet(f"{sf_dir}/work_analysis.parquet")
    return cut(daily_digests(works, "state_id", MEASURES, "work_id", "last_calculated"))


def p2_percentiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Percentiles of each measure by state, from the merged digests of all days."""
    return percentiles(_digests(spark, sf_dir), "state_id", MEASURES, FRACTIONS)


def p2_last_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same over the last LAST_DAYS days only, from the stored digests of those days."""
    stored = _digests(spark, sf_dir)
    last = F.broadcast(stored.agg(F.max("day").alias("last")))
    window = stored.join(last, F.col("day") > F.date_sub("last", LAST_DAYS)).drop("last")
    return percentiles(window, "state_id", MEASURES, FRACTIONS)


def p2_digests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(day, state_id, field_name, node, n): the digests as they are stored, to be added to those of other days."""
    return _digests(spark, sf_dir)


def p2_daily_digests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many values the digest of each day counts, by state and measure."""
    return _digests(spark, sf_dir).groupBy("day", "state_id", "field_name").agg(F.sum("n").alias("n_values"))


QUERIES = {"p2_percentiles": p2_percentiles, "p2_last_days": p2_last_days, "p2_digests": p2_digests, "p2_daily_digests": p2_daily_digests}

_FIRST = """
WITH firsts AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY work_id ORDER BY last_calculated, state_id, sanction_amount, execution_days) AS rn FROM work_analysis) WHERE rn = 1),
vals AS (SELECT CAST(last_calculated AS DATE) AS day, state_id, 'sanction_amount' AS field_name, CAST(sanction_amount AS DOUBLE) AS v FROM firsts WHERE sanction_amount IS NOT NULL
  UNION ALL SELECT CAST(last_calculated AS DATE), state_id, 'execution_days', CAST(execution_days AS DOUBLE) FROM firsts WHERE execution_days IS NOT NULL)
"""


def _ranked(values: str) -> str:
    return (
        _FIRST
        + f""", ranked AS (SELECT *, row_number() OVER (PARTITION BY state_id, field_name ORDER BY v) AS r, count(*) OVER (PARTITION BY state_id, field_name) AS n FROM {values})
SELECT state_id, field_name, max(n) AS n, 42 * (max(n) // 8192) AS max_rank_error"""
        + "".join(f", max(CASE WHEN r = greatest(1, CAST(ceil({f} * n - 1e-9) AS BIGINT)) THEN v END) AS {name}" for name, f in FRACTIONS.items())
        + " FROM ranked GROUP BY state_id, field_name"
    )


# A digest of fewer than 8192 values has a leaf for each value: the root of the tree has 2**42 leaves, 2**41 stands for zero.
_CODE = "abs(w) >> greatest(length(to_base(abs(w), 2)) - 36, 0)"
_NODES = f"""
, coded AS (SELECT day, state_id, field_name, CAST(round(v * CASE WHEN field_name = 'sanction_amount' THEN 100 ELSE 1 END) AS BIGINT) AS w FROM vals),
sized AS (SELECT *, ({_CODE}) + greatest(length(to_base(abs(w), 2)) - 36, 0) * 34359738368 AS part FROM coded)
SELECT day, state_id, field_name, 4398046511104 + 2199023255552 + CASE WHEN w < 0 THEN -part ELSE part END AS node, count(*) AS n FROM sized GROUP BY ALL"""
ORACLES = {
    "p2_percentiles": _ranked("vals"),
    "p2_last_days": _ranked(f"(SELECT * FROM vals WHERE day > (SELECT max(day) FROM vals) - {LAST_DAYS})"),
    "p2_digests": _FIRST + _NODES,
    "p2_daily_digests": _FIRST + "SELECT day, state_id, field_name, count(*) AS n_values FROM vals GROUP BY ALL",
}
