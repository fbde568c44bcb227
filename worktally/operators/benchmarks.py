"""Peer groups of works, their percentiles, and each work's place among its peers.

Both levels (activity in a state, activity) and both pools come from one pass with grouping sets.
Percentiles are exact and interpolated; with ``accuracy`` they are approximate instead, which
bounds the memory of a group that holds a large part of all rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from worktally.functions.measures import band, grade, round_to
from worktally.runtime import broadcast_checked

FRACTIONS = (0.25, 0.50, 0.75, 0.90, 0.95)
#: Least sizes of a strong, a good and a limited peer group.
STRONG, GOOD, LIMITED = 20, 10, 5
PARTS = [f"{what}_p{int(f * 100)}" for what in ("cost", "duration") for f in FRACTIONS]


def _percentiles(x: Column, accuracy: int | None) -> Column:
    fractions = F.array(*[F.lit(f) for f in FRACTIONS])
    return F.percentile_approx(x, fractions, F.lit(accuracy)) if accuracy else F.percentile(x, fractions)


def benchmark_groups(works: DataFrame, accuracy: int | None = None) -> DataFrame:
    """(pool, level, normalized_activity, state_id, n, cost_p25 … duration_p95).

    Pool ``MP`` holds the works of all members, pool ``MLA`` those of MLAs; level is ``STATE`` or
    ``NATIONAL``. Only works with a sanction date and amount and an activity are peers.
    """
    peers = works.filter("sanction_amount > 0 AND sanction_date IS NOT NULL AND normalized_activity <> ''")
    pools = F.when(F.col("member_type") == "MLA", F.array(F.lit("MP"), F.lit("MLA"))).otherwise(F.array(F.lit("MP")))
    each = peers.select(F.explode(pools).alias("pool"), "normalized_activity", "state_id", F.col("sanction_amount").cast("double").alias("cost"), F.col("execution_days").cast("double").alias("duration"))
    grouped = each.groupingSets([["pool", "normalized_activity", "state_id"], ["pool", "normalized_activity"]], "pool", "normalized_activity", "state_id").agg(
        F.grouping("state_id").alias("g"), F.count("*").alias("n"), _percentiles(F.col("cost"), accuracy).alias("c"), _percentiles(F.col("duration"), accuracy).alias("d")
    )
    # Rounded, so that a value equal to its percentile compares as equal in every engine.
    cells = [round_to(F.col("c")[i], 4).alias(PARTS[i]) for i in range(5)] + [round_to(F.col("d")[i], 4).alias(PARTS[5 + i]) for i in range(5)]
    level = F.when(F.col("g") == 1, "NATIONAL").otherwise("STATE")
    return grouped.filter("g = 1 OR state_id IS NOT NULL").select("pool", level.alias("level"), "normalized_activity", "state_id", "n", *cells)


def with_benchmarks(works: DataFrame, groups: DataFrame) -> DataFrame:
    """Each work with the quality, size and percentiles of its peer group, its bands and deviations.

    The group of the state is taken from LIMITED works on, else the national one, else none.
    """
    keys = ["pool", "normalized_activity"]
    cells = lambda prefix: [F.struct("n", *PARTS).alias(prefix)]
    state = broadcast_checked(groups.filter("level = 'STATE'").select(*keys, "state_id", *cells("s")))
    nation = broadcast_checked(groups.filter("level = 'NATIONAL'").select(*keys, *cells("c")))
    pooled = works.withColumn("pool", F.when(F.col("member_type") == "MLA", "MLA").otherwise("MP"))
    joined = pooled.join(state, [*keys, "state_id"], "left").join(nation, keys, "left")
    s, n = F.coalesce("s.n", F.lit(0)), F.coalesce("c.n", F.lit(0))
    size = F.when(s >= LIMITED, s).when(n >= LIMITED, n).otherwise(F.lit(0))
    grades = lambda x, head: F.when(x >= STRONG, f"{head}_STRONG").when(x >= GOOD, f"{head}_GOOD").otherwise(f"{head}_LIMITED")
    quality = F.when(s >= LIMITED, grades(s, "ACTIVITY_STATE")).when(n >= LIMITED, grades(n, "ACTIVITY_NATIONAL")).otherwise("INSUFFICIENT")
    chosen = F.when(s >= LIMITED, F.col("s")).when(n >= LIMITED, F.col("c"))
    picked = joined.withColumns({"benchmark_quality": quality, "benchmark_sample_size": size, "b": chosen}).select(*works.columns, "benchmark_quality", "benchmark_sample_size", "b.*").drop("n")
    cost, took = F.col("sanction_amount").cast("double"), F.col("execution_days").cast("double")
    placed = picked.withColumns({"cost_percentile": band(cost, [F.col(p) for p in PARTS[:5]]), "duration_percentile": band(took, [F.col(p) for p in PARTS[5:]])})
    off = lambda v, m: F.when(F.col(m) != 0, round_to((v - F.col(m)) / F.col(m) * 100))
    return placed.withColumns(
        {
            "cost_status": _status("cost_percentile", "HIGH", "LOW"),
            "duration_status": _status("duration_percentile", "LONG", "SHORT"),
            "cost_deviation": off(cost, "cost_p50"),
            "duration_deviation": off(took, "duration_p50"),
        }
    )


def _status(column: str, high: str, low: str) -> Column:
    steps = [(95, f"VERY_{high}"), (90, high), (75, "ABOVE_NORMAL"), (25, "NORMAL"), (10, "BELOW_NORMAL")]
    plain = grade(F.col(column), steps, f"VERY_{low}")
    return F.when(F.col("benchmark_sample_size") < LIMITED, "NO_RELIABLE_BENCHMARK").when((F.col("status") != "Completed") | F.col(column).isNull(), "NOT_APPLICABLE").otherwise(plain)


def delay_distribution(works: DataFrame, accuracy: int | None = None) -> DataFrame:
    """One row: delay_p75, delay_p90, delay_p95 of the sanction delays from zero on, and duration_p90 of all execution times."""
    delay = F.when(F.col("sanction_delay_days") >= 0, F.col("sanction_delay_days").cast("double"))
    at = lambda x, fractions: F.percentile_approx(x, fractions, F.lit(accuracy)) if accuracy else F.percentile(x, fractions)
    out = works.agg(at(delay, F.array(F.lit(0.75), F.lit(0.90), F.lit(0.95))).alias("p"), at(F.col("execution_days").cast("double"), F.lit(0.90)).alias("duration_p90"))
    r = lambda c: round_to(c, 4)
    return out.select(r(F.col("p")[0]).alias("delay_p75"), r(F.col("p")[1]).alias("delay_p90"), r(F.col("p")[2]).alias("delay_p95"), r(F.col("duration_p90")).alias("duration_p90"))
