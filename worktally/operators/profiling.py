"""K-Means profiles of entities: features, the choice of k by silhouette, labels by tertiles, stability."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Numbers of clusters tried, seeds of each, least rows of a member's and a state's cluster, tertiles in percent.
KS, SEEDS, MEMBER_CLUSTER, STATE_CLUSTER, TERTILES = range(2, 7), range(42, 52), 5, 3, (0.333, 0.666)
#: The features, and how a label names those that it may use.
MEMBER_PROFILE = ["financial_efficiency", "implementation_efficiency", "timeliness", "portfolio_health", "portfolio_size_log"]
STATE_PROFILE = [*MEMBER_PROFILE, "active_members_log"]
LABELLED = {"financial_efficiency": ("Financial Eff.", ("High", "Mid", "Low")), "implementation_efficiency": ("Implementation Eff.", ("High", "Mid", "Low"))}
INSUFFICIENT = "insufficient"


def _zero(name: str) -> Column:
    return F.coalesce(F.col(name).cast("double"), F.lit(0.0))


def _common() -> list[Column]:
    n = F.greatest(F.col("total_works"), F.lit(1)).cast("double")
    return [
        _zero("expenditure_sanction_utilization_pct").alias("financial_efficiency"),
        (_zero("completed_works") / n * 100).alias("implementation_efficiency"),
        _zero("avg_sanction_delay_days").alias("timeliness"),
    ]


def member_features(members: DataFrame) -> DataFrame:
    """(member_type, member_id, MEMBER_PROFILE) of members with five works or more; of the health only the cost term is divided by three."""
    n = F.greatest(F.col("total_works"), F.lit(1)).cast("double")
    health = 100 - (_zero("flagged_rate_pct") + _zero("overdue_over_1_year") * 100 / n + _zero("cost_anomaly_works") * 100 / n / 3)
    return members.filter("total_works >= 5").select("member_type", "member_id", *_common(), health.alias("portfolio_health"), F.log1p(F.col("total_works").cast("double")).alias("portfolio_size_log"))


def state_features(states: DataFrame) -> DataFrame:
    """(state_id, STATE_PROFILE) of all states with works."""
    n = F.greatest(F.col("total_works"), F.lit(1)).cast("double")
    health = 100 - (_zero("overdue_over_1_year") * 100 / n + _zero("flagged_rate_pct")) / 2
    return states.select("state_id", *_common(), health.alias("portfolio_health"), F.log1p(F.col("total_works").cast("double")).alias("portfolio_size_log"), F.log1p(F.col("active_members").cast("double")).alias("active_members_log"))


def cluster_labels(placed: DataFrame, keys: list[str], least: int = MEMBER_CLUSTER) -> DataFrame:
    """(keys, cluster_id, cluster_label, cluster_size) of rows with features and a cluster_id.

    A cluster is named by the places of its two first features' means among the tertiles of all
    rows; one of fewer than ``least`` rows is "insufficient" and has size 0.
    """
    names = list(LABELLED)
    marks = placed.agg(*[F.percentile(f, F.array(*[F.lit(t) for t in TERTILES])).alias(f"{f}_marks") for f in names])
    centres = placed.groupBy("cluster_id").agg(F.count("*").alias("n"), *[F.avg(f).alias(f) for f in names])
    parts = []
    for f, (title, (high, mid, low)) in LABELLED.items():
        level = F.when(F.col(f) >= F.col(f"{f}_marks")[1], high).when(F.col(f) >= F.col(f"{f}_marks")[0], mid).otherwise(low)
        parts.append(F.concat(level, F.lit(f" {title}")))
    label = F.when(F.col("n") < least, INSUFFICIENT).otherwise(F.concat_ws(" / ", *parts))
    named = centres.join(F.broadcast(marks), how="left").select("cluster_id", label.alias("cluster_label"), F.when(F.col("n") < least, 0).otherwise(F.col("n")).cast("bigint").alias("cluster_size"))
    return placed.select(*keys, "cluster_id").join(F.broadcast(named), "cluster_id").select(*keys, "cluster_id", "cluster_label", "cluster_size")


def _scaled(rows: DataFrame, features: list[str]) -> DataFrame:
    from pyspark.ml.feature import StandardScaler, VectorAssembler

    assembled = VectorAssembler(inputCols=features, outputCol="raw").transform(rows)
    return StandardScaler(inputCol="raw", outputCol="features", withMean=True, withStd=True).fit(assembled).transform(assembled)


def _fit(scaled: DataFrame, k: int, seeds: range | None = None):
    from pyspark.ml.clustering import KMeans

    return min((KMeans(k=k, seed=s, featuresCol="features", predictionCol="cluster_id").fit(scaled) for s in seeds or SEEDS), key=lambda m: m.summary.trainingCost)


def kmeans_profiles(rows: DataFrame, keys: list[str], features: list[str], least: int = MEMBER_CLUSTER) -> DataFrame:
    """(keys, cluster_id, cluster_label, cluster_size): the k = 2..6 of the best silhouette; -1 and "insufficient" where there are fewer than two rows.

    Entities are few (hundreds to thousands); each k is fitted from several seeds, lowest cost kept.
    """
    from pyspark.ml.evaluation import ClusteringEvaluator

    filled = rows.fillna(0.0, subset=features)
    n = filled.count()
    if n <= min(KS):
        return filled.select(*keys, F.lit(-1).alias("cluster_id"), F.lit(INSUFFICIENT).alias("cluster_label"), F.lit(0).cast("bigint").alias("cluster_size"))
    scaled = _scaled(filled, features).cache()
    try:
        evaluator = ClusteringEvaluator(featuresCol="features", predictionCol="cluster_id")
        best = None
        for k in KS:
            if k >= n:
                break
            model = _fit(scaled, k)
            if model.summary.k < 2 or len([s for s in model.summary.clusterSizes if s]) < 2:
                continue
            quality = evaluator.evaluate(model.transform(scaled))
            if best is None or quality > best[0]:
                best = (quality, model)
    finally:
        scaled.unpersist()
    if best is None:
        return filled.select(*keys, F.lit(-1).alias("cluster_id"), F.lit(INSUFFICIENT).alias("cluster_label"), F.lit(0).cast("bigint").alias("cluster_size"))
    return cluster_labels(best[1].transform(scaled).select(*keys, *features, "cluster_id"), keys, least)


def rand_index(pairs: DataFrame) -> float:
    """The adjusted Rand index of two clusterings ``a`` and ``b`` of the same rows; 1 where both say the same."""
    cells = pairs.groupBy("a", "b").agg(F.count("*").alias("n"))
    two = lambda c: F.sum(c * (c - 1) / 2)
    both = cells.agg(two(F.col("n")), F.sum("n")).first()
    rows, columns = (cells.groupBy(c).agg(F.sum("n").alias("n")).agg(two(F.col("n"))).first()[0] for c in ("a", "b"))
    if not both[1] or both[1] < 2:
        return 1.0
    chance = rows * columns / (both[1] * (both[1] - 1) / 2)
    most = (rows + columns) / 2
    return 1.0 if most == chance else (both[0] - chance) / (most - chance)


def stability(rows: DataFrame, keys: list[str], features: list[str], k: int, rounds: int = 5, share: float = 0.85, seed: int = 42) -> float:
    """The mean adjusted Rand index of the clusters of all rows and those of ``rounds`` samples of ``share`` without replacement."""
    scaled = _scaled(rows.fillna(0.0, subset=features), features)
    whole = _fit(scaled, k, range(seed, seed + 1)).transform(scaled).select(*keys, F.col("cluster_id").alias("a"))
    scores = []
    for i in range(rounds):
        part = scaled.sample(False, share, seed + i)
        own = _fit(part, k, range(seed, seed + 1)).transform(part).select(*keys, F.col("cluster_id").alias("b"))
        scores.append(rand_index(whole.join(own, keys)))
    return sum(scores) / len(scores)
