"""Isolation forest: trees on small samples, scores by an Arrow-batched function.

Published algorithm (Liu, Ting and Zhou, 2008). Each of the trees is grown on the driver on a
sample of ``SAMPLE`` rows drawn by a seeded hash of the id (the algorithm's own bounded sample);
every row is scored against the broadcast trees.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from worktally.functions.measures import grade, interpolated, round_to
from worktally.runtime import cut

FEATURES = ("sanction_amount", "recommended_amount", "expenditure_amount", "sanction_delay_days", "execution_days", "project_age_days", "cost_percentile", "duration_percentile")
TREES, SAMPLE, SEED, MINIMUM_ROWS = 200, 256, 42, 30
#: Medians and percentiles over all rows are off by at most a share of 1 / ACCURACY of the ranks, in bounded memory.
ACCURACY = 10_000
LEVELS = [(0.66, "HIGHLY_UNUSUAL"), (0.33, "UNUSUAL")]


def _path(n: np.ndarray | float) -> np.ndarray:
    """Mean length of an unsuccessful search among n values."""
    n = np.asarray(n, dtype=float)
    big = np.maximum(n, 3)
    return np.where(n <= 1, 0.0, np.where(n == 2, 1.0, 2 * (np.log(big - 1) + np.euler_gamma) - 2 * (big - 1) / big))


def grow(rows: np.ndarray, rng: np.random.Generator) -> np.ndarray:
    """A tree as an array of (feature, cut, left, right, depth so far + path of the rest); feature -1 is a leaf."""
    limit = int(np.ceil(np.log2(max(2, len(rows)))))
    out: list[list[float]] = []
    todo = [(rows, 0, -1, 0)]
    while todo:
        part, depth, parent, side = todo.pop()
        me = len(out)
        if parent >= 0:
            out[parent][2 + side] = me
        low, high = (part.min(axis=0), part.max(axis=0)) if len(part) else (None, None)
        open_features = np.flatnonzero(high > low) if len(part) > 1 else []
        if depth >= limit or len(open_features) == 0:
            out.append([-1, 0, 0, 0, depth + float(_path(len(part)))])
            continue
        f = int(rng.choice(open_features))
        at = rng.uniform(low[f], high[f])
        out.append([f, at, 0, 0, 0])
        left = part[:, f] < at
        todo += [(part[~left], depth + 1, me, 1), (part[left], depth + 1, me, 0)]
    return np.array(out)


def path_lengths(tree: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """The path length of each row in a tree."""
    node = np.zeros(len(rows), dtype=np.int64)
    while True:
        feature = tree[node, 0].astype(np.int64)
        live = np.flatnonzero(feature >= 0)
        if not len(live):
            return tree[node, 4]
        goes_left = rows[live, feature[live]] < tree[node[live], 1]
        node[live] = np.where(goes_left, tree[node[live], 2], tree[node[live], 3]).astype(np.int64)


def isolation_scores(works: DataFrame, id_col: str = "work_id", features: tuple[str, ...] = FEATURES, trees: int = TREES, sample: int = SAMPLE, seed: int = SEED) -> DataFrame:
    """(id, isolation_score, isolation_level): raw scores scaled so that their median is 0 and their 95th percentile 1.

    Missing values are the feature's median. Fewer than 30 rows give no rows.
    """
    spark = works.sparkSession
    rows = works.select(F.col(id_col).alias("id"), *[F.col(f).cast("double").alias(f) for f in features])
    stats = rows.agg(F.count("*").alias("n"), *[F.percentile_approx(f, F.lit(0.5), F.lit(ACCURACY)).alias(f"{f}_m") for f in features], *[F.avg(f).alias(f"{f}_a") for f in features], *[F.stddev_pop(f).alias(f"{f}_s") for f in features]).first()
    schema = f"{id_col} {works.schema[id_col].dataType.simpleString()}, isolation_score double, isolation_level string"
    if stats["n"] < MINIMUM_ROWS:
        return spark.createDataFrame([], schema)
    medians = np.array([stats[f"{f}_m"] or 0.0 for f in features])
    means = np.array([stats[f"{f}_a"] or 0.0 for f in features])
    scales = np.array([stats[f"{f}_s"] or 1.0 for f in features])

    def matrix(pdf: pd.DataFrame) -> np.ndarray:
        x = pdf[list(features)].to_numpy(dtype=float)
        return (np.where(np.isnan(x), medians, x) - means) / scales

    # The forest's own samples: at most trees * sample rows, drawn by a hash.
    share = min(1.0, trees * sample / stats["n"])
    drawn = rows.filter(F.pmod(F.xxhash64("id", F.lit(seed)), F.lit(1_000_000)) < int(share * 1_000_000) + 1).orderBy(F.xxhash64("id", F.lit(seed + 1)), "id").limit(trees * sample).toPandas()
    pool = matrix(drawn)
    rng = np.random.default_rng(seed)
    size = min(sample, len(pool))
    forest = [grow(pool[rng.choice(len(pool), size, replace=False)], rng) for _ in range(trees)]
    shared = spark.sparkContext.broadcast(forest)
    scale = float(_path(size))

    def score(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in frames:
            x = matrix(pdf)
            mean = np.mean([path_lengths(t, x) for t in shared.value], axis=0) if len(x) else np.zeros(0)
            yield pd.DataFrame({"id": pdf["id"], "raw": np.power(2.0, -mean / scale)})

    raw = cut(rows.mapInPandas(score, f"id {works.schema[id_col].dataType.simpleString()}, raw double"))
    low, high = raw.agg(F.percentile_approx("raw", F.array(F.lit(0.5), F.lit(0.95)), F.lit(ACCURACY)).alias("p")).first()["p"]
    scaled = F.greatest(F.lit(0.0), F.least(F.lit(1.0), (F.col("raw") - low) / (high - low))) if high > low else F.lit(0.0)
    return raw.select(F.col("id").alias(id_col), scaled.alias("isolation_score")).withColumn("isolation_level", grade(F.col("isolation_score"), LEVELS, "NORMAL"))


def isolation_by(works: DataFrame, scores: DataFrame, keys: list[str], id_col: str = "work_id", accuracy: int | None = None, digits: int = 6) -> DataFrame:
    """(keys, isolation_95, n): the 95th percentile, rounded once to ``digits``, of the scores of each entity's works.

    Without ``accuracy`` it is exact, from the number of works at each score, in sorts that can spill.
    """
    rows = works.select(id_col, *keys).join(scores, id_col)
    if accuracy:
        return rows.groupBy(*keys).agg(round_to(F.percentile_approx("isolation_score", F.lit(0.95), F.lit(accuracy)), digits).alias("isolation_95"), F.count("*").alias("n"))
    score = F.col("isolation_score")
    counted = rows.groupBy(*keys, "isolation_score").agg(F.count("*").alias("times"), F.count("isolation_score").alias("scored"))
    all_of = Window.partitionBy(*keys)
    upto = F.sum("scored").over(all_of.orderBy(score.asc_nulls_last()).rowsBetween(Window.unboundedPreceding, Window.currentRow))
    placed = counted.withColumns({"upto": upto, "at": (F.sum("scored").over(all_of) - 1) * F.lit(0.95)})
    first_past = lambda rank: F.min(F.when(F.col("upto") > rank, score))
    ends = placed.groupBy(*keys).agg(first_past(F.floor("at")).alias("low"), first_past(F.ceil("at")).alias("high"), F.max("at").alias("at"), F.sum("times").alias("n"))
    return ends.select(*keys, round_to(interpolated(F.col("low"), F.col("high"), F.col("at") - F.floor("at")), digits).alias("isolation_95"), "n")
