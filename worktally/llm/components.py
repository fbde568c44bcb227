"""Connected components: small graphs in one task, others by minimum labels and pointer jumping."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from worktally.runtime import cut, tidy

#: Rounds after which a graph is taken to be wrong; labels reach a path of length n in about log2(n) rounds.
MOST_ROUNDS = 60
#: Up to so many edges, counted, one task joins them (some 100 MB); more are labelled in rounds, with the same labels.
ONE_TASK_EDGES = 200_000


def _in_one_task(edges: DataFrame) -> DataFrame:
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        parent: dict[int, int] = {}

        def find(x: int) -> int:
            while (up := parent.setdefault(x, x)) != x:
                parent[x] = x = parent[up]
            return x

        for pdf in batches:
            for a, b in zip(pdf["a"].tolist(), pdf["b"].tolist()):
                a, b = find(a), find(b)
                parent[max(a, b)] = min(a, b)
        nodes = list(parent)
        yield pd.DataFrame({"node": pd.Series(nodes, dtype="int64"), "label": pd.Series([find(x) for x in nodes], dtype="int64")})

    return edges.coalesce(1).mapInPandas(run, "node bigint, label bigint")


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, label) of every node of ``edges`` (a, b bigint); label is the least node of its component.

    ``edges`` are made once and written. A round gives a node the least label among its neighbours' and then the
    label of that label; a hot node costs one partial aggregate. Labels are merged with the edges, never broadcast: what
    a round holds on the driver doesn't grow with the graph. Labels are written to the checkpoint folder each round.
    """
    once = cut(edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).filter("a <> b").distinct())
    tidy(edges.sparkSession)
    if once.count() <= ONE_TASK_EDGES:
        return _in_one_task(once)
    both = once.unionByName(once.select(F.col("b").alias("a"), F.col("a").alias("b")))
    # The least neighbour's least neighbour: two steps before anything is written.
    near = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("label")).select(F.col("a").alias("node"), "label")
    labels = cut(near.join(near.select(F.col("node").alias("label"), F.col("label").alias("higher")).hint("merge"), "label").select("node", F.least("label", "higher").alias("label")))
    for _ in range(MOST_ROUNDS):
        offered = both.join(labels.hint("merge"), both.b == labels.node).select(F.col("a").alias("node"), "label", F.lit(None).cast("bigint").alias("own"))
        least = offered.unionByName(labels.withColumn("own", F.col("label"))).groupBy("node").agg(F.min("label").alias("label"), F.max("own").alias("own"))
        up = labels.select(F.col("node").alias("label"), F.col("label").alias("higher"))
        done = cut(least.join(up.hint("merge"), "label", "left").select("node", F.least("label", F.coalesce("higher", "label")).alias("label"), "own"))
        labels = done.select("node", "label")
        if done.filter("label <> own").limit(1).count() == 0:
            del both, done
            tidy(edges.sparkSession)
            return labels
    raise RuntimeError("components did not settle")
