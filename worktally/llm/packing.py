"""Cost-balanced packing of documents into sequences of fixed token capacity.

Method: a document of n tokens costs ``linear * n + quadratic * n * n`` (attention within the
document). Documents, in descending order, go to the sequence of lowest cost that still has room;
the number of sequences is the least that can hold the tokens, and a further one is opened only if
none has room. A document longer than the capacity is split into full pieces and a rest; each full
piece is a container of its own and the rest is packed like any other document.

The documents are spread at random over blocks of about ``CONTAINERS_IN_BLOCK`` containers, which
are packed independently: a block's memory is bounded whatever the corpus, and the unused space of
its last container is a small part of the block.

Defined cases: null and empty texts have no token, take no space and still get a container, in
one piece; repeated rows are documents of their own; an empty table gives no rows. A capacity that
is null or below one is an error.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from worktally.runtime import cut

#: Cost of a token, and of a token squared, in arbitrary units.
LINEAR, QUADRATIC = 1.0, 1.0 / 2048
#: A block holds about so many containers, and at most about so many documents.
CONTAINERS_IN_BLOCK, ITEMS_IN_BLOCK = 512, 20_000
#: The table of capacities is read to the driver; more rows than this are an error.
MOST_KINDS = 1_000


def pack_block(sizes: np.ndarray, capacity: int, linear: float = LINEAR, quadratic: float = QUADRATIC) -> np.ndarray:
    """The sequence (from 0) of each item; ``sizes`` must be in descending order and at most ``capacity``."""
    n_open = max(1, -(-int(sizes.sum()) // capacity))
    room = np.full(n_open, capacity, dtype=np.int64)
    cost = np.zeros(n_open)
    out = np.empty(len(sizes), dtype=np.int64)
    for i, n in enumerate(sizes):
        at = int(np.where(room >= n, cost, np.inf).argmin())
        if room[at] < n:
            room, cost, at = np.append(room, capacity), np.append(cost, 0.0), len(room)
        room[at] -= n
        cost[at] += linear * n + quadratic * n * n
        out[i] = at
    return out


def pack(lengths: DataFrame, capacities: DataFrame, id_col: str = "doc_id", linear: float = LINEAR, quadratic: float = QUADRATIC) -> DataFrame:
    """(container_kind, container_id, id_col, piece_no, first_token, n_tokens) for every capacity.

    ``lengths`` has id_col and n_tokens, ``capacities`` container_kind and capacity_tokens.
    """
    kinds = [(r[0], r[1]) for r in capacities.select("container_kind", F.col("capacity_tokens").cast("bigint")).distinct().limit(MOST_KINDS + 1).collect()]
    if len(kinds) > MOST_KINDS or any(k is None or c is None or c < 1 for k, c in kinds):
        raise ValueError("container kinds need a name and a capacity of at least one token, and must be few")
    id_type = lengths.schema[id_col].dataType.simpleString()
    out_schema = f"container_kind string, container_id string, `{id_col}` {id_type}, piece_no int, first_token bigint, n_tokens bigint"
    if not kinds:
        return lengths.sparkSession.createDataFrame([], out_schema)
    # The row number makes repeated ids different items; the checkpoint fixes it.
    items = cut(lengths.select(F.col(id_col), F.coalesce("n_tokens", F.lit(0)).cast("bigint").alias("n")).withColumn("row_no", F.monotonically_increasing_id()))
    rest = lambda c: F.when(F.col("n") > c, F.col("n") % c).otherwise(F.col("n"))
    totals = items.agg(F.count("*").alias("n"), *[F.sum(rest(c)).alias(f"t{i}") for i, (_, c) in enumerate(kinds)]).first()
    blocks = [max(1, round((totals[f"t{i}"] or 0) / (c * CONTAINERS_IN_BLOCK)), -(-totals["n"] // ITEMS_IN_BLOCK)) for i, (_, c) in enumerate(kinds)]
    specs = F.array(*[F.struct(F.lit(k).alias("kind"), F.lit(c).cast("bigint").alias("capacity"), F.lit(b).cast("bigint").alias("blocks")) for (k, c), b in zip(kinds, blocks)])
    each = items.select(id_col, "n", "row_no", F.explode(specs).alias("s")).select(id_col, "n", "row_no", "s.*")
    whole = F.when(F.col("n") > F.col("capacity"), F.floor(F.col("n") / F.col("capacity"))).otherwise(F.lit(0)).cast("int")
    each = each.withColumn("whole", whole).withColumn("left", F.col("n") - F.col("whole") * F.col("capacity"))

    full = (
        each.filter("whole > 0")
        .withColumn("piece_no", F.explode(F.sequence(F.lit(0), F.col("whole") - 1)))
        .select(
            F.col("kind").alias("container_kind"),
            F.concat_ws(":", "kind", F.lit("full"), F.col("row_no").cast("string"), F.col("piece_no").cast("string")).alias("container_id"),
            id_col,
            "piece_no",
            (F.col("piece_no") * F.col("capacity")).alias("first_token"),
            F.col("capacity").alias("n_tokens"),
        )
    )

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["left", "row_no"], ascending=[False, True], kind="stable")
        at = pack_block(pdf["left"].to_numpy(np.int64), int(pdf["capacity"].iloc[0]), linear, quadratic)
        head = f"{pdf['kind'].iloc[0]}:{pdf['block'].iloc[0]}:"
        return pd.DataFrame(
            {
                "container_kind": pdf["kind"],
                "container_id": [head + str(a) for a in at],
                id_col: pdf[id_col],
                "piece_no": pdf["whole"],
                "first_token": pdf["n"] - pdf["left"],
                "n_tokens": pdf["left"],
            }
        )

    packed = (
        each.filter("left > 0 OR whole = 0")
        .withColumn("block", F.pmod(F.xxhash64("row_no", F.lit(7)), F.col("blocks")))
        .groupBy("kind", "block")
        .applyInPandas(run, out_schema)
    )
    return full.select("container_kind", "container_id", id_col, F.col("piece_no").cast("int").alias("piece_no"), "first_token", "n_tokens").unionByName(packed)


def fill_report(packed: DataFrame, capacities: DataFrame) -> DataFrame:
    """(container_kind, n_containers, n_tokens, unused_share): the space used by kind."""
    by_container = packed.groupBy("container_kind", "container_id").agg(F.sum("n_tokens").alias("n"))
    by_kind = by_container.groupBy("container_kind").agg(F.count("*").alias("n_containers"), F.sum("n").alias("n_tokens"))
    sized = by_kind.join(capacities.select("container_kind", "capacity_tokens").distinct(), "container_kind")
    return sized.select("container_kind", "n_containers", "n_tokens", (1 - F.col("n_tokens") / (F.col("n_containers") * F.col("capacity_tokens"))).alias("unused_share"))


def balance_report(packed: DataFrame, linear: float = LINEAR, quadratic: float = QUADRATIC) -> DataFrame:
    """(container_kind, n_containers, mean_cost, highest_cost, spread): how even the containers' costs are; spread is their standard deviation by their mean.

    Only containers that hold some token count. Full pieces of longer documents are containers of their own.
    """
    n = F.col("n_tokens").cast("double")
    by_container = packed.groupBy("container_kind", "container_id").agg(F.sum(F.lit(linear) * n + F.lit(quadratic) * n * n).alias("cost")).filter("cost > 0")
    return by_container.groupBy("container_kind").agg(F.count("*").alias("n_containers"), F.avg("cost").alias("mean_cost"), F.max("cost").alias("highest_cost"), (F.stddev_pop("cost") / F.avg("cost")).alias("spread"))
