"""Exact set-similarity join by prefix filtering.

Tokens are ordered by global rarity (the rarest first, ties by token). Two sets of Jaccard
similarity t or more share a token among the first ``|x| - ceil(t |x|) + 1`` of each, so only these
prefixes are joined; the length filter and, at the first common token, the positional filter drop
further pairs before the exact similarity is counted.

A left set may hold more tokens than can count (alternatives of a word). Its ``units`` then say how many
can, and a pair is kept if ``t`` could be reached by that number: of c tokens counted, c / (units + |y| - c)
is t or more only if the sets share t (units + |y|) / (1 + t) tokens, at least t times units and t times |y|.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from worktally.runtime import broadcast_checked, cut


def _least(t: float, n: Column) -> Column:
    return F.ceil(F.lit(t) * n - F.lit(1e-9))


def similarity_join(left: DataFrame, right: DataFrame, threshold: float, units: str | None = None) -> DataFrame:
    """(left_id, right_id, jaccard) of the pairs with ``jaccard >= threshold``.

    Both sides have ``id`` (unique) and ``tokens`` (an array of distinct strings); empty and null
    sets are similar to nothing. Repeated ids give repeated candidates, not repeated pairs. With
    ``units``, a column of ``left``, the pairs are all that could reach the threshold by that number.
    """
    sides = {"l": (left, units), "r": (right, None)}
    listed = None
    for name, (side, counts) in sides.items():
        part = side.select(F.lit(name).alias("side"), F.col("id").cast("string").alias("id"), (F.col(counts) if counts else F.lit(None)).cast("int").alias("units"), F.explode("tokens").alias("token"))
        listed = part if listed is None else listed.unionByName(part)
    rarity = broadcast_checked(listed.groupBy("token").agg(F.count("*").alias("freq")))
    # Read four times below, so it is written once.
    ordered = cut(
        listed.join(rarity, "token")
        .groupBy("side", "id")
        .agg(F.sort_array(F.collect_set(F.struct("freq", "token"))).alias("s"), F.max("units").alias("units"))
        .select("side", "id", F.col("s.token").alias("tokens"), F.size("s").alias("n"), F.coalesce("units", F.size("s")).alias("units"))
    )
    length = F.greatest(F.col("n") - _least(threshold, F.col("units")) + 1, F.lit(0)).cast("int")
    prefix = ordered.select("side", "id", "n", "units", F.posexplode(F.slice("tokens", 1, length)).alias("at", "token"))
    x = prefix.filter("side = 'l'").select(F.col("id").alias("left_id"), F.col("n").alias("nx"), F.col("units").alias("ux"), F.col("at").alias("i"), "token")
    y = prefix.filter("side = 'r'").select(F.col("id").alias("right_id"), F.col("n").alias("ny"), F.col("at").alias("j"), "token")
    overlap = F.ceil(F.lit(threshold / (1 + threshold)) * (F.col("ux") + F.col("ny")) - F.lit(1e-9))
    pairs = (
        x.join(y, "token")
        .filter((F.col("ny") >= F.lit(threshold) * F.col("ux") - 1e-9) & (F.col("ux") >= F.lit(threshold) * F.col("ny") - 1e-9))
        .groupBy("left_id", "right_id", "nx", "ux", "ny")
        .agg(F.min("i").alias("i"), F.min("j").alias("j"))
        .filter(1 + F.least(F.col("nx") - F.col("i") - 1, F.col("ny") - F.col("j") - 1) >= overlap)
    )
    lx = ordered.filter("side = 'l'").select(F.col("id").alias("left_id"), F.col("tokens").alias("tx"))
    ry = ordered.filter("side = 'r'").select(F.col("id").alias("right_id"), F.col("tokens").alias("ty"))
    common = F.size(F.array_intersect("tx", "ty"))
    return (
        pairs.join(lx, "left_id")
        .join(ry, "right_id")
        .withColumn("common", common)
        .filter(F.col("common") >= overlap)
        .select("left_id", "right_id", (F.col("common") / (F.col("nx") + F.col("ny") - F.col("common"))).alias("jaccard"))
    )
