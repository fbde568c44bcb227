"""Mergeable percentiles with deterministic rank error.

Method: a value is quantized to a bounded, ordered universe of 2**BITS codes and counted in a
dyadic tree over it. A node whose count, with its sibling's and its parent's, is at most n/k is
added to its parent, so a digest keeps at most about 3k nodes. Digests of partitions or days are
merged by adding the counts of equal nodes and compressing again. A percentile read from a digest
of n values is off by at most BITS * floor(n / k) ranks; with fewer than k values it is exact.

Quantizing: a value times 10**decimals is exact below 2**36 (687 million with two decimals), above
that its relative error is below 2**-35. The order is kept.

Defined cases: null values and NaN are left out, and a group without values gives no row; a null group is
a group; of rows with one id the earliest counts (ties: the smallest row); rows without an id count
one by one; values beyond 2**62 in size count as that bound.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from worktally.runtime import shuffle_width

#: The universe has 2**BITS codes: a sign, and 27 powers of two over an exact range of 2**EXACT.
EXACT = 36
BITS = 42
MIDDLE = 1 << (BITS - 1)
#: The compression parameter: a rank is off by at most BITS / K of the values (0.6 %).
K = 8192
#: Nodes a task holds before it hands on what it has.
NODES_HELD = 1_000_000
#: Digests merged by one task.
FAN_IN = 64


def code_of(value: Column, decimals: int = 0) -> Column:
    """The code of a numeric column, as bigint in [0, 2**BITS)."""
    limit = F.lit(str((1 << 62) // 10**decimals)).cast("decimal(30,6)")
    exact = F.coalesce(value.try_cast("decimal(30,6)"), F.when(value > 0, limit).otherwise(-limit))
    held = F.least(F.greatest(exact, -limit), limit)
    whole = F.round(held * F.lit(10**decimals).cast("decimal(10,0)"), 0).cast("bigint")
    size = F.abs(whole)
    over = F.greatest(F.length(F.bin(size)) - EXACT, F.lit(0))
    part = F.when(over == 0, size).otherwise(over.cast("bigint") * F.lit(1 << (EXACT - 1)) + F.call_function("shiftright", size, over.cast("int")))
    # least and greatest pass over nulls, so a null value is put back here.
    return F.when(value.isNotNull() & ~F.isnan(value.cast("double")), F.when(whole < 0, F.lit(MIDDLE) - part).otherwise(F.lit(MIDDLE) + part))


def value_of(code: Column, decimals: int = 0) -> Column:
    """The value of a code: the lower bound, in size, of what it stands for."""
    part = F.abs(code - F.lit(MIDDLE))
    half = F.lit(1 << (EXACT - 1))
    over = F.greatest((part / half).cast("bigint") - 1, F.lit(0)).cast("int")
    size = F.call_function("shiftleft", part - over.cast("bigint") * half, over)
    signed = F.when(code < MIDDLE, -size).otherwise(size)
    return signed.cast("decimal(38,0)") / F.lit(10**decimals).cast("decimal(10,0)") if decimals else signed


def compress(groups: np.ndarray, nodes: np.ndarray, counts: np.ndarray, k: int = K) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The compressed trees of many groups at once. A node is numbered from the root 1, its children are 2i and 2i + 1."""
    if not len(nodes):
        return groups, nodes, counts
    order = np.lexsort((nodes, groups))
    groups, nodes, counts = _added(groups[order], nodes[order], counts[order])
    totals = np.zeros(int(groups.max()) + 1, dtype=np.int64)
    np.add.at(totals, groups, counts)
    limit = totals // k
    live = limit[groups] > 0
    if not live.any():
        return groups, nodes, counts
    done = [(groups[~live], nodes[~live], counts[~live])]
    groups, nodes, counts = groups[live], nodes[live], counts[live]
    for level in range(BITS, 0, -1):
        here = nodes >= 1 << level
        if not here.any():
            continue
        g, v, c = groups[here], nodes[here], counts[here]
        up_g, up_v, up_c = groups[~here], nodes[~here], counts[~here]
        parents = v >> 1
        order = np.lexsort((parents, g))
        g, v, c, parents = g[order], v[order], c[order], parents[order]
        first = np.r_[True, (g[1:] != g[:-1]) | (parents[1:] != parents[:-1])]
        family = np.cumsum(first) - 1
        sums = np.add.reduceat(c, np.flatnonzero(first))
        fg, fp = g[first], parents[first]
        # Counts already in the parents, found by (group, parent).
        above = (up_v >= 1 << (level - 1)) & (up_v < 1 << level)
        held = _looked_up(up_g[above], up_v[above], up_c[above], fg, fp)
        joins = sums + held <= limit[fg]
        stays = ~joins[family]
        done.append((g[stays], v[stays], c[stays]))
        groups, nodes, counts = np.r_[up_g, fg[joins]], np.r_[up_v, fp[joins]], np.r_[up_c, sums[joins]]
        order = np.lexsort((nodes, groups))
        groups, nodes, counts = _added(groups[order], nodes[order], counts[order])
    done.append((groups, nodes, counts))
    return tuple(np.concatenate([d[i] for d in done]) for i in range(3))


def _added(groups: np.ndarray, nodes: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    if not len(nodes):
        return groups, nodes, counts
    first = np.r_[True, (groups[1:] != groups[:-1]) | (nodes[1:] != nodes[:-1])]
    return groups[first], nodes[first], np.add.reduceat(counts, np.flatnonzero(first))


def _looked_up(groups: np.ndarray, nodes: np.ndarray, counts: np.ndarray, at_groups: np.ndarray, at_nodes: np.ndarray) -> np.ndarray:
    if not len(nodes):
        return np.zeros(len(at_nodes), dtype=np.int64)
    both = pd.DataFrame({"g": groups, "v": nodes, "c": counts}).groupby(["g", "v"], sort=False)["c"].sum()
    return both.reindex(pd.MultiIndex.from_arrays([at_groups, at_nodes])).fillna(0).to_numpy(np.int64)


def _compress_frame(pdf: pd.DataFrame, keys: list[str], k: int) -> pd.DataFrame:
    numbered = pdf.groupby(keys, dropna=False, sort=False).ngroup().to_numpy()
    heads = pdf.loc[~pd.Series(numbered).duplicated().to_numpy(), keys].reset_index(drop=True)
    g, v, c = compress(numbered, pdf["node"].to_numpy(np.int64), pdf["n"].to_numpy(np.int64), k)
    out = heads.iloc[g].reset_index(drop=True)
    out["node"], out["n"] = v, c
    return out


def _schema(df: DataFrame, keys: list[str]) -> T.StructType:
    fields = [T.StructField(x, df.schema[x].dataType) for x in keys]
    return T.StructType([*fields, T.StructField("node", T.LongType()), T.StructField("n", T.LongType())])


def build_digests(codes: DataFrame, keys: list[str], k: int = K, n_parts: int | None = None) -> DataFrame:
    """(keys, node, n): the digest of the codes of each group; ``codes`` has the keys and ``code``.

    ``n_parts`` bounds the number of tasks that read ``codes``; where it isn't known the rows are spread over as many as a shuffle has.
    """
    schema = _schema(codes, keys)
    names = [*keys, "node", "n"]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[pd.DataFrame] = []
        size = 0
        for pdf in batches:
            pdf["node"] = pdf.pop("code") + (1 << BITS)
            pdf["n"] = 1
            part = pdf.groupby([*keys, "node"], dropna=False, sort=False)["n"].sum().reset_index()
            held.append(part)
            size += len(part)
            if size > NODES_HELD:
                held = [_compress_frame(pd.concat(held, ignore_index=True), keys, k)]
                size = len(held[0])
                if size > NODES_HELD // 2:
                    yield held.pop()[names]
                    size = 0
        if held:
            yield _compress_frame(pd.concat(held, ignore_index=True), keys, k)[names]

    # A task hands on a digest of its own, so there are at most as many parts of a key as there are tasks.
    width = shuffle_width(codes.sparkSession)
    tasks = codes.select(*keys, "code") if n_parts else codes.select(*keys, "code").repartition(width)
    n_parts = n_parts or width
    return merge_digests(tasks.mapInPandas(run, schema).withColumn("part", F.spark_partition_id()), keys, k, n_parts)


def merge_digests(parts: DataFrame, keys: list[str], k: int = K, n_parts: int | None = None) -> DataFrame:
    """(keys, node, n): the digests of equal keys merged by node addition in a tree: no task reads more than FAN_IN digests of one key.

    ``part`` numbers the digests of a key from 0, and ``n_parts`` bounds the numbers; without it they are one digest.
    """
    if n_parts is None or "part" not in parts.columns:
        return _squeezed(parts.select(*keys, "node", "n"), keys, k)
    while n_parts > FAN_IN:
        n_parts = -(-n_parts // FAN_IN)
        parts = _squeezed(parts.withColumn("part", F.floor(F.col("part") / FAN_IN).cast("int")), [*keys, "part"], k)
    return _squeezed(parts.select(*keys, "node", "n"), keys, k)


def merge_days(digests: DataFrame, keys: list[str], day: str = "day", k: int = K) -> DataFrame:
    """(keys, node, n): the stored digests of all days of each key in one; days are merged FAN_IN at a time, by their number.

    Days without a date are one part of their own.
    """
    number = F.coalesce(F.datediff(F.col(day), F.lit("1970-01-01").cast("date")), F.lit(-1))
    first, last = digests.agg(F.min(number), F.max(number)).first()
    if first is None:
        return merge_digests(digests, keys, k)
    return merge_digests(digests.withColumn("part", (number - F.lit(first)).cast("int")), keys, k, last - first + 1)


def _squeezed(parts: DataFrame, keys: list[str], k: int) -> DataFrame:
    """The nodes added up and compressed. A task holds whole digests, many small ones or a few large ones, and compresses all at once."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[pd.DataFrame] = []
        size, most = 0, NODES_HELD
        for pdf in batches:
            held.append(pdf)
            size += len(pdf)
            if size > most:
                held = [_compress_frame(pd.concat(held, ignore_index=True), keys, k)]
                size = len(held[0])
                most = max(NODES_HELD, 2 * size)
        if held:
            yield _compress_frame(pd.concat(held, ignore_index=True), keys, k)[[*keys, "node", "n"]]

    added = parts.groupBy(*keys, "node").agg(F.sum("n").alias("n"))
    return added.repartition(shuffle_width(parts.sparkSession), *keys).mapInPandas(run, _schema(parts, keys))


def read_percentiles(digests: DataFrame, keys: list[str], fractions: list[float], k: int = K) -> DataFrame:
    """(keys, n, max_rank_error, codes): the codes at the nearest ranks of ``fractions`` of each digest."""
    fields = [T.StructField(x, digests.schema[x].dataType) for x in keys]
    schema = T.StructType([*fields, T.StructField("n", T.LongType()), T.StructField("max_rank_error", T.LongType()), T.StructField("codes", T.ArrayType(T.LongType()))])

    def read(pdf: pd.DataFrame) -> pd.DataFrame:
        nodes, counts = pdf["node"].to_numpy(np.int64), pdf["n"].to_numpy(np.int64)
        depth = np.frexp(nodes.astype(np.float64))[1] - 1
        shift = BITS - depth
        last = ((nodes + 1) << shift) - 1 - (1 << BITS)  # the largest code below the node
        order = np.lexsort((shift, last))
        running = np.cumsum(counts[order])
        n = int(running[-1])
        wanted = [max(1, int(np.ceil(f * n - 1e-9))) for f in fractions]
        codes = last[order][np.searchsorted(running, wanted)]
        row = {x: [pdf[x].iloc[0]] for x in keys}
        return pd.DataFrame({**row, "n": [n], "max_rank_error": [BITS * (n // k)], "codes": [codes.tolist()]})

    return digests.groupBy(*keys).applyInPandas(read, schema)


def first_rows(df: DataFrame, id_col: str, time_col: str, columns: list[str]) -> DataFrame:
    """One row for each id, the earliest; rows without an id are all kept, each under a number of its own, so that they don't meet in one task."""
    row = F.struct(F.coalesce(F.col(time_col), F.lit("1970-01-01").cast("timestamp")).alias("t"), *[F.col(c) for c in columns])
    own = F.when(F.col(id_col).isNull(), F.monotonically_increasing_id())
    return df.select(F.col(id_col).alias("_id"), own.alias("_own"), row.alias("r")).groupBy("_id", "_own").agg(F.min("r").alias("r")).select("r.*")


def daily_digests(df: DataFrame, group: str, measures: dict[str, int], id_col: str, time_col: str, k: int = K) -> DataFrame:
    """(day, group, field_name, node, n): a digest for each day, group and measure; each id counts on its first day.

    ``measures`` gives the decimals of each measured column.
    """
    rows = first_rows(df, id_col, time_col, [group, *measures])
    entries = F.array(*[F.struct(F.lit(m).alias("field_name"), code_of(F.col(m), d).alias("code")) for m, d in measures.items()])
    codes = rows.select(F.to_date("t").alias("day"), group, F.explode(entries).alias("e")).select("day", group, "e.field_name", "e.code").filter("code IS NOT NULL")
    # The rows come out of one shuffle.
    return build_digests(codes, ["day", group, "field_name"], k, shuffle_width(df.sparkSession))


def percentiles(digests: DataFrame, group: str, measures: dict[str, int], fractions: dict[str, float], k: int = K) -> DataFrame:
    """(group, field_name, n, max_rank_error, a column for each fraction) over all days of ``digests`` (day, group, field_name, node, n)."""
    keys = [group, "field_name"]
    read = read_percentiles(merge_days(digests, keys, k=k), keys, list(fractions.values()), k)

    def value(i: int) -> Column:
        out = F.lit(None).cast("double")
        for m, d in measures.items():
            out = F.when(F.col("field_name") == m, value_of(F.col("codes")[i], d).cast("double")).otherwise(out)
        return out

    return read.select(*keys, "n", "max_rank_error", *[value(i).alias(name) for i, name in enumerate(fractions)])
