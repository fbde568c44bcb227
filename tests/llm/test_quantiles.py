import random
from datetime import datetime, timedelta

import numpy as np
import pytest

pytest.importorskip("worktally.llm.quantiles")
from pyspark.sql import functions as F

from worktally.llm import quantiles
from worktally.llm.quantiles import BITS, code_of, compress, daily_digests, merge_digests, percentiles, value_of

FRACTIONS = {"p01": 0.01, "p50": 0.5, "p99": 0.99}
SCHEMA = "work_id bigint, state_id int, sanction_amount decimal(18,2), execution_days int, last_calculated timestamp, node string, n int, code string"


def _works(spark, rows):
    frame = spark.createDataFrame([(i, s, a, d, t) for i, s, a, d, t in rows], "work_id bigint, state_id int, a double, execution_days int, last_calculated timestamp")
    return frame.select("work_id", "state_id", F.col("a").cast("decimal(18,2)").alias("sanction_amount"), "execution_days", "last_calculated", F.lit("clash").alias("node"), F.lit(1).alias("n"), F.lit("x").alias("code"))


def test_codes_keep_order_and_value(spark):
    values = [0.0, 0.01, -0.01, 5.5, -5.5, 687194767.36, 687194767.35, 32762782600.0, 9e15, -9e15]
    df = spark.createDataFrame([(v,) for v in values], "v double").select("v", code_of(F.col("v"), 2).alias("c"))
    rows = df.select("v", "c", value_of(F.col("c"), 2).cast("double").alias("back")).collect()
    assert [r.v for r in sorted(rows, key=lambda r: r.c)] == sorted(values)
    for r in rows:
        assert 0 <= r.c < 1 << BITS
        assert abs(r.back - r.v) <= abs(r.v) * 2**-35 + (0 if abs(r.v) < 6.8e8 else 0.01)
    huge = spark.sql("SELECT cast(null as double) a, 1e300D b, -1e300D c, double('NaN') d").select(*[code_of(F.col(x)) for x in "abcd"]).first()
    assert huge[0] is None and huge[3] is None and 0 <= huge[2] < huge[1] < 1 << BITS


@pytest.mark.parametrize("k", [8, 32, 200])
def test_rank_error_is_bounded(k):
    rng = np.random.default_rng(k)
    values = rng.integers(0, 1 << 20, 5000) ** 2 % (1 << 30)
    parts = [compress(np.zeros(len(p), dtype=np.int64), p + (1 << BITS), np.ones(len(p), dtype=np.int64), k) for p in np.array_split(values, 7)]
    merged = compress(*(np.concatenate([p[i] for p in parts]) for i in range(3)), k)
    _, nodes, counts = merged
    assert counts.sum() == 5000 and len(nodes) <= 3 * k + 2 * BITS
    depth = np.frexp(nodes.astype(float))[1] - 1
    last = ((nodes + 1) << (BITS - depth)) - 1 - (1 << BITS)
    order = np.lexsort((BITS - depth, last))
    running = np.cumsum(counts[order])
    for f in (0.01, 0.25, 0.5, 0.9, 0.99):
        target = int(np.ceil(f * 5000))
        found = last[order][np.searchsorted(running, target)]
        low, high = np.sum(values < found), np.sum(values <= found)
        assert low - BITS * (5000 // k) <= target <= high + BITS * (5000 // k)


def test_days_combine_to_the_whole(spark):
    rng = random.Random(2)
    t0 = datetime(2026, 8, 1)
    rows = [(i, rng.choice([1, 1, 1, 2, None]), rng.choice([None, 5.0, float(rng.randint(-9, 10**6)) / 100]), rng.randint(-3, 500), t0 + timedelta(days=i % 5)) for i in range(900)]
    again = [(i, s, a, d, t + timedelta(days=9)) for i, s, a, d, t in rows[::3]] + rows[:50]
    odd = [(None, 1, 1.0, None, t0), (None, 1, 1.0, None, t0), (10**9, 3, None, None, None)]
    measures = {"sanction_amount": 2, "execution_days": 0}
    digests = daily_digests(_works(spark, rows + again + odd), "state_id", measures, "work_id", "last_calculated")
    got = {(r.state_id, r.field_name): r for r in percentiles(digests, "state_id", measures, FRACTIONS).collect()}
    assert not [k for k in got if k[0] == 3]
    for s in (1, 2, None):
        for field, i in (("sanction_amount", 2), ("execution_days", 3)):
            own = sorted(r[i] for r in rows + odd[:2] if r[1] == s and r[i] is not None)
            r = got[s, field]
            assert (r.n, r.max_rank_error) == (len(own), 0)
            for name, f in FRACTIONS.items():
                assert r[name] == pytest.approx(own[max(1, int(np.ceil(f * len(own)))) - 1])
    # Digests of days that are merged in two steps, or stored and added later, give the same counts.
    half = digests.filter("day < '2026-08-03'")
    both = merge_digests(half.unionByName(digests.filter("day >= '2026-08-03'")).select("state_id", "field_name", "node", "n"), ["state_id", "field_name"])
    assert both.agg(F.sum("n")).first()[0] == digests.agg(F.sum("n")).first()[0]


def test_empty_table(spark):
    empty = _works(spark, [])
    measures = {"sanction_amount": 2}
    assert percentiles(daily_digests(empty, "state_id", measures, "work_id", "last_calculated"), "state_id", measures, FRACTIONS).count() == 0


def test_a_hot_state_over_many_days_keeps_the_bound(spark):
    """200 days, of which one state holds a third of the values, with n over k: the tree merges 64 days at a time."""
    n, k = 60_000, 512
    rows = spark.range(n).select(
        F.col("id").alias("work_id"),
        F.when(F.col("id") % 3 == 0, 7).otherwise((F.col("id") % 23).cast("int")).alias("state_id"),
        F.pmod(F.xxhash64("id"), F.lit(1_000_000)).cast("int").alias("execution_days"),
        F.timestamp_seconds(F.lit(1_700_000_000) + F.pmod(F.xxhash64("id", F.lit(1)), F.lit(200)) * 86_400).alias("last_calculated"),
    )
    digests = daily_digests(rows, "state_id", {"execution_days": 0}, "work_id", "last_calculated", k)
    got = {r.state_id: r for r in percentiles(digests, "state_id", {"execution_days": 0}, FRACTIONS, k).collect()}
    own = {}
    for r in rows.select("state_id", "execution_days").collect():
        own.setdefault(r.state_id, []).append(r.execution_days)
    assert set(got) == set(own) and got[7].max_rank_error == BITS * (len(own[7]) // k) > 0
    for s, values in own.items():
        values = np.sort(values)
        assert got[s].n == len(values)
        for name, f in FRACTIONS.items():
            target = max(1, int(np.ceil(f * len(values))))
            low, high = np.searchsorted(values, got[s][name], "left"), np.searchsorted(values, got[s][name], "right")
            assert low - got[s].max_rank_error <= target <= high + got[s].max_rank_error


def test_no_task_merges_more_than_the_fan_in(spark, monkeypatch):
    seen = []
    real = quantiles._squeezed
    monkeypatch.setattr(quantiles, "_squeezed", lambda parts, keys, k: (seen.append(parts.groupBy(*keys).agg(F.countDistinct("day").alias("d")).agg(F.max("d")).first()[0]) if "day" in parts.columns else None, real(parts, keys, k))[1])
    days = spark.range(300).select(F.expr("date_add(date'2020-01-01', int(id))").alias("day"), F.lit(1).alias("state_id"), (F.col("id") + (1 << BITS)).alias("node"), F.lit(1).cast("bigint").alias("n"))
    merged = quantiles.merge_days(days, ["state_id"])
    assert merged.agg(F.sum("n")).first()[0] == 300 and seen[0] <= quantiles.FAN_IN
