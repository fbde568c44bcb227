import random
from datetime import date

import numpy as np
import pytest
from pyspark.sql import functions as F

from worktally.operators import anomaly, audit, benchmarks, delta, evidence, flags, isolation, metrics, profiling, ranking, works


def test_latest_rows_breaks_ties_and_leaves_out_null_keys(spark):
    df = spark.createDataFrame([(1, 1, "a"), (1, 2, "b"), (1, 2, "c"), (None, 9, "z"), (2, None, "d")], "k int, t int, r string")
    assert sorted(tuple(r) for r in works.latest_rows(df, ["k"], ["t"]).collect()) == [(1, 2, "c"), (2, None, "d")]


def test_measures_of_a_work(spark):
    cols = "work_id bigint, recommendation_date date, sanction_date date, completion_date date, last_expenditure_date date, sanction_amount double, expenditure_amount double, completion_amount double"
    d = date
    rows = [
        (1, d(2024, 1, 1), d(2024, 1, 11), d(2024, 2, 1), d(2024, 3, 1), 100.0, 95.0, None),
        (2, d(2024, 1, 1), d(2023, 12, 30), None, None, 0.0, 5.0, None),
        (3, d(2024, 1, 1), None, None, None, 0.0, None, None),
        (4, None, None, None, None, 0.0, None, None),
        (5, None, d(2024, 1, 10), d(2024, 1, 1), None, 10.0, None, 10.0),
    ]
    got = {r.work_id: r for r in works.with_measures(spark.createDataFrame(rows, cols), d(2024, 12, 31)).collect()}
    assert [got[i].status for i in range(1, 6)] == ["Completed", "In Progress", "Recommended", "Unknown", "Completed"]
    assert (got[1].sanction_delay_days, got[1].execution_days, got[1].pending_days, got[1].expenditure_percentage) == (10, 21, None, 95.0)
    assert (got[2].sanction_delay_days, got[2].expenditure_percentage) == (-2, None)
    assert (got[5].execution_days, got[5].completion_percentage) == (None, 100.0)


def test_benchmarks_against_numpy(spark):
    rng = random.Random(1)
    rows = [(i, rng.choice(["MP", "MLA"]), rng.choice(["a", "b", ""]), rng.choice([1, 2, None]), float(rng.randint(1, 50)), date(2024, 1, 1), rng.choice([None, 5, 9]), rng.choice(["Completed", "In Progress"])) for i in range(400)]
    df = spark.createDataFrame(rows, "work_id bigint, member_type string, normalized_activity string, state_id int, sanction_amount double, sanction_date date, execution_days int, status string")
    groups = benchmarks.benchmark_groups(df)
    for g in groups.collect():
        own = [r for r in rows if r[2] == g.normalized_activity and (g.level == "NATIONAL" or r[3] == g.state_id) and (g.pool == "MP" or r[1] == "MLA")]
        assert g.n == len(own)
        assert g.cost_p90 == pytest.approx(np.percentile([r[4] for r in own], 90), abs=1e-3)
    placed = {r.work_id: r for r in benchmarks.with_benchmarks(df, groups).collect()}
    assert len(placed) == 400
    assert placed[next(r[0] for r in rows if r[2] == "")].benchmark_quality == "INSUFFICIENT"
    approx = benchmarks.benchmark_groups(df, accuracy=1000)
    assert approx.count() == groups.count()


def test_flags_in_order(spark):
    cols = "work_id bigint, sanction_delay_days int, status string, pending_days int, sanction_amount double, recommended_amount double, expenditure_amount double, days_since_payment int, cost_status string, duration_status string, last_expenditure_date date, completion_date date, expenditure_percentage double"
    rows = [(1, -1, "Completed", None, 10.0, 10.0, 5.0, None, "X", "X", None, None, 50.0), (2, 99, "In Progress", 400, 10.0, 1.0, 20.0, 200, "HIGH", "X", None, None, None), (3, None, None, None, None, None, None, None, None, None, None, None, None), (4, 1, "In Progress", 200, 10.0, 1.0, 0.0, 5, "NORMAL", "X", None, None, 80.0)]
    t = spark.createDataFrame([(5.0, 9.0, 50.0, 300.0)], "delay_p75 double, delay_p90 double, delay_p95 double, duration_p90 double")
    got = {r.work_id: r for r in flags.with_flags(spark.createDataFrame(rows, cols), t).collect()}
    assert got[1].risk_flags == ["SOURCE_DATA_DEFECT_NEGATIVE_DELAY"] and (got[1].risk_level, got[1].flag_count) == ("NORMAL", 1)
    assert got[2].risk_flags == ["SANCTION_DELAY_VERY_HIGH", "LONG_PENDING", "PAYMENT_STAGNATION", "COST_ANOMALY", "OVER_EXPENDITURE"] and got[2].risk_level == "HIGH"
    assert (got[3].risk_flags, got[3].risk_level) == ([], "NORMAL")
    assert got[4].risk_flags == ["LOW_EXPENDITURE"] and got[4].positive_signals == ["RECENT_PAYMENT_ACTIVITY", "EXPENDITURE_ON_TRACK", "COST_WITHIN_PEER_RANGE"]


def test_midrank_and_competition_rank(spark):
    df = spark.createDataFrame([(1, "MP", 1), (2, "MP", 2), (3, "MP", 2), (4, "MP", 3), (5, "MP", 0)], "id int, member_type string, total_works int")
    df = df.withColumns({"completion_rate_pct": F.lit(20.0), "expenditure_sanction_utilization_pct": F.lit(45.97)})
    got = {r.id: r for r in ranking.ranked(df, "id", ["member_type"], F.col("total_works") > 0).collect()}
    assert [got[i].scale_score for i in (1, 2, 3, 4)] == [12.5, 50.0, 50.0, 87.5]
    assert [got[i]["rank"] for i in (4, 2, 3, 1)] == [1, 2, 2, 4]
    assert got[5]["rank"] is None and got[5].performance_classification == "NO_DATA"


def test_percent_rank_level_with_ties_at_the_top(spark):
    df = spark.createDataFrame([(i, float(min(i, 14))) for i in range(36)], "id int, s double")
    levels = [r.risk_level for r in ranking.percent_rank_level(df, "s").collect()]
    assert (levels.count("LOW"), levels.count("MODERATE")) == (14, 22)


def test_robust_z_vectors(spark):
    long = spark.createDataFrame([("a", float(v)) for v in (1, 2, 3, 4, 100)] + [("b", float(v)) for v in (1, 1, 1, 1, 9)] + [("c", 1.0)], "g string, v double")
    got = anomaly.robust_z(long, ["g"]).collect()
    assert sorted(round(r.z, 4) for r in got if r.g == "a") == [-1.349, -0.6745, 0.0, 0.6745, 5.0]
    assert {r.z for r in got if r.g == "b"} == {0.0} and not [r for r in got if r.g == "c"]


def test_isolation_of_entities_without_scores(spark):
    works = spark.createDataFrame([(1, 1), (2, 1), (3, 1), (4, None), (5, 2)], "work_id int, state_id int")
    scores = spark.createDataFrame([(1, 0.2), (2, None), (3, 0.4), (4, 0.7), (5, None)], "work_id int, isolation_score double")
    got = {r.state_id: (r.isolation_95, r.n) for r in isolation.isolation_by(works, scores, ["state_id"], digits=4).collect()}
    assert got == {1: (0.39, 3), None: (0.7, 1), 2: (None, 1)}
    assert isolation.isolation_by(works.limit(0), scores, ["state_id"]).count() == 0


def test_isolation_forest_finds_the_outlier_whatever_the_partitions(spark):
    rng = np.random.default_rng(3)
    rows = [(i, *map(float, rng.normal(0, 1, 3))) for i in range(300)] + [(999, 12.0, -12.0, 12.0), (1000, None, None, None)]
    df = spark.createDataFrame(rows, "work_id bigint, a double, b double, c double")
    one = isolation.isolation_scores(df, features=("a", "b", "c"), trees=50)
    two = isolation.isolation_scores(df.repartition(7), features=("a", "b", "c"), trees=50)
    a, b = ({r.work_id: r.isolation_score for r in x.collect()} for x in (one, two))
    assert a == pytest.approx(b) and all(0 <= v <= 1 for v in a.values()) and a[999] == 1.0
    assert isolation.isolation_scores(df.limit(10), features=("a", "b", "c")).count() == 0


def test_kmeans_invariants(spark, monkeypatch):
    monkeypatch.setattr(profiling, "SEEDS", range(42, 44))
    monkeypatch.setattr(profiling, "KS", range(2, 5))
    keys = ["member_type", "member_id"]
    rows = [("MP", i, 10.0 * (i % 3) + i * 0.001, 1.0, 0.0, 0.0, 1.0) for i in range(45)] + [("MP", 100, 500.0, 90.0, 0.0, 0.0, 1.0)]
    df = spark.createDataFrame(rows, f"member_type string, member_id int, {', '.join(f'{c} double' for c in profiling.MEMBER_PROFILE)}")
    got = profiling.kmeans_profiles(df.filter("member_id < 100"), keys, profiling.MEMBER_PROFILE).collect()
    clusters = {r.member_id: r.cluster_id for r in got}
    assert len(clusters) == 45 and len(set(clusters.values())) == 3
    assert all(clusters[i] == clusters[i % 3] for i in range(45))
    assert {r.cluster_size for r in got} == {15} and {r.cluster_label for r in got} == {"Low Financial Eff. / High Implementation Eff.", "Mid Financial Eff. / High Implementation Eff.", "High Financial Eff. / High Implementation Eff."}
    # A cluster of one keeps its number and is "insufficient".
    odd = {r.member_id: r for r in profiling.kmeans_profiles(df, keys, profiling.MEMBER_PROFILE).collect()}
    assert (odd[100].cluster_label, odd[100].cluster_size) == ("insufficient", 0) and odd[100].cluster_id >= 0
    few = profiling.kmeans_profiles(df.limit(2), keys, profiling.MEMBER_PROFILE).collect()
    assert {(r.cluster_id, r.cluster_label) for r in few} == {(-1, "insufficient")}


def test_kmeans_is_fitted_from_ten_seeds(spark, monkeypatch):
    from pyspark.ml.clustering import KMeans

    fitted, fit = [], KMeans.fit
    monkeypatch.setattr(KMeans, "fit", lambda self, df: fitted.append((self.getK(), self.getSeed())) or fit(self, df))
    monkeypatch.setattr(profiling, "KS", range(2, 3))
    df = spark.createDataFrame([(i, *[10.0 * (i % 2) + i * 0.001] * 5) for i in range(10)], f"id int, {', '.join(f'{c} double' for c in profiling.MEMBER_PROFILE)}")
    profiling.kmeans_profiles(df, ["id"], profiling.MEMBER_PROFILE)
    assert sorted(fitted) == [(2, s) for s in range(42, 52)]


def test_delta(spark):
    table = lambda rows: spark.createDataFrame(rows, "k int, h string, v int")
    old, new = table([(1, "a", 1), (2, "b", 2), (3, None, 3)]), table([(1, "a", 5), (2, "x", 6), (3, None, 7), (4, "n", 8)])
    assert sorted(tuple(r) for r in delta.table_diff(old, new, ["k"], "h").collect()) == [(1, "unchanged"), (2, "update"), (3, "unchanged"), (4, "append")]
    assert not delta.is_unchanged(delta.table_diff(old, new, ["k"], "h")) and delta.is_unchanged(delta.table_diff(old, old, ["k"], "h"))
    merged = delta.upsert(old, table([(2, "q", 1), (2, "q", 9), (5, "e", 1)]), ["k"], ["v"])
    assert sorted((r.k, r.v) for r in merged.collect()) == [(1, 1), (2, 9), (3, 3), (5, 1)]
    assert sorted(r.k for r in delta.delete_keys(old, new.filter("k < 3"), ["k"]).collect()) == [3]
    states = {r.k: (r.v, r.carry_state) for r in delta.carry_over(new, old, "k", "h", ["v"]).collect()}
    assert states == {1: (1, "preserved"), 2: (None, "stale"), 3: (None, "new"), 4: (None, "new")}
    dup = delta.dedupe_by_hash(table([(1, "a", 1), (1, "a", 2), (2, "a", 1), (2, "b", 1), (3, "c", 1)]), ["k"], F.col("h"))
    assert sorted((r.k, r.state) for r in dup.collect()) == [(1, "repeat"), (2, "conflict"), (3, "single")]


def test_evidence(spark):
    df = spark.createDataFrame([("MP", 1, 5, None), ("MP", 2, 6, 1.5)], "member_type string, member_id int, n int, x double")
    section = lambda rows: rows.select("member_type", "member_id", F.struct("n", "x").alias("s"), F.struct("n").alias("a"))
    a = evidence.evidence_records(section(df), ["member_type", "member_id"])
    b = evidence.evidence_records(section(df.repartition(3)).select("s", "a", "member_id", "member_type"), ["member_type", "member_id"])
    assert sorted(r.evidence_hash for r in a.collect()) == sorted(r.evidence_hash for r in b.collect())
    assert '"x":null' in a.filter("member_id = 1").first().evidence_json
    keys = ["member_type", "member_id"]
    assert [r.member_id for r in evidence.stale_records(a, a.filter("member_id = 1"), keys, ["evidence_hash"]).collect()] == [2]
    back = evidence.merge_backlog(df.filter("member_id = 1"), df, keys)
    assert sorted((r.member_id, r.source) for r in back.collect()) == [(1, "fresh"), (2, "backlog")]


def test_work_references_keep_the_first_of_each_role(spark):
    rows = [(1, i, i % 4, "HIGH", "Completed", 90.0, float(i % 5), 1.0, i - 3) for i in range(20)]
    df = spark.createDataFrame(rows, "e int, work_id int, flag_count int, risk_level string, status string, expenditure_percentage double, sanction_amount double, expenditure_amount double, sanction_delay_days int")
    got = {}
    for r in evidence.work_references(df, ["e"]).orderBy("place").collect():
        got.setdefault(r.evidence_role, []).append(r.work_id)
    assert got == {"risk": [0, 1, 2, 3, 4], "positive_signal": [0, 1, 2], "representative": [4, 9, 14], "financial": [0, 1, 2], "execution": [19, 18, 17]}


def test_audits(spark):
    df = spark.createDataFrame([(1, 5), (1, 6), (2, -1), (None, 3)], "k int, v int")
    one = audit.duplicate_keys({"t": (df, ["k"])}).first()
    assert (one.n_rows, one.n_keys, one.n_repeated_keys) == (4, 3, 1)
    assert audit.orphans(df, df.filter("k = 1"), ["k"], "x").first().n_keys == 1
    assert {r.check_name: r.n_rows for r in audit.range_checks(df, {"neg": "v < 0", "null": "k IS NULL"}).collect()} == {"neg": 1, "null": 1}
    checks = spark.createDataFrame([("a", "HIGH", True), ("b", "LOW", False)], "check_name string, severity string, passed boolean")
    assert audit.verdict(checks) == "READY"
    assert audit.verdict(checks.union(spark.createDataFrame([("c", "CRITICAL", False)], checks.schema))) == "NOT READY"


def test_overall_uses_nearest_ranks(spark):
    counts = [c for c in metrics.STATISTICS]
    rows = spark.createDataFrame([("MP", i) for i in range(5)], "member_type string, member_id int")
    rows = rows.withColumns({c: F.lit(1.0) for c in counts}).withColumns({"total_works": F.lit(5), "sanctioned_works": F.lit(1), "sanctioned_amount": (F.col("member_id") + 1) * 10.0})
    got = {r.scope: r for r in metrics.overall_metrics(rows).collect()}
    assert (got["BOTH"].p25_work_cost, got["BOTH"].median_work_cost, got["BOTH"].p75_work_cost, got["BOTH"].p90_work_cost) == (20.0, 30.0, 40.0, 50.0)


def test_json_validation(spark):
    from worktally.operators.validation import validate_json

    texts = ['{"a": 1, "l": [1, 2]}', '{"a": 1, "l": [], "x": 2}', '{"l": "no"}', "broken {", None, '[1]', '{"a": "CORRUPT", "l": [1]}']
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    got = [r.problems for r in validate_json(df, "t", ["a"], ["l"], {"l": (1, 2)}, ["corrupt"]).orderBy("i").collect()]
    assert got == [[], ["unknown key", "length of l"], ["missing a", "length of l"], ["not an object"], ["not an object"], ["not an object"], ["contains corrupt"]]


def test_names_a_dimension_lacks_are_numbered_on(spark):
    dim = spark.createDataFrame([(4, "A"), (7, "B")], "id bigint, name string")
    new = spark.createDataFrame([("B",), ("D",), ("C",), ("C",), (None,)], "name string")
    assert sorted(map(tuple, delta.resolve_or_insert(dim, new, "id", "name").collect())) == [(4, "A"), (7, "B"), (8, "C"), (9, "D")]
    assert [r.id for r in delta.resolve_or_insert(dim.limit(0), new.limit(1), "id", "name").collect()] == [1]


def test_stage_checks(spark):
    df = spark.createDataFrame([(1, "x"), (2, "x")], "k int, h string")
    got = {r.check_name: r.passed for r in audit.verify_stage(df, df, ["k"], "h").collect()}
    assert got == {"not empty": True, "as many rows as expected": True, "no repeated keys": True, "h is unique": False}
