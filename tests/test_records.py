"""Small cases of the member, delta, ingestion, backlog and audit operators."""

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from worktally.operators import audit, benchmarks, delta, evidence, ingest, members, profiling, records

T0 = datetime(2026, 1, 1)


def _master(spark):
    rows = [("MP", 1, "Shri Ram Nath", "Lower House", "2019-2024", 10), ("MP", 2, "Sita Devi", None, None, 11), ("MLA", 1, "Ram Nath", "State Assembly", "2020-2025", None), ("MLA", 3, "Ram  Nath", "State Assembly", "2020-2025", 12), ("MLA", 4, None, None, None, None)]
    return spark.createDataFrame(rows, "member_type string, member_id bigint, member_name string, house_name string, tenure string, constituency_id int")


def _limits(spark):
    rows = [(2, "RAM NATH", "S", "C", "Lower House", 1, "2019-2024", "2019-06-01", "31-May-2024", "100.5", T0), (1, "Sita Devi (2019)", "S", None, "Lower House", 1, "2014-2019", None, None, "7", T0), (3, "Ram Nath", "S", "C", "State Assembly", 3, "2020-2025", None, None, "x", T0), (4, " ", "S", "C", None, None, None, None, None, "1", T0)]
    return spark.createDataFrame(rows, "sno bigint, mp_name string, state_name string, constituency string, house_name string, house_of_parliament int, tenure string, tenure_start_date string, tenure_end_date string, allocated_amt string, loaded_at timestamp")


def test_names_are_resolved_to_one_member(spark):
    rows = spark.createDataFrame([("Ram Nath", "MP"), ("ram nath (x)", "MLA"), ("Nobody", "MP"), (None, "MP"), ("  ", "MLA")], "mp_name string, kind string")
    got = {(r.mp_name, r.kind): (r.name_state, r.member_id) for r in members.resolve_names(rows, _master(spark), "mp_name", F.col("kind")).collect()}
    assert got == {("Ram Nath", "MP"): ("resolved", 1), ("ram nath (x)", "MLA"): ("ambiguous", None), ("Nobody", "MP"): ("missing", None), (None, "MP"): ("missing", None), ("  ", "MLA"): ("missing", None)}
    with pytest.raises(members.UnresolvedNames, match="Nobody"):
        members.require_resolved(members.resolve_names(rows.filter("mp_name = 'Nobody'"), _master(spark), "mp_name", F.lit("MP")), "mp_name")
    assert members.resolve_names(rows.limit(0), _master(spark), "mp_name", F.lit("MP")).count() == 0


def test_members_without_works_by_id_and_by_name(spark):
    works = spark.createDataFrame([("MLA", 1), ("MLA", 1)], "member_type string, member_id bigint")
    idle = members.zero_work_members(_master(spark), works, members.master_population(_limits(spark)))
    got = {(r.member_type, r.member_id): (r.normalized_name, r.house_name, r.allocated_amount and float(r.allocated_amount)) for r in idle.collect()}
    # MLA 3 has the name of MLA 1, who has works; MP 1 has it too, but is of the other population.
    assert got == {("MP", 1): ("RAM NATH", "Lower House", 100.5), ("MP", 2): ("SITA DEVI", "Lower House", 7.0), ("MLA", 4): ("", None, None)}
    assert {(r.member_type, r.n_records, r.n_names) for r in members.population_counts(members.master_population(_limits(spark))).collect()} == {("MP", 2, 2), ("MLA", 1, 1)}


def test_tenures_and_allocations(spark):
    known = members.master_population(_limits(spark))
    got = {(r.member_type, r.member_id): (r.tenure, r.house_name) for r in members.prefilled(_master(spark), known).collect()}
    assert got[("MP", 2)] == ("2014-2019", "Lower House") and got[("MLA", 4)] == (None, None)
    matched = {(r.member_type, r.member_id): (r.allocated_amount, r.allocated_confidence) for r in members.match_allocations(_master(spark), _limits(spark)).collect()}
    assert matched[("MP", 1)] == (100.5, "HIGH") and matched[("MLA", 3)] == (0.0, "LOW")


def test_conflicts_are_errors_and_repeats_are_not(spark):
    rows = spark.createDataFrame([(1, "a"), (1, "a"), (2, "a"), (2, "b"), (None, "x")], "k int, c string")
    found = delta.dedupe_by_hash(rows, ["k"], F.col("c"))
    with pytest.raises(delta.Conflict):
        delta.require_no_conflict(found, ["k"])
    assert delta.require_no_conflict(found.filter("k = 1"), ["k"]).first().state == "repeat"
    pays = spark.createDataFrame([(1, "w", "5"), (2, "w", "5"), (3, "v", "5"), (4, "v", "6")], "sno int, name string, amt string")
    assert {(r.fingerprint, r.state) for r in delta.payment_conflicts(pays, F.col("name"), ["sno"]).collect()} == {("w", "repeat"), ("v", "conflict")}
    blank = spark.createDataFrame([(None, None, ""), ("a", None, None), ("a", "b", "c")], "i string, j string, c string")
    assert {tuple(r) for r in delta.without_identity(blank, ["i", "j"], ["c"]).collect()} == {("blank", 1), ("incomplete", 1)}
    assert {tuple(r) for r in delta.without_identity(blank, ["i", "j"], ["c"], blank_allowed=True).collect()} == {("incomplete", 1)}


def test_deltas_by_table_and_work(spark):
    rows = spark.createDataFrame([("works_recommended", "append", "7"), ("works_recommended", "update", "8.0"), ("mla_expenditure", "append", "7"), ("mla_calamity", "update", "9"), ("mps", "update", None)], "table_name string, op string, WORK_RECOMMENDATION_DTL_ID string")
    assert {(r.table_name, r.change_type) for r in delta.change_types(rows).collect()} == {("works_recommended", "mixed"), ("mla_expenditure", "append"), ("mla_calamity", "update"), ("mps", "update")}
    assert sorted(r.work_id for r in delta.works_of_delta(rows).collect()) == [7, 8, 1_000_007]
    assert delta.must_run("national_ranking", False) and delta.must_run("trends", True) and not delta.must_run("trends", False) and not delta.must_run("member_metrics", True)


def test_new_names_are_numbered_in_their_order(spark):
    known = spark.createDataFrame([(4, "B")], "id bigint, name string")
    names = spark.createDataFrame([(n,) for n in ("Z", "A", "AB", "AA", "B", None, "A", "M", "")], "name string")
    got = sorted((r.id, r.name) for r in delta.resolve_or_insert(known, names, "id", "name").collect())
    assert got == [(4, "B"), (5, ""), (6, "A"), (7, "AA"), (8, "AB"), (9, "M"), (10, "Z")]


SOURCE = "work_recommendation_dtl_id string, work_id bigint, mp_name string, state_name string, constituency string, activity_name string, work_category string, work_description string, recommendation_date string, recommended_amount string, letter_no string, sanction_date string, sanction_amount string, work_stage string, actual_end_date string, actual_amount string, loaded_at timestamp"


def _source(spark, *rows):
    names = [part.split()[0] for part in SOURCE.split(", ")]
    return spark.createDataFrame([tuple({"loaded_at": T0, **r}.get(n) for n in names) for r in rows], SOURCE)


def test_datasets_become_tables(spark):
    a = {"work_recommendation_dtl_id": "7", "mp_name": " Ram ", "recommendation_date": "2026-01-02", "recommended_amount": "5", "sanction_date": " "}
    rows = _source(spark, a, {**a, "recommended_amount": "6", "loaded_at": datetime(2026, 1, 2)}, {**a, "work_recommendation_dtl_id": "8", "sanction_amount": "9"}, {**a, "work_recommendation_dtl_id": None})
    assert ingest.source_rows(rows, "works_recommended").count() == 3
    with pytest.raises(ingest.Unmatched):
        ingest.source_rows(rows.filter("work_recommendation_dtl_id IS NULL"), "expenditure")
    known = ingest.works(rows, "MP")
    assert sorted((r.work_id, r.mp_name) for r in known.collect()) == [(7, "Ram"), (8, "Ram")]
    assert {(r.work_id, float(r.recommended_amount)) for r in ingest.recommendations(rows, "MP").collect()} == {(7, 6.0), (8, 5.0)}
    assert [r.work_id for r in ingest.sanctions(rows, "MP").collect()] == [8]
    done = _source(spark, {"work_recommendation_dtl_id": "7", "actual_end_date": "03-Feb-2026", "actual_amount": "4"})
    assert ingest.completions(done, known, "MP").first().completion_date == date(2026, 2, 3)
    with pytest.raises(ingest.Unmatched):
        ingest.completions(done, known, "MLA")
    assert ingest.transforms_of("mla_expenditure") == (ingest.payments,)
    with pytest.raises(KeyError):
        ingest.transforms_of("events")


def test_payments_allocations_and_calamities(spark):
    pay = spark.createDataFrame(
        [("7", 1, "2026-01-02", "V", "S", "5", "st", "c", "m", T0), ("7", 1, "2026-01-02", " V ", "S", "5.00", "st", "c", "m", T0), ("9", 1, "2026-01-02", "V", "S", "-5", "st", "c", "m", T0)],
        "work_recommendation_dtl_id string, work_id bigint, expenditure_date string, vendor_name string, work_status string, fund_disbursed_amt string, state_name string, constituency string, mp_name string, loaded_at timestamp",
    )
    known = spark.createDataFrame([(7, "MP")], "work_id bigint, member_type string")
    assert sorted((r.work_id or 0, float(r.amount or 0)) for r in ingest.payments(pay, known, "MP").collect()) == [(0, 0.0), (7, 5.0)]
    resolved = members.resolve_names(_limits(spark), _master(spark), "mp_name", F.lit("MP"))
    assert sorted((r.member_id, float(r.allocated_amount)) for r in ingest.allocations(resolved).collect() if r.allocated_amount is not None) == [(1, 100.5), (2, 7.0)]
    blows = spark.createDataFrame([("SITA DEVI", "2026-01-01", "Flood", "x", "5", T0), (" ", None, "", None, None, T0), ("Nobody", "2026-01-01", "Flood", "x", "5", T0)], "mp_name string, crt_dt string, calamity_name string, type string, consented_amount string, loaded_at timestamp")
    assert [(r.member_id, r.day) for r in ingest.calamities(blows, _master(spark), "MP").collect()] == [(2, date(2026, 1, 1))]


@pytest.mark.parametrize(
    ("counts", "ended", "said"),
    [
        ({"completed": 19, "failed": 0, "pending": 0, "processing": 0}, True, "completed=19"),
        ({"completed": 15, "failed": 4, "pending": 0, "processing": 0}, True, "failed=4"),
        ({"completed": 12, "failed": 2, "pending": 3, "processing": 2}, False, "pending=3"),
        ({"completed": 18, "failed": 0, "pending": 0, "processing": 1}, False, "processing=1"),
        ({"completed": 0, "failed": 19, "pending": 0, "processing": 0}, True, "completed=0"),
        ({"completed": 19}, True, "all 19 jobs completed"),
        ({"completed": 15}, False, "counts unclear"),
        ({"completed": 19, "pending": 0}, True, "all 19"),
    ],
)
def test_the_end_of_an_ingestion(counts, ended, said):
    assert audit.terminal_state("All ingestion jobs completed.", 19, **counts)[0] is ended and said in audit.terminal_state("All ingestion jobs completed.", 19, **counts)[1]
    assert audit.terminal_state("working", 19, **counts) == (False, "not a completion message")


def test_jobs_are_summed_up(spark):
    jobs = spark.createDataFrame([("completed",), ("failed",), ("completed",)], "status string")
    r = audit.job_summary(jobs).first()
    assert (r.n_jobs, r.completed, r.is_terminal, r.is_success) == (3, 2, True, False)
    assert audit.job_summary(jobs.limit(0)).first().is_success and not audit.job_summary(jobs.union(spark.createDataFrame([("pending",)], "status string"))).first().is_terminal


def test_a_backlog_after_attempts(spark):
    old = spark.createDataFrame([(1, "PENDING", 9, "TIMEOUT", T0, T0), (2, "PENDING", 1, "TIMEOUT", T0, T0), (3, "PENDING", 2, "TIMEOUT", T0, T0)], "k int, status string, attempt_count int, last_error_class string, last_attempt_at timestamp, next_retry_at timestamp")
    tries = spark.createDataFrame([(1, False, "503 bad", T0), (2, False, "x", T0), (2, True, None, datetime(2026, 1, 2)), (4, False, "Rate Limit", T0), (None, True, "", T0)], "k int, succeeded boolean, message string, attempted_at timestamp")
    got = {r.k: (r.status, r.attempt_count, r.last_error_class, r.next_retry_at) for r in evidence.after_attempts(old, tries, ["k"], "2026-01-03 00:00:00").collect()}
    assert got == {1: ("EXHAUSTED", 10, "SERVER_ERROR", None), 2: ("RESOLVED", 1, "TIMEOUT", None), 3: ("PENDING", 2, "TIMEOUT", T0), 4: ("PENDING", 1, "RATE_LIMITED", datetime(2026, 1, 3))}
    assert evidence.backlog_summary(old).first().n_entities == 3


def test_requests_hold_five_records_and_so_many_characters(spark):
    rows = spark.createDataFrame([(i, n) for i, n in enumerate([10, 10, 10, 10, 10, 10, 90, 20, 95, 5])], "k int, n int")
    got = {r.k: r.request_no for r in evidence.request_batches(rows.withColumn("g", F.lit("a")), ["k"], "n", 5, 100, by=["g"]).collect()}
    runs = [[k for k in got if got[k] == no] for no in dict.fromkeys(got[k] for k in sorted(got))]
    assert [sorted(r) for r in runs] == [[0, 1, 2, 3, 4], [5, 6], [7], [8, 9]]


def test_ranks_and_levels_are_audited(spark):
    ranked = spark.createDataFrame([("MP", 1, 90.0), ("MP", 2, 95.0), ("MP", 9, 10.0), ("MLA", 1, 5.0), ("MLA", None, None)], "member_type string, rank int, performance_score_weighted double")
    assert {tuple(r) for r in audit.rank_consistency(ranked).collect()} == {("MP", 3, 9, 1, 1), ("MLA", 1, 1, 0, 0)}
    levels = spark.createDataFrame([("HIGH", 5.0), ("ODD", 700.0), (None, None)], "level string, score double")
    assert {tuple(r) for r in audit.level_checks(levels, "level", "score", ["HIGH"], 0, 100).collect()} == {("HIGH", 1, 0, 0, 0), ("ODD", 1, 1, 1, 0), (None, 1, 1, 0, 1)}
    assert audit.catalog_check(["works", "works_backup", "x"], ["works", "y"]) == {"missing": ["y"], "unexpected": ["works_backup", "x"], "deprecated": ["works_backup"]}
    checks = spark.createDataFrame([("a", "HIGH", False), ("b", "CRITICAL", True)], "check_name string, severity string, passed boolean")
    assert audit.stage_status(checks) == "SUCCESS_WITH_WARNINGS" and audit.stage_status(checks.filter("passed")) == "PASS" and audit.stage_status(checks.withColumn("passed", F.lit(False))) == "FAIL"


def test_scores_and_fingerprints(spark):
    row = spark.createDataFrame([(None, 80.0), (95.0, 70.5)], "a double, b double").select(records.summed_score(F.col("a"), F.col("b")).alias("s")).withColumn("c", records.summed_band(F.col("s")))
    assert [tuple(r) for r in row.collect()] == [(80.0, "NEEDS_ATTENTION"), (165.5, "PERFORMER")]


def test_only_the_cost_term_of_the_health_is_divided(spark):
    one = spark.createDataFrame([("MP", 1, 10, 5, 40.0, 12.0, 20.0, 1, 3)], "member_type string, member_id int, total_works int, completed_works int, expenditure_sanction_utilization_pct double, avg_sanction_delay_days double, flagged_rate_pct double, overdue_over_1_year int, cost_anomaly_works int")
    r = profiling.member_features(one).first()
    assert (r.portfolio_health, r.implementation_efficiency) == (100 - (20 + 10 + 10), 50.0)


def test_clusterings_are_compared_and_stable(spark):
    pairs = spark.createDataFrame([(i, i % 2, (i % 2) * 5) for i in range(20)], "k int, a int, b int")
    assert profiling.rand_index(pairs) == 1.0 and abs(profiling.rand_index(pairs.withColumn("b", (F.col("k") / 2).cast("int") % 2))) < 0.2
    rows = spark.createDataFrame([(i, float(i % 2) * 50 + i / 10) for i in range(40)], "k int, x double").coalesce(1)
    assert profiling.stability(rows, ["k"], ["x"], 2, rounds=1) == 1.0
    assert profiling.kmeans_profiles(rows.limit(2), ["k"], ["x"]).select("cluster_id").distinct().first()[0] == -1


def test_percentiles_of_large_groups_are_near_the_exact_ones(spark):
    works = spark.range(20_000).select(
        F.lit("MP").alias("member_type"), F.lit("a").alias("normalized_activity"), F.lit(1).alias("state_id"), F.lit(date(2026, 1, 1)).alias("sanction_date"), (F.col("id") * 37 % 20_000 + 1).cast("decimal(18,2)").alias("sanction_amount"), F.lit(3).alias("execution_days"), F.lit(5).alias("sanction_delay_days")
    )
    exact, near = (benchmarks.benchmark_groups(works, accuracy).filter("level = 'STATE'").first() for accuracy in (None, 1000))
    for p in (25, 50, 75, 90, 95):
        assert abs(exact[f"cost_p{p}"] - near[f"cost_p{p}"]) <= 21
    assert benchmarks.delay_distribution(works, 1000).first().delay_p90 == 5.0
