import json
import random
from datetime import datetime, timedelta

from worktally.operators.references import Parent, Referring, orphan_report, reference_status
from worktally.operators.snapshot_changes import PUBLIC_WORKS, snapshot_changes, snapshot_lines
from worktally.plans import registry
from pyspark.sql import functions as F

SCHEMA = "snapshot_no int, dataset string, line_no bigint, identity string, raw_json string, content string, ordinal int"


def _records(spark, rows):
    return spark.createDataFrame([(s, d, n, None, j, "clash", 7) for s, d, n, j in rows], SCHEMA)


def _work(i, **fields):
    return json.dumps({"WORK_RECOMMENDATION_DTL_ID": i, **fields})


def _changes(spark, rows):
    return sorted(tuple(r) for r in snapshot_changes(_records(spark, rows)).select("dataset", "snapshot_no", "identity", "change_kind").collect())


def test_kinds_of_change(spark):
    d = "works_recommended"
    rows = [
        (1, d, 1, _work(1, SANCTION_AMOUNT=100)),
        (1, d, 2, _work(2, LETTER_NO="a b")),
        (1, d, 3, _work(3, RECOMMENDATION_DATE="04-Jun-2024")),
        (2, d, 1, _work("1", SANCTION_AMOUNT="100.00")),
        (2, d, 2, _work(2.0, LETTER_NO="a  B")),
        (2, d, 3, _work(4)),
        (4, d, 1, _work(3, RECOMMENDATION_DATE="2024-06-04", FLAG=None, MP_NAME="x")),
        (4, d, 2, _work(4, FLAG="  ")),
    ]
    assert _changes(spark, rows) == [
        (d, 2, '["2"]', "changed"),
        (d, 2, '["3"]', "removed"),
        (d, 2, '["4"]', "added"),
        (d, 4, '["1"]', "removed"),
        (d, 4, '["2"]', "removed"),
        (d, 4, '["3"]', "added"),
    ]


def test_lines_that_are_no_records(spark):
    d = "works_completed"
    good = _work(1, ACTUAL_AMOUNT=5)
    bad = [None, "", "   ", "{", good[:-3], good + " x", good + good, "[1]", '"text"', "{}", _work(None), _work("  "), '{"Total_Amt": 5}', "{'WORK_RECOMMENDATION_DTL_ID': 1}", "[" + good + "]"]
    lines = snapshot_lines(_records(spark, [(1, d, i, x) for i, x in enumerate([*bad, good, " " + good + "\n"])]))
    assert [r.line_no for r in lines.collect()] == [len(bad), len(bad) + 1]


def test_highest_line_counts_and_empty_table(spark):
    d = "works_completed"
    rows = [(1, d, 1, _work(1, ACTUAL_AMOUNT=5)), (2, d, 1, _work(1, ACTUAL_AMOUNT=6)), (2, d, 9, _work(1, ACTUAL_AMOUNT=5)), (2, d, 9, _work(1, ACTUAL_AMOUNT=5))]
    assert _changes(spark, rows) == []
    assert _changes(spark, []) == []
    assert _changes(spark, [(1, d, 1, "x" * 100_000), (2, d, 1, _work(1, ACTUAL_AMOUNT="9" * 50_000))]) == [(d, 2, '["1"]', "added")]


def test_changed_fields_and_compound_identity(spark):
    d = "allocated_limit"
    line = lambda **f: json.dumps({"MP_NAME": " A  B ", "STATE_NAME": "S", "CONSTITUENCY": "C", "TENURE": "2019-24", **f})
    rows = [(1, d, 1, line(ALLOCATED_AMT=5)), (2, d, 1, line(ALLOCATED_AMT=6, HOUSE_OF_PARLIAMENT=1)), (2, d, 2, json.dumps({"MP_NAME": "A"}))]
    got = snapshot_changes(_records(spark, rows)).collect()
    assert [(r.identity, r.change_kind, sorted(r.changed_fields)) for r in got] == [('["A B","S","C","2019-24"]', "changed", ["ALLOCATED_AMT", "HOUSE_OF_PARLIAMENT"])]


def test_changes_against_brute_force(spark):
    rng = random.Random(5)
    rows, held = [], {}
    for d in ("works_recommended", "works_completed"):
        field = PUBLIC_WORKS.datasets[d].numbers[0]
        for s in (1, 2, 3, 5):
            if (d, s) == ("works_completed", 3):
                continue
            for n in range(rng.randint(20, 40)):
                key, value = rng.choice([1] * 10 + list(range(12))), rng.randint(0, 2)
                rows.append((s, d, n, _work(rng.choice([key, str(key), float(key)]), **{field: rng.choice([value, str(value), f"{value}.0"])})))
                held.setdefault((d, s), {})[key] = value
    want = []
    for d in ("works_recommended", "works_completed"):
        numbers = sorted(s for x, s in held if x == d)
        for a, b in zip(numbers, numbers[1:]):
            old, new = held[d, a], held[d, b]
            for k in old.keys() | new.keys():
                kind = "added" if k not in old else "removed" if k not in new else "changed" if old[k] != new[k] else None
                if kind:
                    want.append((d, b, f'["{k}"]', kind))
    assert _changes(spark, rows) == sorted(want)


T0 = datetime(2024, 1, 1)


def _tables(spark, refs, parents):
    r = spark.createDataFrame(refs, "sno bigint, k string, loaded_at timestamp, key string, kind string")
    p = spark.createDataFrame(parents, "k string, loaded_at timestamp, removed_at timestamp, there boolean")
    return [Referring("t", r, "sno", "k", "loaded_at", F.lit("w"))], [Parent("w", p, "k")]


def test_reference_reasons(spark):
    day = lambda n: T0 + timedelta(days=n)
    refs = [(1, "7", day(5), "x", "y"), (1, "7", day(1), "x", "y"), (2, "+8", day(5), "x", "y"), (3, "9", day(5), "x", "y"), (4, "99", day(40), "x", "y"), (5, None, day(5), "x", "y"), (6, " ", day(5), "x", "y"), (7, "TBD", day(5), "x", "y"), (8, "10.0", day(5), "x", "y"), (9, "7", None, "x", "y")]
    parents = [("7", day(2), None, True), ("08", day(0), day(3), True), ("9", day(0), day(3), True), ("9", day(4), None, True), ("१०", day(0), None, True), (None, day(0), None, True), ("abc", day(0), None, True)]
    got = {r.row_id: (r.load_month, r.reason_code) for r in reference_status(*_tables(spark, refs, parents)).collect()}
    assert got == {1: ("2024-01", "late"), 2: ("2024-01", "deleted"), 3: ("2024-01", None), 4: ("2024-02", "missing"), 7: ("2024-01", "missing"), 8: ("2024-01", None), 9: (None, None)}


def test_references_of_empty_tables_and_a_hot_key(spark):
    refs = [(i, "1" if i % 3 else str(i), T0, "x", "y") for i in range(300)]
    report = orphan_report(*_tables(spark, refs, [])).collect()
    assert [(r.reason_code, r.n_references) for r in report] == [("missing", 300)]
    assert orphan_report(*_tables(spark, [], [("1", T0, None, True)])).count() == 0
    got = reference_status(*_tables(spark, refs, [("1", T0, None, True)] * 3)).filter("reason_code IS NULL").count()
    assert got == sum(1 for i in range(300) if i % 3 or i == 1)


def test_deliveries_are_compared_by_all_content_fields(spark, tmp_path):
    fields = "activity_name work_category work_description recommendation_date recommended_amount sanction_date sanction_amount work_stage letter_no".split()
    columns = ["work_recommendation_dtl_id string", *[f"{f} string" for f in fields], "flag int", "file_status boolean", "attach_id bigint", "loaded_at timestamp", "removed_at timestamp"]
    base = dict(zip(fields, ["Hall", "Health", "by the tank", "2021-05-27", "100000", "2021-06-01", "5", "Sanctioned", "L/1"])) | {"flag": 0, "file_status": True, "attach_id": 7}
    changes = {
        "1": {},
        "2": {"flag": 1},
        "3": {"recommendation_date": "28-May-2021"},
        "4": {"recommended_amount": "1,00,000.00", "recommendation_date": "May 27, 2021 12:00:00 AM", "activity_name": " Hall "},
        "5": {"file_status": None},
        "6": {"work_description": None},
    }
    names = [c.split()[0] for c in columns]
    rows = []
    for key, change in changes.items():
        rows.append({**base, "work_recommendation_dtl_id": key, "loaded_at": datetime(2022, 1, 1), "removed_at": None})
        rows.append({**base, **change, "work_recommendation_dtl_id": f" {key}.0", "loaded_at": datetime(2023, 1, 1), "removed_at": None})
    spark.createDataFrame([tuple(r[n] for n in names) for r in rows], ", ".join(columns)).write.parquet(str(tmp_path / "works_recommended.parquet"))
    run = lambda name: registry.queries()[name](spark, str(tmp_path)).collect()
    same = {1, 4}
    assert {r.work_id: r.state for r in run("snapshot_dedupe_full")} == {i: "repeat" if i in same else "conflict" for i in range(1, 7)}
    assert {r.work_id: r.op for r in run("snapshot_diff_full")} == {i: "unchanged" if i in same else "update" for i in range(1, 7)}
    assert {r.work_id: r.carry_state for r in run("ml_carryover_full")} == {i: "preserved" if i in same else "stale" for i in range(1, 7)}
