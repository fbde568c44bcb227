import json
import os
import shutil

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from worktally.functions.measures import parse_amount, parse_date
from worktally.functions.text import whole_number
from worktally.operators import profiling
from worktally.plans import pipeline
from worktally.plans.works_plan import WorksPlan
from worktally.sources import files, ndjson
from worktally.sources.versioned import VersionedTable
from worktally.streaming.snapshots import stream_upserts


def _snapshot(spark, root, name, rows):
    df = spark.createDataFrame(rows, "WORK_RECOMMENDATION_DTL_ID bigint, FLAG int")
    manifest = ndjson.write_ndjson(df.coalesce(1), f"{root}/{name}", "works_recommended", rows_a_part=2)
    ndjson.complete_snapshot(spark, f"{root}/{name}", [manifest])
    return manifest


def test_snapshots(spark, tmp_path):
    root = str(tmp_path)
    manifest = _snapshot(spark, root, "2026-01-01", [(1, 1), (2, None), (3, 3)])
    assert (manifest["records"], manifest["chunks"]) == (3, 2)
    _snapshot(spark, root, "2026-01-08", [(1, 1), (2, 2)])
    files.write_small(spark, f"{root}/2026-01-15/x", "no mark")
    one = ("works_recommended",)
    assert ndjson.validate_snapshot(spark, f"{root}/2026-01-01", one) == {}
    assert "calamity" in ndjson.validate_snapshot(spark, f"{root}/2026-01-01")
    assert ndjson.validate_snapshot(spark, f"{root}/2026-01-15", one) == {"*": "no completion mark"}
    assert ndjson.previous_snapshot(spark, root, "2026-01-20") == "2026-01-08"
    assert ndjson.previous_snapshot(spark, root, "2026-01-01") is None
    assert ndjson.changed_datasets(spark, f"{root}/2026-01-01", f"{root}/2026-01-08") == ["works_recommended"]
    assert ndjson.changed_datasets(spark, f"{root}/2026-01-01", f"{root}/2026-01-01") == []
    rows = ndjson.scan_ndjson(spark, f"{root}/2026-01-01", "works_recommended", ["FLAG", "WORK_RECOMMENDATION_DTL_ID"]).collect()
    assert sorted(r.WORK_RECOMMENDATION_DTL_ID for r in rows) == ["1", "2", "3"]
    assert ndjson.remove_old_snapshots(spark, root, keep=1) == ["2026-01-01"]


def test_broken_lines(spark, tmp_path):
    part = tmp_path / "d" / "part_0001.ndjson"
    part.parent.mkdir()
    part.write_text('{"A": 1}\n\n{"A": \n{"A": 2} x\n{"Total_Amt": 5}\n[1]\n{"A": "z", "B": {"c": 1}}\n')
    assert sorted(r.A for r in ndjson.scan_ndjson(spark, str(tmp_path), "d", ["A"]).collect()) == ["1", "z"]
    with pytest.raises(ndjson.BrokenSnapshot):
        ndjson.scan_ndjson(spark, str(tmp_path), "d", ["A"], strict=True)
    assert ndjson.scan_ndjson(spark, str(tmp_path), "absent", ["A"]).count() == 0


def test_versioned_table(spark, tmp_path):
    table = VersionedTable(spark, str(tmp_path / "t"), keep=2)
    rows = lambda *r: spark.createDataFrame(list(r), "k int, v int")
    with pytest.raises(FileNotFoundError):
        table.read()
    table.upsert(rows((1, 1), (1, 2), (2, 5)), ["k"], ["v"])
    before = table.read()
    table.upsert(rows((2, 6), (3, 7)), ["k"], ["v"])
    assert sorted(map(tuple, before.collect())) == [(1, 2), (2, 5)]
    assert table.upsert(rows(), ["k"], ["v"]) == table.current
    table.delete(rows((1, 0)), ["k"])
    assert sorted(map(tuple, table.read().collect())) == [(2, 6), (3, 7)]
    assert [n for n in files.names(spark, table.path) if n[0] == "v"] == ["v000002", "v000003"]


def test_stream_of_upserts(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    table = VersionedTable(spark, str(tmp_path / "t"))
    schema = StructType.fromDDL("k int, v int")

    def deliver(name, rows):
        (folder / name).write_text("\n".join(json.dumps(dict(zip("kv", r))) for r in rows))
        stream_upserts(spark, str(folder), schema, table, ["k"], ["v"], str(tmp_path / "check")).awaitTermination()
        return sorted(map(tuple, table.read().collect()))

    assert deliver("a.json", [(1, 1), (2, 2)]) == [(1, 1), (2, 2)]
    assert deliver("b.json", [(2, 9), (3, 3)]) == [(1, 1), (2, 9), (3, 3)]


@pytest.fixture
def few_fits(monkeypatch):
    """One fit of two clusters: what the profiles are is tested elsewhere."""
    monkeypatch.setattr(profiling, "SEEDS", range(42, 43))
    monkeypatch.setattr(profiling, "KS", range(2, 3))


def test_pointers_move_and_failed_snapshots_go(spark, tmp_path):
    root = str(tmp_path)
    for name in ("s1", "s2", "s3"):
        ndjson.complete_snapshot(spark, f"{root}/{name}", [])
    (tmp_path / "s4").mkdir()
    assert ndjson.promote(spark, root, "s1") == (None, "s1") and ndjson.promote(spark, root, "s2") == ("s1", "s2") and ndjson.promote(spark, root, "s2") == ("s1", "s2")
    with pytest.raises(ndjson.BrokenSnapshot):
        ndjson.promote(spark, root, "s4")
    assert ndjson.remove_failed_snapshot(spark, root, "s4") and not ndjson.remove_failed_snapshot(spark, root, "s3") and not ndjson.remove_failed_snapshot(spark, root, "s9")
    assert ndjson.remove_old_snapshots(spark, root, 1) == [] and ndjson.pointers(spark, root) == {"previous": "s1", "current": "s2"}


def test_deltas_carry_their_table_and_kind(spark, tmp_path):
    for name, text in (("works_recommended/append_part_0001.ndjson", '{"A": 1}\n\nbroken\n'), ("mla_expenditure/update_part_0001.ndjson", '{"A": "x"}\n'), ("mps/other.ndjson", '{"A": 2}\n')):
        (tmp_path / name).parent.mkdir(exist_ok=True)
        (tmp_path / name).write_text(text)
    assert sorted(tuple(r) for r in ndjson.scan_delta(spark, str(tmp_path), ["A"]).collect()) == [("mla_expenditure", "update", "x"), ("works_recommended", "append", "1")]
    assert ndjson.scan_delta(spark, str(tmp_path / "none"), ["A"]).count() == 0
    assert ndjson.load_all(spark, str(tmp_path), {"mps": ["A"], "gone": ["B"]})["gone"].count() == 0


def test_a_table_of_zeros_is_not_written(spark, tmp_path):
    table = VersionedTable(spark, f"{tmp_path}/t")
    rows = spark.createDataFrame([(0, None), (0, 0)], "n int, m int")
    assert table.write_unless_empty(rows, ["n", "m"]) is None and table.current is None
    assert table.write_unless_empty(rows.union(spark.createDataFrame([(0, 4)], "n int, m int")), ["n", "m"]) == "v000001"


def test_pipeline_ends_early_without_changes(spark, sf_small, tmp_path, few_fits):
    first = pipeline.run(spark, sf_small, str(tmp_path))
    assert first.changed and VersionedTable(spark, f"{tmp_path}/member_ranks").read().count() > 0
    assert not pipeline.run(spark, sf_small, str(tmp_path)).changed


def test_pipeline_sees_a_new_member_and_a_moved_payment(spark, sf_small, tmp_path, few_fits):
    folder, out = str(tmp_path / "in"), str(tmp_path / "out")
    shutil.copytree(sf_small, folder)
    os.chmod(folder, 0o755)

    def rewrite(name, change):
        path = f"{folder}/{name}.parquet"
        table = pq.read_table(path)
        os.remove(path)
        pq.write_table(pa.Table.from_pylist(change(table.to_pylist()), table.schema), path)

    def result(name):
        return VersionedTable(spark, f"{out}/{name}").read()

    assert pipeline.run(spark, folder, out).changed
    rewrite("mps", lambda rows: [*rows, {**rows[0], "mp_id": 987654, "mp_name": "Someone New"}])
    assert pipeline.run(spark, folder, out).changed
    assert result("member_ranks").filter("member_id = 987654").count() == 1

    # A payment before its work's last one moves to another fiscal year: the sum and the last day stay.
    work = WorksPlan(spark, folder)
    key = whole_number(F.col("work_recommendation_dtl_id")).cast("bigint").alias("work_id")
    paid = work.table("expenditure").select("sno", key, parse_date(F.col("expenditure_date")).alias("day"), parse_amount(F.col("fund_disbursed_amt")).alias("amount"))
    once = paid.groupBy("sno").agg(F.count("*").alias("n"), F.first("work_id").alias("work_id"), F.first("day").alias("day"), F.first("amount").alias("amount"))
    sno = once.join(work.measured.select("work_id", "last_expenditure_date"), "work_id").filter("n = 1 AND day < last_expenditure_date AND amount > 0").first().sno
    rewrite("expenditure", lambda rows: [{**r, "expenditure_date": "2001-05-05"} if r["sno"] == sno else r for r in rows])
    assert result("fiscal_metrics").filter("fy_start = 2001").count() == 0
    assert pipeline.run(spark, folder, out).changed
    assert result("fiscal_metrics").filter("fy_start = 2001 AND expenditure_count = 1").count() == 1
    assert not pipeline.run(spark, folder, out).changed


def test_pipeline_has_the_intelligence_and_evidence_results(spark, sf_small, few_fits):
    tables = pipeline.results(WorksPlan(spark, sf_small))
    for name in ("isolation_scores", "entity_risk", "member_profiles", "member_evidence", "state_evidence", "peer_ranks", "state_work_references"):
        assert tables[name].limit(1).count() == 1
