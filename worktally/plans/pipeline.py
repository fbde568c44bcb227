"""The whole run: a gate for unchanged inputs, a full recompute, and one versioned table for each result."""

from __future__ import annotations

import json
import time
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from worktally.operators import delta, metrics
from worktally.plans import record_queries, works_queries
from worktally.plans.works_plan import WorksPlan
from worktally.sources import files
from worktally.sources.versioned import VersionedTable


@dataclass
class RunReport:
    """What a run did: ``changed`` is false if it ended at the gate."""

    changed: bool
    seconds: dict[str, float] = field(default_factory=dict)
    versions: dict[str, str] = field(default_factory=dict)


#: Result tables by the query that gives them.
TABLES = {
    "works": "work_record",
    "member_metrics": "member_record",
    "state_metrics": "state_record",
    "member_ranks": "competition_rank",
    "state_ranks": "state_rank",
    "national_statistics": "national_statistics",
    "overall_metrics": "overall_metrics",
    "category_metrics": "category_metrics",
    "fiscal_metrics": "fy_metrics",
    "member_anomalies": "member_anomaly",
    "member_anomaly_explanations": "anomaly_explanations",
    "state_anomalies": "state_anomaly",
    "work_references": "evidence_work_refs",
    "state_work_references": "state_work_refs",
    "isolation_scores": "isolation_forest",
    "entity_risk": "entity_risk",
    "state_risk": "state_risk",
    "member_profiles": "kmeans_profile",
    "state_profiles": "state_profile",
    "peer_ranks": "peer_rank_profiles",
    "member_evidence": "member_evidence_records",
    "state_evidence": "state_evidence_records",
}
SOURCES = ("work_analysis", "expenditure", "mps", "mlas", "allocated_limit", "states")


def results(plan: WorksPlan) -> dict[str, DataFrame]:
    """The result tables, each built when written (profiles, whose number of clusters is fitted, at once)."""
    built = {name: (works_queries if query in works_queries.QUERIES else record_queries).build(query, plan) for name, query in TABLES.items()}
    return built | {"trends": metrics.trends(plan.flagged)}


def files_seen(spark: SparkSession, folder: str) -> str:
    """Names, sizes and times of change of the source files, as one text: equal texts mean that no file changed."""
    return json.dumps(sorted(entry for name in SOURCES for entry in files.listing(spark, f"{folder}/{name}.parquet")))


def inputs_seen(plan: WorksPlan) -> DataFrame:
    """(source, record, content_hash): every input the results read, by key: works, members of the master and payments.

    Payments have no key of their own here: equal ones are one record, and how many there are is its content.
    """

    def one(source: str, df: DataFrame, keys: list[str]) -> DataFrame:
        content = F.to_json(F.struct(*[c for c in sorted(df.columns) if c not in keys]))
        return df.select(F.lit(source).alias("source"), F.to_json(F.struct(*keys)).alias("record"), F.sha2(content, 256).alias("content_hash"))

    paid = ["work_id", "day", "amount"]
    payments = plan.payment_rows.groupBy(*paid).agg(F.count("*").alias("n"))
    limits = plan.table("allocated_limit")
    return one("works", plan.measured, ["work_id"]).unionByName(one("limits", limits.groupBy(*limits.columns).agg(F.count("*").alias("n")), limits.columns)).unionByName(one("members", plan.master, ["member_type", "member_id"])).unionByName(one("payments", payments, paid))


def run(spark: SparkSession, folder: str, out: str) -> RunReport:
    """Recompute all results of the tables in ``folder`` if a work, a member or a payment changed since the last run.

    Global statistics are always taken over the full population. A run whose source files are those
    of the last one ends before anything is read; one whose records are the same, after hashing them.
    """
    began = time.time()
    seen, mark = files_seen(spark, folder), f"{out}/_files_seen.json"
    if files.exists(spark, mark) and files.read_small(spark, mark) == seen:
        return RunReport(False, {"gate": time.time() - began})
    plan = WorksPlan(spark, folder)
    state = VersionedTable(spark, f"{out}/_inputs_seen")
    now = inputs_seen(plan)
    if state.current is not None and delta.is_unchanged(delta.table_diff(state.read(), now, ["source", "record"], "content_hash")):
        files.write_small(spark, mark, seen)
        return RunReport(False, {"gate": time.time() - began})
    report = RunReport(True, {"gate": time.time() - began})
    plan.flagged  # noqa: B018 - written once, since nearly all results read it
    for name, df in results(plan).items():
        at = time.time()
        report.versions[name] = VersionedTable(spark, f"{out}/{name}").write(df)
        report.seconds[name] = time.time() - at
    state.write(now)
    files.write_small(spark, mark, seen)
    return report
